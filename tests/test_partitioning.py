from pyspark.sql import functions as F

from ledgerlake.functions.lookup import lookup_join
from ledgerlake.operators.joins import join_sized
from ledgerlake.operators.partitioning import ensure_parallelism


def test_ensure_parallelism_only_spreads_small_inputs(spark):
    one = spark.range(0, 100, numPartitions=1)
    assert ensure_parallelism(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, numPartitions=6)
    assert ensure_parallelism(many, 4) is many


def test_join_sized_broadcasts_only_under_the_bound(spark):
    big = spark.range(0, 1000).withColumn("k", F.col("id") % 10)
    small = spark.range(0, 10).withColumnRenamed("id", "k")
    plan = join_sized(big, small, "k", "inner", max_broadcast_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = join_sized(big, small, "k", "inner", max_broadcast_rows=5)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_skewed_key_is_split_in_shuffle_join(spark):
    # one key holds a third of the rows; with the broadcast refused the adaptive plan splits it
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        big = spark.range(0, n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
        small = spark.range(0, n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        out = join_sized(big, small, "k", "left", max_broadcast_rows=10)
        assert len(out.collect()) == n  # runs this plan, so the adaptive plan below is final
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lookup_join_never_multiplies_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    table = spark.createDataFrame([("a", "A1"), ("a", "A2")], "key string, name string")
    out = lookup_join(df, "k", table, "key", ["name"], default="?")
    assert sorted((r.k or "", r.name) for r in out.collect()) == [("", "?"), ("a", "A2"), ("b", "?")]


def test_salted_join_without_adaptive_skew_handling(spark):
    big = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    expected = sorted(tuple(r) for r in big.join(small, "k", "left").collect())
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_sized(big, small, "k", "left", max_broadcast_rows=0)
        assert "__salt" in out._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(tuple(r) for r in out.select("k", "id", "v").collect()) == expected
        cond = join_sized(big, small.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "left", max_broadcast_rows=0)
        assert cond.count() == 3000 and "__salt" not in cond.columns
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
