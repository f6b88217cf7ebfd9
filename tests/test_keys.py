from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators.keys import with_dense_key


def _expected(df, order):
    w = Window.orderBy(*order)
    return {tuple(r[:-1]): r[-1] for r in df.withColumn("k", F.row_number().over(w)).collect()}


def test_dense_key_equals_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("a"), F.col("id").alias("b"))
    for parts in [1, 3, 16]:
        keyed = with_dense_key(df.repartition(parts), ["a", "b"], "k", num_partitions=parts)
        got = {(r.a, r.b): r.k for r in keyed.df.collect()}
        assert keyed.rows == 5000
        assert got == _expected(df, ["a", "b"])
        assert sorted(got.values()) == list(range(1, 5001))


def test_dense_key_is_stable_across_runs_and_partitionings(spark):
    df = spark.range(0, 2000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("s"))
    a = {r.s: r.k for r in with_dense_key(df.repartition(5), ["s"], "k", 4).df.collect()}
    b = {r.s: r.k for r in with_dense_key(df.coalesce(1), ["s"], "k", 9).df.collect()}
    assert a == b


def test_dense_key_null_sorts_first(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "u string")
    got = {r.u: r.k for r in with_dense_key(df, ["u"], "k", 2).df.collect()}
    assert got == {None: 1, "a": 2, "b": 3}


def test_dense_key_empty_input(spark):
    df = spark.createDataFrame([], "u string")
    keyed = with_dense_key(df, ["u"], "k", 3)
    assert keyed.rows == 0 and keyed.df.count() == 0


def test_dense_key_with_many_partitions_uses_offset_table(spark, monkeypatch):
    from ledgerlake.operators import keys

    monkeypatch.setattr(keys, "_LITERAL_OFFSETS", 2)
    df = spark.range(0, 700).select((F.col("id") * 37 % 701).alias("a"))
    keyed = keys.with_dense_key(df, ["a"], "k", num_partitions=6)
    got = {(r.a,): r.k for r in keyed.df.collect()}
    assert got == _expected(df, ["a"])


def test_partition_count_follows_row_hint(spark, monkeypatch):
    from ledgerlake.operators import keys

    monkeypatch.setattr(keys, "ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(keys, "MIN_ROWS_PER_PARTITION", 10)
    df = spark.range(0, 1000).select(F.col("id").alias("a"))
    keyed = keys.with_dense_key(df, ["a"], "k", rows_hint=1000)
    assert keyed.df.rdd.getNumPartitions() == 10  # 100 rows each
    monkeypatch.setattr(keys, "ROWS_PER_PARTITION", 10_000)
    monkeypatch.setattr(keys, "MIN_ROWS_PER_PARTITION", 500)
    assert keys.with_dense_key(df, ["a"], "k", rows_hint=1000).df.rdd.getNumPartitions() == 2
    assert sorted(r.k for r in keyed.df.collect()) == list(range(1, 1001))


def test_dense_key_with_adaptive_partition_count(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7 % 3001).alias("a"))
    keyed = with_dense_key(df.repartition(5), ["a"], "k")
    assert {(r.a,): r.k for r in keyed.df.collect()} == _expected(df, ["a"])
