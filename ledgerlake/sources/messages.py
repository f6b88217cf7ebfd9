"""Message topics (Kafka) as batch and streaming sources.

The Kafka connector is not bundled with Spark; on a cluster it is added with
``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>``.
Without it, ``load()`` fails with Spark's own "data source not found" error,
which is re-raised here with that hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(brokers: str, topic: str, starting_offsets: str = "earliest", ending_offsets: str | None = "latest") -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": starting_offsets}
    if ending_offsets is not None:
        opts["endingOffsets"] = ending_offsets
    return opts


def _load(reader, what: str) -> DataFrame:
    try:
        return reader.load()
    except Exception as exc:  # noqa: BLE001
        if "kafka" in str(exc).lower() and ("not find" in str(exc).lower() or "DATA_SOURCE_NOT_FOUND" in str(exc)):
            raise RuntimeError(
                f"{what}: the Kafka connector is not on the classpath (spark-sql-kafka-0-10)"
            ) from exc
        raise


def _min_partitions(spark: SparkSession, min_partitions: int | None) -> str:
    # a topic with few partitions (or one partition holding most messages) is split
    # into offset ranges so the read is spread over the cluster's cores
    if min_partitions:
        return str(min_partitions)
    try:
        return str(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 -- Spark Connect
        return spark.conf.get("spark.sql.shuffle.partitions", "200")


def read_topic(
    spark: SparkSession, brokers: str, topic: str, starting_offsets: str = "earliest", min_partitions: int | None = None
) -> DataFrame:
    """Every message of the topic up to the latest offset (batch): ``key, value, topic,
    partition, offset, timestamp, timestampType``. Each topic partition's offset range is
    split into at least ``min_partitions`` tasks overall (default: default parallelism)."""
    reader = (
        spark.read.format("kafka")
        .options(**topic_options(brokers, topic, starting_offsets))
        .option("minPartitions", _min_partitions(spark, min_partitions))
    )
    return _load(reader, "read_topic")


def read_topic_stream(
    spark: SparkSession, brokers: str, topic: str, starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None
) -> DataFrame:
    """The topic as an unbounded source for incremental processing."""
    reader = (
        spark.readStream.format("kafka")
        .options(**topic_options(brokers, topic, starting_offsets, None))
        .option("minPartitions", _min_partitions(spark, None))
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return _load(reader, "read_topic_stream")
