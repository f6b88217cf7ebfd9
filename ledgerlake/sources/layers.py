"""Readers of the written layers (raw JSON, clean Parquet, star Parquet, catalog tables)."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schemas as S
from ..session import session_settings
from ..sinks.versions import is_versioned, settled

# Spark packs compressed files up to 128 MB a task, which is millions of raw records to parse and sort at once; with this
# a task reads about one file of capped records, however many files there are
RAW_TASK_BYTES = "16MB"


def raw_reading(spark: SparkSession) -> AbstractContextManager[None]:
    """For the jobs that read a raw layer: tasks that don't grow with the layer."""
    return session_settings(spark, {"spark.sql.files.maxPartitionBytes": RAW_TASK_BYTES})


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Raw layer JSON lines with the declared schema (no inference, so an empty
    folder reads as zero rows instead of failing)."""
    return spark.read.schema(S.BRONZE).json(settled(spark, path))


def read_silver(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The clean layer, written by a batch or incrementally; with ``schema``, a layer that has no rows yet also reads (as empty)."""
    if "*" not in path and is_versioned(spark, path):
        from ..streaming.incremental import read_incremental  # the streaming package reads layers itself

        return read_incremental(spark, path, schema)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(settled(spark, path))
