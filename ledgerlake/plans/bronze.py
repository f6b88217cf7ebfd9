"""Raw layer: message records kept as they were published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bronze_rows(messages: DataFrame) -> DataFrame:
    """Kafka-shaped records -> ``payload, partition, offset, timestamp``.

    The value bytes become UTF-8 text untouched; nothing is parsed here.
    """
    return messages.select(
        F.col("value").cast("string").alias("payload"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )
