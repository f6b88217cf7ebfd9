"""Parallelism for CPU-heavy per-row work."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread ``df`` over at least ``min_partitions`` tasks (default: the cluster's
    default parallelism) before expensive per-row work such as parsing documents.

    Only an input with fewer partitions than that is redistributed (round-robin,
    no key, no skew); a large input already split into many file partitions is
    returned unchanged, so this costs nothing at scale.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 -- Spark Connect: no partition count on the client
        return df
    if current >= target:
        return df
    return df.repartition(target)
