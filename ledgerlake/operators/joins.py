"""Joins against dimension-like tables whose size is checked, not assumed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_SALT_BUCKETS = 16


def adaptive_skew_join(spark: SparkSession) -> bool:
    """Whether adaptive execution will split skewed partitions of a shuffle join."""
    conf = spark.conf
    return (conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
            and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true")


def join_sized(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str] | Column,
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    small_rows: int | None = None,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Join ``big`` with ``small``, broadcasting ``small`` only when it is proven small.

    ``small_rows`` may be passed when the count is already known (for example
    from surrogate-key assignment); otherwise it is counted -- one cheap job
    over a table that is normally checkpointed. Above the bound the join is a
    shuffle join. A key holding a large share of ``big`` is then split across
    tasks: by adaptive execution's skew-join handling when it is on, otherwise
    by salting -- each ``big`` row gets one of ``salt_buckets`` salts (a hash of
    the row) and ``small`` is replicated once per salt, so a hot key's rows go to
    ``salt_buckets`` tasks and every row still meets its match exactly once.
    """
    rows = small.count() if small_rows is None else small_rows
    if rows <= max_broadcast_rows:
        return big.join(F.broadcast(small), on, how)
    return skew_safe_join(big, small, on, how, salt_buckets)


def skew_safe_join(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str] | Column,
    how: str = "left",
    salt_buckets: int | None = None,
) -> DataFrame:
    """A join whose hot keys on the ``big`` side cannot all land in one task: a plain
    join when adaptive skew-join handling is on, otherwise salted (see ``join_sized``).
    The optimizer may still broadcast ``small`` from its size statistics."""
    if salt_buckets is None:
        salt_buckets = 0 if adaptive_skew_join(big.sparkSession) else DEFAULT_SALT_BUCKETS
    if salt_buckets <= 1 or how not in ("left", "left_outer", "inner"):
        return big.join(small, on, how)
    b = big.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(salt_buckets)))
    s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    if isinstance(on, Column):
        cond = on & (b["__salt"] == s["__salt"])
        return b.join(s, cond, how).drop(b["__salt"]).drop(s["__salt"])
    keys = [on] if isinstance(on, str) else list(on)
    return b.join(s, keys + ["__salt"], how).drop("__salt")
