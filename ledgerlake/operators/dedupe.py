"""Deduplication with a deterministic survivor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    where: Column | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order_by`` values.

    Ordering is lexicographic over ``order_by`` and then over every remaining
    column, so ties are broken the same way on every run; NULL sorts lowest.
    Written as an aggregate (``max`` of a struct), so each map task first
    reduces its own rows to one per key -- a key repeated in a third of the
    input still leaves each task with one row for it before the shuffle.

    ``where`` restricts the candidates inside the aggregate instead of with a
    filter in front of it: a filter would be pushed below the projection that
    computes its inputs and repeat that projection's expressions (for example
    a JSON parse) once per referenced column. ``columns`` selects the output
    columns (default: all of ``df``).
    """
    out_cols = columns or df.columns
    rest = [c for c in out_cols if c not in keys and c not in order_by]
    ordered = list(order_by) + rest
    value = F.struct(*[F.col(c) for c in ordered])
    if where is not None:
        value = F.when(where, value)
    agg = df.groupBy(*keys).agg(F.max(value).alias("__w"))
    if where is not None:
        agg = agg.filter(F.col("__w").isNotNull())
    return agg.select(*[F.col(c) if c in keys else F.col("__w")[c].alias(c) for c in out_cols])


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct combinations of ``cols`` (partial aggregation before the shuffle)."""
    return df.select(*cols).distinct()
