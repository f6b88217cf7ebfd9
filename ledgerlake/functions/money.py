"""Exact money arithmetic.

Amounts are DOUBLE at the published schema. Sums are taken in DECIMAL(18,2)
so a result does not depend on the order rows are added in (which differs
between runs and partitionings), and rounded means are computed exactly in
integer cents with half-away-from-zero rounding -- the rule SQL ``ROUND``
uses -- instead of rounding a binary mean that may sit just off a half cent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_money(col: Column | str) -> Column:
    """Amount as DECIMAL(18,2) (half-up); NULL for NaN, infinities and amounts beyond it."""
    return _c(col).try_cast(MONEY)


# amounts a DECIMAL(18,2) can hold lie below this
AMOUNT_LIMIT = 1e16


def money_text(col: Column | str) -> Column:
    """Amount as fixed two-decimal text (``1013.70``), the invoice document format."""
    return to_money(col).cast("string")


def exact_sum(col: Column | str) -> Column:
    """Order-independent sum of an amount column (DECIMAL)."""
    return F.sum(to_money(col))


def as_double(col: Column | str) -> Column:
    return _c(col).cast("double")


def rounded_mean(total: Column | str, count: Column | str) -> Column:
    """``ROUND(total / count, 2)`` computed exactly, as DOUBLE.

    ``total`` is an exact DECIMAL sum with two places, ``count`` the number of
    non-NULL values that were summed. Works in integer cents:
    ``sign(t) * floor((2*|t| + n) / (2*n)) / 100``.
    """
    t = _c(total)
    n = _c(count).cast("long")
    cents = F.abs(t * 100).cast(DecimalType(38, 0))
    twice = (cents * 2 + n).cast(DecimalType(38, 0))
    # integral division: a decimal quotient is rounded to few places, which can lift it over the next cent
    q = F.call_function("div", twice, F.nullif(n * 2, F.lit(0)).cast(DecimalType(38, 0)))
    return F.when(n > 0, F.signum(t) * q / F.lit(100.0))


def sql_rounded_mean(total_sql: str, count_sql: str) -> str:
    """The same recipe as SQL text (used by the oracle queries)."""
    return (
        f"CAST(SIGN({total_sql}) * ((2 * CAST(ABS({total_sql}) * 100 AS HUGEINT) + ({count_sql}))"
        f" // (2 * ({count_sql}))) AS DOUBLE) / 100"
    )
