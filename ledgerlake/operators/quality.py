"""Quality gate of the clean layer: all checks in one aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cleaning import any_null, values_invalid

CHECK_SCHEMA = "check string, observed bigint, expected bigint, passed boolean"


class QualityGateError(RuntimeError):
    """Raised when the clean layer breaks a rule; ``failures`` holds the failing rows."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        msg = "; ".join(f"{f['check']}: observed {f['observed']}, expected {f['expected']}" for f in failures)
        super().__init__(f"quality gate failed: {msg}")


def quality_report(
    df: DataFrame,
    key: str,
    required: list[str],
    positive: list[str],
    non_negative: list[str],
    expected_rows: int | DataFrame | None = None,
) -> DataFrame:
    """One row per check: ``check, observed, expected, passed``.

    Checks: total rows (against ``expected_rows``; a one-row DataFrame with a
    column ``expected`` may supply it; without it the check is undecided,
    ``passed`` NULL), duplicate keys,
    invalid amounts (NULL not counted, as the written rule), NULL amounts
    (counted separately), NULL required fields. One scan; the distinct-key
    count is the only shuffle.
    """
    stats = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.col(key)).alias("distinct_keys"),
        F.count(F.when(F.col(key).isNull(), 1)).alias("null_keys"),
        F.count_if(F.coalesce(values_invalid(positive, non_negative), F.lit(False))).alias("invalid_values"),
        F.count_if(any_null(positive + non_negative)).alias("null_amounts"),
        F.count_if(any_null(required)).alias("null_required"),
    )
    if isinstance(expected_rows, DataFrame):
        # a scalar subquery: the expectation is computed on the executors, not passed through the driver
        stats = stats.withColumn("expected_rows", expected_rows.select(F.col("expected").cast("long")).scalar())
    else:
        exp = None if expected_rows is None else int(expected_rows)
        stats = stats.withColumn("expected_rows", F.lit(exp).cast("long"))
    # dropping duplicates keeps one row per distinct key, NULL counting as one key
    dup = F.col("rows") - F.col("distinct_keys") - F.when(F.col("null_keys") > 0, 1).otherwise(0)
    rows = [
        ("row_count", F.col("rows"), F.col("expected_rows")),
        ("duplicate_keys", dup, F.lit(0)),
        ("invalid_values", F.col("invalid_values"), F.lit(0)),
        ("null_amounts", F.col("null_amounts"), F.lit(0)),
        ("null_required", F.col("null_required"), F.lit(0)),
    ]
    checks = F.array(
        *[
            F.struct(F.lit(n).alias("check"), o.cast("long").alias("observed"), e.cast("long").alias("expected"))
            for n, o, e in rows
        ]
    )
    out = stats.select(F.inline(checks))
    return out.withColumn("passed", F.col("observed") == F.col("expected"))


def enforce(report: DataFrame) -> list[dict]:
    """Stop when any check failed; returns the (few) check rows otherwise."""
    rows = [r.asDict() for r in report.collect()]
    failures = [r for r in rows if r["passed"] is False]
    if failures:
        raise QualityGateError(failures)
    return rows


def require_not_empty(df: DataFrame, what: str = "source") -> None:
    """Fail when a source holds no rows; reads at most one row."""
    if df.isEmpty():
        raise QualityGateError([{"check": f"{what}_not_empty", "observed": 0, "expected": 1, "passed": False}])
