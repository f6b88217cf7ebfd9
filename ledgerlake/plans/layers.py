"""Stage entry points: each stage reads its input layer, writes its output layer and
returns the totals it observed while writing (no cache, no second pass).

    load_bronze  messages -> raw JSON
    load_silver  raw JSON -> clean Parquet (+ quarantine of rejected rows)
    validate_silver  clean Parquet -> quality gate (raises on failure)
    load_gold    clean Parquet -> four star tables
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession

from .. import schemas as S
from ..operators.quality import enforce, quality_report
from ..operators.cleaning import trim_columns
from ..session import DEFAULT_TIME_ZONE, path_exists, remove_path, scratch_path
from ..sinks.versions import settled
from ..sinks.writers import STAR_TABLES, read_star, write_bronze, write_observed, write_silver, write_star
from ..sources.layers import raw_reading, read_bronze, read_silver
from .bronze import bronze_rows
from .ledger import Ledger
from .silver import SilverResult, clean, observed_counts
from .star import DATE_GRAIN, build_star

log = logging.getLogger("ledgerlake.stages")


def load_bronze(messages: DataFrame, bronze_path: str) -> int:
    """Messages (Kafka-shaped) -> raw layer; returns rows written."""
    rows = write_bronze(bronze_rows(messages), bronze_path)
    log.info("raw layer: %d rows written to %s", rows, bronze_path)
    return rows


def load_silver(spark: SparkSession, bronze_path: str, silver_path: str, quarantine_path: str | None = None) -> dict[str, int]:
    """Raw layer -> clean layer; returns rows read, per reject reason, and written."""
    seen = Observation("clean_rows")
    res = clean(read_bronze(spark, bronze_path), observation=seen)
    if quarantine_path:
        # the survivors are kept with their message position, so that rejects need no second deduplication
        kept = scratch_path(spark, "survivors")
        with raw_reading(spark):
            write_observed(res.survivors, kept, "parquet")
        survivors = spark.read.schema(res.survivors.schema).parquet(kept)
        res = SilverResult(res.tagged, survivors, trim_columns(survivors, res.rules.trimmed).select(*res.rules.fields), res.rules)
    with raw_reading(spark):
        written = write_silver(res.silver, silver_path)
    totals = observed_counts(seen, written)
    totals["written"] = written
    if quarantine_path:
        with raw_reading(spark):
            totals["quarantined"] = write_observed(res.quarantine(), quarantine_path, "parquet")
        remove_path(spark, kept)
    log.info("clean layer: %s", totals)
    if totals.get("input", 0) > written:
        log.warning("clean layer: %d rows rejected (%s)", totals["input"] - written,
                    {k: v for k, v in totals.items() if k in ("null_required", "invalid_value", "duplicate")})
    return totals


def validate_silver(spark: SparkSession, silver_path: str, expected_rows: int | None, ledger: Ledger | None = None) -> list[dict]:
    """The quality gate: raises ``QualityGateError`` (stopping the run before the star is
    built) when any check fails; returns the check rows otherwise. Without ``expected_rows`` the layer is held against the
    valid ids that the ``ledger`` has as published."""
    df = read_silver(spark, silver_path)
    expected = ledger.expected(spark) if ledger and expected_rows is None else expected_rows
    try:
        rows = enforce(quality_report(df, "id_nfe", S.REQUIRED_FIELDS, S.POSITIVE_FIELDS, S.NON_NEGATIVE_FIELDS, expected))
    except Exception:
        log.error("quality gate failed for %s", silver_path)
        raise
    log.info("quality gate passed: %s", {r["check"]: r["observed"] for r in rows})
    return rows


def load_gold(
    spark: SparkSession, silver_path: str, gold_path: str, time_zone: str = DEFAULT_TIME_ZONE, grain: str = DATE_GRAIN, renumber: bool = False
) -> dict[str, int]:
    """Clean layer -> star tables under ``gold_path/<table>``; returns rows per table.

    Members that the tables there have keep their keys, unless ``renumber`` (or the timestamp grain, whose calendar can't
    tell its members apart) asks for new ones.
    """
    there = grain == DATE_GRAIN and not renumber and all(path_exists(spark, settled(spark, f"{gold_path.rstrip('/')}/{t}")) for t in STAR_TABLES)
    published = {t: k.df for t, k in read_star(spark, gold_path, dict.fromkeys(STAR_TABLES, 0)).items()} if there else None
    star = build_star(read_silver(spark, silver_path), time_zone=time_zone, grain=grain, published=published)
    rows = write_star(star.tables(), gold_path)
    log.info("star schema: %s written to %s", rows, gold_path)
    return rows
