"""Incremental raw -> clean processing.

The batch clean layer re-reads the whole raw layer on every run. Here new raw files (or topic messages) are processed
once each: rows are typed and validated exactly as in batch, reduced to the latest copy per id, and added to the
layer -- one row per id for ever, the latest copy winning whenever it arrives, as in batch.

The layer is a few sorted-by-age *runs*, each with one row per id, named by a manifest (``sinks.versions``). A batch
writes a run of its own rows and nothing else; reading takes the latest copy per id over all runs. A run
is merged with the newer ones as soon as these together are as large, so sizes halve from run to run: there are
about log2(layer / batch) runs, and a row is rewritten about that many times in all, however many batches arrive.

Run, rejects and totals of a batch become visible by the same manifest, which also holds the number of the last batch of
each streaming query: a batch that is repeated after a failure changes nothing. A reader keeps the runs of the version it
started with.

    _versions/<n>.json                  manifests
    _batches/<n>/rejected=false|true    the latest valid copies of batch n, and every row that broke a rule
    _runs/<n>-<id>                      merged runs
    _totals/<n>.json                    rows of batch n, by reason
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .. import schemas as S
from ..operators.cleaning import INVALID_VALUE, NULL_REQUIRED, trim_columns
from ..operators.dedupe import latest_per_key
from ..plans.bronze import bronze_rows
from ..plans.silver import INVOICE_RULES, REASON, SilverRules, tag_rejects, typed_rows
from ..session import path_exists_any, remove_path, session_settings
from ..sinks.versions import commit, current, prune, write_text
from ..sinks.writers import write_silver
from ..sources.messages import read_topic_stream
from .republished import DROPPED, HELD, STATE_SETTINGS, state_buckets, without_republished

BATCHES, RUNS, TOTALS = "_batches", "_runs", "_totals"
TOTAL_COLUMNS = ["input", NULL_REQUIRED, INVALID_VALUE, "valid", "dropped", "held", "ids"]
_TOTALS_SCHEMA = StructType([StructField("version", LongType()), StructField("query", StringType()), StructField("batch", LongType())]
                            + [StructField(c, LongType()) for c in TOTAL_COLUMNS])


def _positions(rules: SilverRules) -> list[str]:
    return [f"_pos_{c}" for c in rules.order]


def tagged_stream(bronze_stream: DataFrame, rules: SilverRules = INVOICE_RULES) -> DataFrame:
    """Raw rows -> every row typed and trimmed, with its reject reason, its message position and the numbers of copies
    dropped and ids held before it (a row that only carries such numbers has no position)."""
    marks = [c for c in (DROPPED, HELD) if c in bronze_stream.columns]
    known = SilverRules(**{**vars(rules), "order": rules.order + marks}) if marks else rules
    tagged = tag_rejects(typed_rows(bronze_stream, known), rules)
    return trim_columns(tagged, rules.trimmed).select(
        *rules.fields, REASON, *[F.col(c).alias(p) for c, p in zip(rules.order, _positions(rules), strict=True)],
        *[(F.col(c) if marks else F.lit(0).cast("long")).alias(c) for c in (DROPPED, HELD)],
    )


def _counts(batch: DataFrame, message: str) -> list:
    there = F.col(message).isNotNull()
    reason, dropped = F.col(REASON), F.coalesce(F.sum(DROPPED), F.lit(0))
    return [
        (F.count_if(there) + dropped).alias("input"),
        F.count_if(there & (reason == NULL_REQUIRED)).alias(NULL_REQUIRED),
        F.count_if(there & (reason == INVALID_VALUE)).alias(INVALID_VALUE),
        (F.count_if(there & reason.isNull()) + dropped).alias("valid"),
        dropped.alias("dropped"),
        F.coalesce(F.sum(HELD), F.lit(0)).alias("held"),
    ]


def merge_batch(
    batch: DataFrame, path: str, query: str, batch_id: int, rules: SilverRules = INVOICE_RULES
) -> dict | None:
    """Add a batch of tagged rows to the layer; returns its totals, or None if it was added before.

    One job writes both outputs: valid rows are reduced to the latest per id by the same aggregation that passes
    every rejected row through on its own.
    """
    spark, positions = batch.sparkSession, _positions(rules)
    before = current(spark, path)
    if batch_id <= before.content.get("batches", {}).get(query, -1):
        return None
    number, folder = before.number + 1, f"{path}/{BATCHES}/{before.number + 1:020d}"
    remove_path(spark, folder)  # of an attempt that died before its manifest
    message = positions[-1]
    seen, grouped = Observation("seen"), Observation("grouped")
    rejected = F.col(REASON).isNotNull()
    rows = batch.observe(seen, *_counts(batch, message)).filter(F.col(message).isNotNull()).drop(DROPPED, HELD)
    alone = F.when(rejected, F.struct(*positions))
    latest = latest_per_key(rows.withColumn("_alone", alone), [rules.key, REASON, "_alone"], positions).drop("_alone")
    latest.withColumn("rejected", rejected).observe(grouped, F.count_if(~F.col("rejected")).alias("ids")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("rejected").parquet(folder)
    totals = {k: int(v or 0) for k, v in {**seen.get, **grouped.get}.items()}

    runs = list(before.content.get("runs", []))
    if totals["ids"]:
        runs = _with_run(spark, path, runs, {"folder": f"{BATCHES}/{number:020d}/rejected=false", "rows": totals["ids"]}, number, rules)
    write_text(spark, f"{path}/{TOTALS}/{number:020d}.json", json.dumps({"version": number, "query": query, "batch": batch_id, **totals}))
    batches = {**before.content.get("batches", {}), query: batch_id}
    commit(spark, path, {"runs": runs, "batches": batches}, before)
    prune(spark, path, lambda content: [r["folder"] for r in content.get("runs", [])], [RUNS])
    return totals


def _with_run(spark: SparkSession, path: str, runs: list[dict], new: dict, number: int, rules: SilverRules) -> list[dict]:
    """``runs`` (oldest first) and ``new``: from the first run on that is not larger than all behind it, they become one."""
    k, behind = len(runs), new["rows"]
    while k and runs[k - 1]["rows"] <= behind:
        k -= 1
        behind += runs[k]["rows"]
    if k == len(runs):
        return runs + [new]
    folder = f"{RUNS}/{number:020d}-{uuid.uuid4().hex[:12]}"
    rows = Observation("merged")
    merged = _latest(spark, path, runs[k:] + [new], rules)
    merged.observe(rows, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{folder}")
    return runs[:k] + [{"folder": folder, "rows": int(rows.get["rows"])}]


def _latest(spark: SparkSession, path: str, runs: list[dict], rules: SilverRules) -> DataFrame:
    rows = spark.read.parquet(*[f"{path}/{r['folder']}" for r in runs]).drop(REASON)
    return rows if len(runs) == 1 else latest_per_key(rows, [rules.key], _positions(rules))


def read_incremental(spark: SparkSession, path: str, schema: StructType | None = None, rules: SilverRules = INVOICE_RULES) -> DataFrame:
    """The layer as its newest version has it: one row per id. ``schema`` is that of a layer without rows."""
    runs = current(spark, path).content.get("runs", [])
    if not runs:
        if schema is None:
            raise ValueError(f"{path} has no rows yet: name the schema")
        return spark.createDataFrame([], schema)
    return _latest(spark, path, runs, rules).select(*rules.fields)


def write_snapshot(spark: SparkSession, path: str, target: str, schema: StructType | None = None) -> int:
    """The layer as one plain Parquet folder for readers that know nothing of manifests, swapped in whole; returns its rows."""
    return write_silver(read_incremental(spark, path, schema), target)


def read_rejects(spark: SparkSession, path: str, rules: SilverRules = INVOICE_RULES) -> DataFrame:
    """Every row of every batch that broke a rule, with its reason and message position."""
    last = current(spark, path).number
    fields = [StructField(c, DoubleType() if c in rules.amounts else StringType()) for c in rules.fields]
    positions = [StructField(p, S.BRONZE[c].dataType) for c, p in zip(rules.order, _positions(rules), strict=True)]
    schema = StructType(fields + [StructField(REASON, StringType())] + positions)
    if not path_exists_any(spark, f"{path}/{BATCHES}/*/rejected=true"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{path}/{BATCHES}/*/rejected=true")
    written = F.regexp_extract(F.col("_metadata.file_path"), f"/{BATCHES}/([0-9]+)/rejected=true/", 1).cast("long")
    return rows.filter(written <= last)  # not those of a batch that is being added


def batch_totals(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch: ``version, query, batch``, rows read, rejected by reason, valid, dropped in flight, and ids."""
    return spark.read.schema(_TOTALS_SCHEMA).json(f"{path}/{TOTALS}").filter(F.col("version") <= current(spark, path).number)


def stream_reject_counts(spark: SparkSession, path: str, rules: SilverRules = INVOICE_RULES) -> DataFrame:
    """``stage, rows`` over all batches so far, with the stages of the batch's ``SilverResult.reject_counts``."""
    sums = batch_totals(spark, path).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("input", NULL_REQUIRED, INVALID_VALUE, "valid")])
    runs = current(spark, path).content.get("runs", [])
    output = _latest(spark, path, runs, rules).agg(F.count(F.lit(1)).alias("n")) if runs else spark.range(1).select(F.lit(0).cast("long").alias("n"))
    sums = sums.withColumn("output", output.scalar()).withColumn("duplicate", F.col("valid") - F.col("output"))
    stages = ["input", NULL_REQUIRED, INVALID_VALUE, "duplicate", "output"]
    return sums.select(F.inline(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).cast("long").alias("rows")) for s in stages])))


def bronze_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.BRONZE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)


def run_incremental_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int | None = None,
    keep_for: str | None = None,
) -> dict:
    """Process every raw file not processed yet (``availableNow``), add them to the clean
    layer, and stop. Progress lives in ``checkpoint_path`` (shared storage), so a
    rerun or a restarted job continues where the last one ended. With ``keep_for``, copies of a message that was
    processed within that time are dropped before they are parsed (``streaming.republished``)."""
    return _run_available(bronze_file_stream(spark, bronze_path, max_files_per_trigger), silver_path, checkpoint_path, keep_for, bronze_path)


def run_incremental_silver_from_topic(
    spark: SparkSession,
    brokers: str,
    topic: str,
    silver_path: str,
    checkpoint_path: str,
    max_offsets_per_trigger: int | None = None,
    keep_for: str | None = None,
) -> dict:
    """The same, reading the message topic directly (raw projection applied in flight)."""
    messages = read_topic_stream(spark, brokers, topic, max_offsets_per_trigger=max_offsets_per_trigger)
    return _run_available(bronze_rows(messages), silver_path, checkpoint_path, keep_for)


def run_incremental_silver_from_messages(
    spark: SparkSession,
    message_dir: str,
    silver_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int | None = None,
    keep_for: str | None = None,
) -> dict:
    """The same over a message folder with the topic's record layout (what the ingest
    stage writes when no broker is available)."""
    reader = spark.readStream.schema(S.KAFKA_RECORD).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _run_available(bronze_rows(reader.parquet(message_dir)), silver_path, checkpoint_path, keep_for, message_dir)


def _run_available(raw: DataFrame, silver_path: str, checkpoint_path: str, keep_for: str | None, files: str | None = None) -> dict:
    """Totals of the batches of this run, summed (``held``: of the last), with the number of batches and of the layer's version."""
    spark, path = raw.sparkSession, silver_path.rstrip("/")
    sums = dict.fromkeys(["batches", *TOTAL_COLUMNS], 0)

    def add(batch: DataFrame, batch_id: int) -> None:
        # the query keeps its id over restarts from the same checkpoint
        totals = merge_batch(batch, path, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), batch_id)
        for k, v in ({"batches": 1, **totals} if totals else {}).items():
            sums[k] = v if k == "held" else sums[k] + v

    kept = without_republished(raw, keep_for, buckets=state_buckets(spark, checkpoint_path, files)) if keep_for else raw
    with session_settings(spark, STATE_SETTINGS if keep_for else {}):  # a query has the settings that it started with
        query = tagged_stream(kept).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return {**sums, "rows": sums["input"], "version": current(spark, path).number}
