"""Copies of messages that a scheduled publication repeats, dropped in flight with bounded state.

The publication repeats every message as long as its document lies in the folder. Per id, the state holds content and
position of the latest copy seen. A copy not later than that loses to it anyway; a later one of the same
content changes nothing but the position: both are dropped. A later one of other content goes through.
An id is held for a time after its last copy, so the state is bounded by the ids of that time. The layer is that
of the batch as long as no copy comes in that much later than a copy published after it.

The time is the processing time: by event time the engine would drop rows that come in late, which are first
copies as often as not. State is kept by bucket of ids, so that a batch works on whole columns; a row that breaks a rule
goes through without state. A task holds a bucket at a time: there are as many as the files of the first run ask for. The
states themselves lie in RocksDB, on the executors' disks, in memory of a fixed size: on the heap they would grow with the ids.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..plans.silver import INVOICE_RULES, REASON, SilverRules, tag_rejects, typed_rows
from ..session import file_system, path_exists, ship
from ..sinks.versions import _read_text, write_text

ship("ledgerlake.streaming")

DROPPED, HELD = "_dropped", "_held"
BUCKETS = 256  # of the state, at least; their number stays for the life of a checkpoint
BUCKET_BYTES = 1 << 20  # of raw files in the first run, for each bucket: compressed, some 30 000 messages
# a checkpoint that has states on the heap keeps them there
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",  # of an executor
}
_POSITION = ["timestamp", "partition", "offset"]
_OUT = f"payload string, partition int, offset long, timestamp timestamp, {DROPPED} long, {HELD} long"
_UNITS = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def milliseconds(keep_for: str) -> int:
    """``24 hours`` and the like."""
    m = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", keep_for)
    if not m:
        raise ValueError(f"not a time: {keep_for!r}")
    return int(m[1]) * _UNITS[m[2]]


def newer_copies(rows: pd.DataFrame, held: pd.DataFrame, now: int, keep_ms: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The rows that change the layer, and the state after them. Columns: id, content and position; held also has when it
    was last seen."""
    latest = rows.sort_values(["id", *_POSITION]).drop_duplicates("id", keep="last")
    both = latest.merge(held, on="id", how="left", suffixes=("", "_held"))
    known = both["seen"].notna()
    later = pd.Series(False, index=both.index)
    for c in reversed(_POSITION):
        later = (both[c] > both[c + "_held"]) | ((both[c] == both[c + "_held"]) & later)
    out = both[~known | (later & (both["content"] != both["content_held"]))]
    stale = both[known & ~later]["id"]
    touched = held[held["id"].isin(stale)].assign(seen=now)
    rest = held[~held["id"].isin(both["id"]) & (held["seen"] > now - keep_ms)]
    moved = both[~known | later][["id", "content", *_POSITION]].assign(seen=now)
    after = pd.concat([x for x in (rest, touched, moved) if len(x)] or [held.iloc[:0]])
    return out[rows.columns], after


def state_buckets(spark: SparkSession, checkpoint: str, files: str | None = None) -> int:
    """The number of buckets of a checkpoint, noted there; of a new one, by the size of the ``files`` (a glob) that there are."""
    note = f"{checkpoint.rstrip('/')}/buckets.json"
    if path_exists(spark, note):
        return json.loads(_read_text(spark, note))
    buckets = BUCKETS
    if files and not path_exists(spark, f"{checkpoint.rstrip('/')}/offsets"):  # one that is older than such notes has BUCKETS
        fs, pattern = file_system(spark, files)
        found = fs.globStatus(pattern) or []
        buckets = max(BUCKETS, -(-sum(fs.getContentSummary(f.getPath()).getLength() for f in found) // BUCKET_BYTES))
        write_text(spark, note, json.dumps(buckets))
    return buckets


def _packed(held: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    t = pa.Table.from_pandas(held, preserve_index=False)
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(t)
    return sink.getvalue().to_pybytes()


def without_republished(bronze: DataFrame, keep_for: str, rules: SilverRules = INVOICE_RULES, buckets: int = BUCKETS) -> DataFrame:
    """Raw rows without the copies that can't change the layer. A row without a message per bucket and batch has the
    number of copies dropped (``DROPPED``) and of ids held (``HELD``)."""
    keep_ms = milliseconds(keep_for)
    typed = tag_rejects(typed_rows(bronze, SilverRules(**{**vars(rules), "order": [*_POSITION, "payload"]})), rules)
    bucket = F.pmod(F.xxhash64(F.coalesce(F.col(rules.key), F.col("offset").cast("string"))), F.lit(buckets)).alias("_bucket")
    rows = typed.select(bucket, F.col(rules.key).alias("id"), F.md5("payload").alias("content"), *_POSITION, "payload", F.col(REASON).isNotNull().alias("broken"))

    def step(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts))
        broken = rows[rows["broken"]]
        valid = rows[~rows["broken"]].drop(columns=["broken", "_bucket"], errors="ignore")
        if state.exists:
            held = pa.ipc.open_stream(state.get[0]).read_pandas()
        else:
            held = valid.iloc[:0][["id", "content", *_POSITION]].assign(seen=pd.Series(dtype="int64"))
        through, held = newer_copies(valid, held, state.getCurrentProcessingTimeMs(), keep_ms)
        state.update((_packed(held),))
        any_time = rows["timestamp"].iloc[0]
        mark = pd.DataFrame({"payload": [""], "partition": [0], "offset": [-1], "timestamp": [any_time], DROPPED: [len(valid) - len(through)], HELD: [len(held)]})
        yield pd.concat([x.assign(**{DROPPED: 0, HELD: 0})[list(mark.columns)] for x in (broken, through) if len(x)] + [mark])

    kept = rows.groupBy("_bucket").applyInPandasWithState(step, _OUT, "held binary", "append", GroupStateTimeout.NoTimeout)
    message = F.col("offset") >= 0
    return kept.select(*[F.when(message, F.col(c)).alias(c) for c in ("payload", "partition", "offset", "timestamp")], DROPPED, HELD)
