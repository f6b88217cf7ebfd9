"""Deterministic dense surrogate keys without a single-task global window.

``row_number() OVER (ORDER BY k)`` moves every row into one task. Here the
rows are range-partitioned on the key and sorted inside each partition, the
result is checkpointed to the shared folder (so every later read sees the
same split, also after an executor is lost; the checkpoint is written by the
job that counts the rows of each partition), those counts -- one number per
partition -- give each partition its starting offset, and each row's key is
its offset plus its position inside the partition. The result
equals ``row_number() OVER (ORDER BY k)`` on the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# monotonically_increasing_id() puts the partition index in the upper 31 bits
# and the record number inside the partition in the lower 33 bits.
_PARTITION_SHIFT = 33
# up to this many partitions the offsets are a literal array in the expression
_LITERAL_OFFSETS = 1024
# target size of a range partition when the row count is known
ROWS_PER_PARTITION = 2_000_000
MIN_ROWS_PER_PARTITION = 50_000


@dataclass
class Keyed:
    df: DataFrame
    rows: int
    # (surrogate key, natural key) pairs used to resolve foreign keys, when the natural
    # key is not one of the table's published columns
    lookup: DataFrame | None = None


def with_dense_key(
    df: DataFrame,
    order_by: list[str],
    key_name: str,
    num_partitions: int | None = None,
    rows_hint: int | None = None,
) -> Keyed:
    """Add a 1-based BIGINT ``key_name`` following ascending ``order_by`` (NULLs first).

    The ordering columns must identify a row (unique); duplicates would get
    distinct keys in an unspecified order. Range partitions: ``num_partitions``
    when given; with ``rows_hint`` (a known row count) enough that none exceeds
    ``ROWS_PER_PARTITION`` rows and, up to the session's shuffle partitions, none
    falls under ``MIN_ROWS_PER_PARTITION`` (an explicit count is never resized
    later); otherwise the session's count, left to adaptive execution to merge
    small adjacent ranges (order is kept).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if num_partitions is None and rows_hint:
        base = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # at most ROWS_PER_PARTITION rows per partition, and no tiny partitions either
        num_partitions = max(-(-rows_hint // ROWS_PER_PARTITION), min(base, -(-rows_hint // MIN_ROWS_PER_PARTITION)))
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *order_by)
    else:
        ranged = df.repartitionByRange(*order_by)
    ranged = ranged.sortWithinPartitions(*order_by)
    # reliable checkpoint, written right after the first job on it -- the per-partition
    # count below -- so the data is produced twice (count, write), not three times
    ranged = ranged.checkpoint(eager=False)

    pid = F.spark_partition_id()
    counts = dict(
        (r["pid"], r["n"]) for r in ranged.groupBy(pid.alias("pid")).agg(F.count("*").alias("n")).collect()
    )
    width = (max(counts) + 1) if counts else 1
    offsets, running = [], 0
    for p in range(width):
        offsets.append(running)
        running += counts.get(p, 0)

    position = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), _PARTITION_SHIFT)
    if width <= _LITERAL_OFFSETS:
        offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), pid + 1)
        keyed = ranged.withColumn(key_name, offset + position + F.lit(1))
    else:
        # many partitions: a broadcast table of one offset per partition (bounded by
        # the partition count) instead of a literal too large for generated code
        table = spark.createDataFrame(list(enumerate(offsets)), "__pid int, __off long")
        tagged = ranged.withColumn("__pid", pid).withColumn("__pos", position)
        keyed = (
            tagged.join(F.broadcast(table), "__pid")
            .withColumn(key_name, F.col("__off") + F.col("__pos") + F.lit(1))
            .drop("__pid", "__pos", "__off")
        )
    return Keyed(keyed, running)


def with_published_key(
    df: DataFrame,
    natural: str,
    key_name: str,
    published: DataFrame | None,
    num_partitions: int | None = None,
    rows_hint: int | None = None,
    keep_gone: bool = True,
) -> Keyed:
    """``with_dense_key`` that leaves published keys alone: a member that ``published`` has keeps its key, new ones are
    numbered after the highest, in order of ``natural``.

    ``df`` has one row per ``natural`` (NULL is a member). Its other columns are the current ones; a published member that
    ``df`` no longer has stays as it was (``keep_gone``), so that whatever was written with its key still resolves. The
    result is checkpointed: it stays readable when the published table is replaced.
    """
    if published is None:
        return with_dense_key(df, [natural], key_name, num_partitions, rows_hint)
    own, known = df.alias("own"), published.alias("known")
    same = F.col(f"own.`{natural}`").eqNullSafe(F.col(f"known.`{natural}`"))
    columns = [key_name, *df.columns]
    old = own.join(known.select(natural, key_name).alias("known"), same).select(f"known.{key_name}", *[f"own.{c}" for c in df.columns])
    added = with_dense_key(own.join(known, same, "left_anti"), [natural], key_name, num_partitions)
    most = published.agg(F.coalesce(F.max(key_name), F.lit(0))).first()[0]
    rows = old.select(*columns).unionByName(added.df.withColumn(key_name, F.col(key_name) + F.lit(most)).select(*columns))
    if keep_gone:
        rows = rows.unionByName(known.join(own, same, "left_anti").select(*columns))
    ensure_checkpoint_dir(df.sparkSession)
    rows = rows.checkpoint()
    return Keyed(rows, rows.count())
