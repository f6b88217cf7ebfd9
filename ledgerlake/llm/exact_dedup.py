"""Operator 10: exact duplicates by 128-bit content hash, confirmed byte for byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import HOT_SHARE, SPACES, attach, checkpointed, table, text_of, whole_rows


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash_of: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per row of ``docs``: _row (its position id), the id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after replacing each run of white space by one space; null is empty.
    Rows are grouped by ``hash_of``; then the texts of groups of several rows are compared as bytes (they
    are part of the grouping key), so a collision of the hash never joins two texts. In each class of equal
    texts the row of the smallest id stays; among repeated rows of that id exactly one does; null ids come
    after all others. An empty table gives an empty result. A very long text is compared whole. Extra columns
    are ignored, whatever their names.

    Scale: the counts by hash and by text are reduced in the map tasks first; a hash held by more than one
    row in a thousand (fewer than a thousand such hashes) is joined by broadcast, salted where its texts
    are compared, so no group meets in one task. Texts move only for groups of more than one row.
    ``docs`` is scanned twice and must number its rows alike both times (a table scan does).
    """
    norm = F.regexp_replace(text_of(text_col), SPACES, " ")
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), norm.alias("_text"))
    rows = rows.withColumn("_hash", hash_of(F.col("_text")))
    marks = checkpointed(rows.select("_row", "_id", "_hash", F.sha2("_text", 256).alias("text_sha256")))
    total = marks.count()

    first = [
        F.min("_id").alias("_keep_id"),
        F.coalesce(F.min_by("_row", "_id"), F.min("_row")).alias("_keep_row"),
        F.count(F.lit(1)).alias("_n"),
    ]
    by_hash = checkpointed(marks.groupBy("_hash").agg(*first))

    # the texts of groups of several rows, compared as bytes: hash and text together are the grouping key
    several = by_hash.filter("_n > 1").select("_hash", F.col("_n").alias("_of_hash"))
    hot = several.filter(F.col("_of_hash") * HOT_SHARE > total).select("_hash")
    salts = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_salt")
    wanted = several.join(F.broadcast(hot), "_hash", "left_anti").select("_hash", F.lit(0).alias("_salt"))
    wanted = wanted.unionByName(hot.select("_hash", salts))
    salted = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "_hash", "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("_row"), F.lit(64))).otherwise(F.lit(0)).cast("int")
    )
    pieces = (
        salted.join(wanted, ["_hash", "_salt"], "left_semi")
        .groupBy("_hash", "_salt", "_text")
        .agg(*first)
        .withColumn("_sha", F.sha2("_text", 256))
    )
    again = [
        F.min("_keep_id").alias("_keep_id"),
        F.coalesce(F.min_by("_keep_row", "_keep_id"), F.min("_keep_row")).alias("_keep_row"),
        F.sum("_n").alias("_n"),
    ]
    classes = checkpointed(pieces.groupBy("_hash", "_text", "_sha").agg(*again).drop("_text"))
    collided = classes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_classes")).filter("_classes > 1").select("_hash")
    collided = checkpointed(collided)

    plain = by_hash.join(collided, "_hash", "left_anti")
    out = attach(marks.join(collided, "_hash", "left_anti"), checkpointed(plain), ["_hash"], "_n", total)
    # rows of collided hashes: told apart by their text (a hash of a text of its class, compared above as bytes)
    told = marks.join(collided, "_hash", "left_semi").join(
        classes.withColumnRenamed("_sha", "text_sha256"), ["_hash", "text_sha256"]
    )
    out = out.unionByName(told.select(out.columns))
    return out.select(
        "_row",
        F.col("_id").alias(id_col),
        F.col("_keep_id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_keep_row")).alias("kept"),
        "text_sha256",
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("_row")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact deduplication keeps, whole."""
    gone = exact_dedup(docs).filter(~F.col("kept")).select("_row")
    return whole_rows(docs).join(gone, "_row", "left_anti").select("_doc.*")


SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
"""
