"""Operator 8: mix sources to target weights with whole copies and Pareto order sampling."""

from __future__ import annotations

from functools import reduce
from math import lcm

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import attach, checkpointed, table, whole_rows, words_of

WEIGHTS = (5, 2, 1)  # of the sources in code point order, repeating
MOST_COPIES = 3  # of a source's size, and of any document
BINS = 4096


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``sources`` (source, source_size, one row each) with _weight and target.

    Targets share the whole size by weight; none is above ``most`` times its source's size, the excess
    going to the others by weight. The capped sources are those with the smallest size per weight, so one
    ordered pass over the sources (a row per source, not per document) finds them exactly.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    unit = lcm(*weights)
    kinds = F.array(*[F.lit(int(w)) for w in weights])
    s = sources.withColumn(
        "_weight", F.element_at(kinds, (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    )
    light = Window.orderBy(F.col("source_size") * (F.lit(unit) / F.col("_weight")).cast("long"), F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = light.rowsBetween(Window.unboundedPreceding, -1)
    onward = light.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.withColumn("_all", F.sum("source_size").over(every))
    s = s.withColumn("_left", F.col("_all") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    s = s.withColumn("_of", F.sum("_weight").over(onward))
    s = s.withColumn("_capped", most * F.col("source_size") * F.col("_of") <= F.col("_left") * F.col("_weight"))
    free = F.sum(F.when(~F.col("_capped"), F.col("_weight"))).over(every)
    used = F.coalesce(F.sum(F.when(F.col("_capped"), most * F.col("source_size"))).over(every), F.lit(0))
    shared = ((F.col("_all") - used) * F.col("_weight")).cast("double") / free.cast("double")
    return s.withColumn("target", F.when(F.col("_capped"), (most * F.col("source_size")).cast("double")).otherwise(shared)).drop(
        "_all", "_left", "_of", "_capped"
    )


def _rows(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: str) -> DataFrame:
    """The rows of ``docs`` as _doc, and what a decision needs: _row, _id, source, _key, _size and _u, uniform by id."""
    doc = lambda c: F.col("_doc")[c]
    digits = F.substring(F.md5(F.concat(F.coalesce(doc(id_col).cast("string"), F.lit("")), F.lit(seed))), 1, 13)
    text = F.coalesce(doc(text_col), F.lit(""))
    return whole_rows(docs).select(
        "_doc",
        "_row",
        doc(id_col).cast("long").alias("_id"),
        doc(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("s"), doc(source_col)), F.lit("n")).alias("_key"),
        F.size(words_of(text)).cast("long").alias("_size"),
        ((F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)).alias("_u"),
    )


def _ranked(rows: DataFrame) -> DataFrame:
    """Pareto ranking variable, odds of the uniform over odds of inclusion, mapped to [0, 1) and binned twice."""
    odds = (F.col("_u") / (1 - F.col("_u"))) / (F.col("_share") / (1 - F.col("_share")))
    out = rows.withColumn("_v", F.when(F.col("_share") > 0, odds / (1 + odds)).otherwise(F.lit(0.0)))
    fine = F.col("_v") * BINS
    return (
        out.withColumn("_b1", F.floor(fine))
        .withColumn("_b2", F.floor((fine - F.floor(fine)) * BINS))
        .withColumn("_at", F.struct(F.col("_v").alias("v"), F.coalesce(F.col("_id"), F.lit(-(2**63))).alias("i"), F.col("_row").alias("r")))
    )


def _edge(rows: DataFrame, bin_col: str, base: str | None, keep: list[str], to: str, at: str) -> DataFrame:
    """Per source the first bin not wholly within the rest, and what all bins before it hold."""
    sums = rows.groupBy("_key", bin_col, *keep).agg(F.sum("_size").alias("n"))
    w = Window.partitionBy("_key").orderBy(bin_col)
    start = F.col(base) if base else F.lit(0)
    upto = start + F.sum("n").over(w)
    sums = sums.withColumn("_upto", upto).filter(F.col("_upto") > F.col("_rest"))
    first = Window.partitionBy("_key").orderBy(bin_col)
    sums = sums.withColumn("_i", F.row_number().over(first)).filter("_i = 1")
    return sums.select("_key", F.col(bin_col).alias(to), (F.col("_upto") - F.col("n")).alias(at))


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = "",
) -> tuple[DataFrame, DataFrame, int]:
    """(rows, sources, total): the narrow rows of ``docs``; per source its size, target and cut."""
    rows = checkpointed(_rows(docs, id_col, source_col, text_col, seed).drop("_doc"))
    sums = rows.groupBy("_key", "source").agg(F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    targets = source_targets(sums, weights, most)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("_whole", F.floor(copies)).withColumn("_share", copies - F.floor(copies))
    targets = checkpointed(targets.withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")))
    total = rows.count()

    ranked = _ranked(attach(rows.drop("source"), targets, ["_key"], "_docs", total)).filter("_share > 0 AND _size > 0")
    edge1 = checkpointed(_edge(ranked, "_b1", None, ["_rest"], "_e1", "_c1"))
    near = ranked.join(edge1.withColumnRenamed("_e1", "_b1"), ["_key", "_b1"])
    edge2 = checkpointed(_edge(near, "_b2", "_c1", ["_rest", "_c1"], "_e2", "_c2"))
    close = near.join(edge2.withColumnRenamed("_e2", "_b2"), ["_key", "_b2"])
    w = Window.partitionBy("_key").orderBy("_at")
    so_far = F.col("_c2") + F.sum("_size").over(w) - F.col("_size")
    cut = (
        close.withColumn("_before", so_far)
        .filter(F.col("_before") + F.col("_size") / 2.0 <= F.col("_rest"))
        .groupBy("_key")
        .agg(F.max("_at").alias("_cut"))
    )
    sources = reduce(lambda a, b: a.join(b, "_key", "left"), (edge1.drop("_c1"), edge2.drop("_c2"), cut), targets)
    return rows, checkpointed(sources.drop("_weight", "_rest")), total


def _decided(rows: DataFrame, sources: DataFrame, total: int) -> DataFrame:
    """``rows`` with _copies: the whole copies of its source, and one more if it ranks before the cut."""
    out = _ranked(attach(rows, sources, ["_key"], "_docs", total))
    within = (F.col("_b1") < F.col("_e1")) | (
        (F.col("_b1") == F.col("_e1"))
        & ((F.col("_b2") < F.col("_e2")) | ((F.col("_b2") == F.col("_e2")) & F.coalesce(F.col("_at") <= F.col("_cut"), F.lit(False))))
    )
    more = F.when((F.col("_share") > 0) & (F.col("_size") > 0) & within, 1).otherwise(0)
    return out.withColumn("_copies", (F.col("_whole") + more).cast("int"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken (words, repeats counted), copies.

    The size of a document is its number of words (null text: 0). Each source's expected copies,
    target / source size, split into whole copies, which every document gets, and a share, the inclusion
    probability of one more. For that one the documents of a source rank by Pareto order sampling (odds of
    a uniform drawn from the id over the odds of inclusion); they are taken in this order while at least
    half of the next lies within the words still to take, so the size of the sample is fixed in words and a
    source misses its target by at most half of one document. Null sources are a source of their own.
    A source without words gets no copies; an empty table gives none. A very long text counts by its words; other columns
    are ignored, whatever their names. Repeated rows are separate documents of equal rank, ordered by
    position. Nothing is random between reruns.

    Scale: the rank is cut by sums over 4096 bins of the rank, then over 4096 bins of the bin at the edge,
    and only the documents of one such bin are ordered; no source meets in one task. ``docs`` must number
    its rows alike when scanned again (a table scan does).
    """
    rows, sources, total = mix_plan(docs, **options)
    out = _decided(rows.drop("source"), sources.drop("source"), total)
    return out.select(
        F.col("_id").alias(options.get("id_col", "doc_id")),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_copies") * F.col("_size")).cast("long").alias("taken"),
        F.col("_copies").alias("copies"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each row of ``docs`` as often as it is taken (copies of 0 leave no row)."""
    id_col, source_col, text_col, seed = (
        options.get(k, v) for k, v in (("id_col", "doc_id"), ("source_col", "source"), ("text_col", "text"), ("seed", ""))
    )
    _, sources, total = mix_plan(docs, **options)
    rows = _rows(docs, id_col, source_col, text_col, seed).drop("source")
    kept = _decided(rows, sources.drop("source"), total).filter("_copies > 0")
    return kept.select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_doc.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source
), fill AS (
  SELECT 0 AS step, CAST([] AS VARCHAR[]) AS capped, (SELECT sum(source_size) FROM s)::BIGINT AS rest, (SELECT sum(w) FROM s)::BIGINT AS free
  UNION ALL
  SELECT step + 1,
         list_concat(capped, more.names), (rest - more.used)::BIGINT, (free - more.w)::BIGINT
  FROM fill, LATERAL (
    SELECT list(coalesce('s' || source, 'n')) AS names, sum(3 * source_size) AS used, sum(s.w) AS w
    FROM s WHERE NOT list_contains(fill.capped, coalesce('s' || source, 'n')) AND 3 * source_size * fill.free <= fill.rest * s.w
  ) more
  WHERE more.names IS NOT NULL
), last AS (SELECT * FROM fill ORDER BY step DESC LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN list_contains(capped, coalesce('s' || source, 'n')) THEN (3 * source_size)::DOUBLE
              ELSE (rest * w)::DOUBLE / free::DOUBLE END AS target
  FROM s, last
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.source, d.u,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size - floor(t.target / t.source_size) ELSE 0 END AS share
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY (u / (1 - u)) / (share / (1 - share)), doc_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM r
)
SELECT doc_id, size, source_size, target,
       ((whole + CASE WHEN share > 0 AND size > 0 AND before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken,
       (whole + CASE WHEN share > 0 AND size > 0 AND before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END)::INTEGER AS copies
FROM p
"""
