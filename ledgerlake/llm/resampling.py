"""Operator 12: importance resampling towards a target distribution, its weights summed bit by bit.

A document's features are its words; each falls into one of BUCKETS buckets by the CRC-32 of its UTF-8 bytes.
A bucket's gain is the log ratio of its smoothed shares in the target and in all documents, as an integer. A
document's weight is the floored mean of the gains of its features, and its score adds Gumbel noise drawn from
its id, so the highest scores are a sample without replacement in proportion to the exponentiated weights.

Bit-sliced: plane i of a document has a bit for each bucket, set where bit i of the bucket's count is; plane j of
the gains has those buckets whose gain has bit j, one set of planes for the positive and one for the negative
gains. The sum of the gains is then sum over i, j of 2^(i+j) * (ones of plane i AND positive plane j - ones of
plane i AND negative plane j): integers throughout, so it is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import table, text_of, written
from ledgerlake.llm.hashing import blocks, crc32_spans, lower_bytes, word_spans
from ledgerlake.operators.keys import with_dense_key

BUCKETS = 10_000
SCALE = 1000  # of gains and noise
SEED = 2024
LEAST_WORDS = 20  # shorter documents are not drawn
PERCENT = 10  # of the others
LONGS = -(-BUCKETS // 64)  # of a plane

# bytes that end a word: ASCII but for digits and letters
GAPS = np.zeros(256, bool)
GAPS[:128] = True
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    GAPS[_lo:_hi] = False


def _buckets(a: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word of a block of texts, and for each text the number of its first word (and the end)."""
    starts, ends, at = word_spans(a, off, GAPS)
    return (crc32_spans(lower_bytes(a), starts, ends) % np.uint32(BUCKETS)).astype(np.int64), at


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many words of the texts fall into each bucket."""
    n = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, a, off in blocks(batch.column("text")):
            n += np.bincount(_buckets(a, off)[0], minlength=BUCKETS)
    used = np.flatnonzero(n)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()), "n": pa.array(n[used], pa.int64())})


def bucket_counts(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text") -> tuple[list[int], list[int]]:
    """Words of all documents and of all target texts in each bucket: two lists of BUCKETS numbers.

    Each task sums its own texts; BUCKETS rows a task at most are shuffled and 2 * BUCKETS rows reach the driver.
    """
    sides = [
        df.select(text_of(c).alias("text")).mapInArrow(_counted, "bucket int, n long").withColumn("side", F.lit(k))
        for k, (df, c) in enumerate(((docs, text_col), (target, target_col)))
    ]
    out = [0] * BUCKETS, [0] * BUCKETS
    for r in sides[0].unionByName(sides[1]).groupBy("side", "bucket").agg(F.sum("n").alias("n")).collect():
        out[r["side"]][r["bucket"]] = r["n"]
    return out


def gains(of_docs: list[int], of_target: list[int]) -> np.ndarray:
    """floor(SCALE * ln(share in the target / share in the documents)), both smoothed by one a bucket."""
    s_all, t_all = sum(of_docs), sum(of_target)
    return np.array(
        [
            math.floor(SCALE * math.log(float(t + 1) * float(s_all + BUCKETS) / (float(s + 1) * float(t_all + BUCKETS))))
            for s, t in zip(of_docs, of_target, strict=True)
        ],
        np.int64,
    )


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of BUCKETS booleans as rows of LONGS 64-bit words, bucket b in bit b % 64 of word b // 64."""
    wide = np.zeros((*bits.shape[:-1], LONGS * 64), bool)
    wide[..., : bits.shape[-1]] = bits
    return np.packbits(wide, axis=-1, bitorder="little").view("<u8")


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(signed power of two, plane) of the gains: the positive ones' planes and the negative ones'."""
    out = []
    for sign, size in ((1, np.maximum(gain, 0)), (-1, np.maximum(-gain, 0))):
        out += [(sign << j, packed((size >> j) & 1 == 1)) for j in range(int(size.max(initial=0)).bit_length())]
    return out


def count_planes(text: np.ndarray, bucket: np.ndarray, count: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(power of two, texts that have the plane, their planes) of the counts of (text, bucket), sorted by both."""
    for i in range(int(count.max(initial=0)).bit_length()):
        here = np.flatnonzero((count >> i) & 1)
        if not len(here):
            continue
        word = text[here] * LONGS + (bucket[here] >> 6)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        planes = np.zeros(n * LONGS, np.uint64)
        planes[word[first]] = np.bitwise_or.reduceat(np.uint64(1) << (bucket[here] & 63).astype(np.uint64), first)
        some = np.unique(text[here])
        yield 1 << i, some, planes.reshape(n, LONGS)[some]


def sums(bucket: np.ndarray, at: np.ndarray, planes: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Per text the sum of the gains of its words, from the planes."""
    n = len(at) - 1
    key, count = np.unique(np.repeat(np.arange(n), np.diff(at)) * BUCKETS + bucket, return_counts=True)
    total = np.zeros(n, np.int64)
    for power, some, of_texts in count_planes(key // BUCKETS, key % BUCKETS, count, n):
        for gain, plane in planes:
            total[some] += power * gain * np.bitwise_count(of_texts & plane).sum(axis=1, dtype=np.int64)
    return total


def _weighed(planes: list[tuple[int, np.ndarray]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, a, off in blocks(batch.column("text")):
                bucket, at = _buckets(a, off)
                words = np.diff(at)
                weight = sums(bucket, at, planes) // np.maximum(words, 1)  # floors towards minus infinity; 0 without words
                here = slice(first, first + len(words))
                yield pa.RecordBatch.from_pydict(
                    {
                        "_row": batch.column("_row")[here],
                        "_id": batch.column("_id")[here],
                        "n_features": pa.array(words, pa.int64()),
                        "weight": pa.array(weight, pa.int64()),
                    }
                )

    return run


def noise(doc_id: str = "_id") -> F.Column:
    """floor(-SCALE * ln(-ln(u))) with u from the first 32 bits of sha256(SEED:id)."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_features, weight, score, rank (null where the sample doesn't have it).

    Of the N documents of at least LEAST_WORDS words the sample has the floor(PERCENT * N / 100) highest scores;
    ties go to the smaller id, a null id after all others, then to the earlier row. Words are runs of ASCII
    letters and digits and of all characters beyond ASCII, A-Z lowered. Null and empty texts, and such without
    words, have no features, weight 0 and are not drawn; a very long text is one block of its own. Repeated rows
    are documents of their own with the same score. An empty table gives no row; an empty target is smoothed to
    equal shares. Other columns are ignored, whatever their names. A null id has the noise of an empty one.

    Scale: texts are read twice and never shuffled; BUCKETS sums and one narrow row a document are. Ranks come from
    a range partitioning of the narrow rows, never from one task.
    """
    planes = gain_planes(gains(*bucket_counts(docs, target, text_col, target_col)))
    texts = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("text"))
    weighed = texts.mapInArrow(_weighed(planes), "_row long, _id long, n_features long, weight long")
    scored = written(weighed.withColumn("score", F.col("weight") + noise()), "resampling-scores")
    enough = scored.filter(F.col("n_features") >= LEAST_WORDS)
    order = enough.withColumn("_down", -F.col("score")).withColumn("_unknown", F.col("_id").isNull())
    ranked = with_dense_key(order, ["_down", "_unknown", "_id", "_row"], "rank")
    drawn = ranked.rows * PERCENT // 100
    out = [F.col("_id").alias(id_col), "n_features", "weight", "score"]
    return ranked.df.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        scored.filter(F.col("n_features") < LEAST_WORDS).select(*out, F.lit(None).cast("long").alias("rank"))
    )


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# CRC-32 of a word, byte by byte: the table is made by its rule (polynomial 0xEDB88320 = 3988292384)
SQL = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), texts AS (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
), words AS (
  SELECT side, r, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM texts
), distinct_words AS (
  SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM words)
), hashed AS (
  SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(length(x) // 2), lambda i:
      (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS b
  FROM distinct_words, crc
), counts AS (
  SELECT b.b, count(w.w) FILTER (w.side = 0) AS s, count(w.w) FILTER (w.side = 1) AS t
  FROM hashed b JOIN words w ON w.w = b.w GROUP BY 1
), totals AS (
  SELECT sum(s) AS sa, sum(t) AS ta FROM counts
), gain AS (
  SELECT b, floor({SCALE} * ln(((t + 1)::DOUBLE * (sa + {BUCKETS})::DOUBLE) / ((s + 1)::DOUBLE * (ta + {BUCKETS})::DOUBLE)))::BIGINT AS g
  FROM counts, totals
), weighed AS (
  SELECT r, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
  FROM words JOIN hashed USING (w) JOIN gain USING (b) WHERE side = 0 GROUP BY 1
), scored AS (
  SELECT r, id AS doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-{SCALE} * ln(-ln((h + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM (SELECT r, id, list_reduce(list_concat([0::BIGINT], list_transform(range(8), lambda i:
      strpos('0123456789abcdef', d[i + 1]) - 1)), lambda c, x: c * 16 + x)::DOUBLE AS h
    FROM (SELECT r, id, sha256('{SEED}:' || id::VARCHAR) AS d FROM texts WHERE side = 0)) LEFT JOIN weighed USING (r)
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id, r) AS k FROM scored WHERE n_features >= {LEAST_WORDS}
)
SELECT s.doc_id, s.n_features::BIGINT AS n_features, s.weight, s.score,
  CASE WHEN k.k <= {PERCENT} * (SELECT count(*) FROM ranked) // 100 THEN k.k::BIGINT END AS rank
FROM scored s LEFT JOIN ranked k USING (r)
"""
