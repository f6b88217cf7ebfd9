"""Operator 13: hard negatives by Four-Russians scoring of bit planes.

Components are integers, floor(SCALE * x). A candidate's components are kept as bit planes of their two's complement,
eight dimensions to a byte. For each anchor and each group of eight dimensions a table holds the sums of all 256
subsets of the anchor's components, so a candidate's byte looks up the part of the inner product that its plane and
group contribute. Shifting and adding the lookups of all planes, the sign plane negative, gives the whole score, exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import table, written

SCALE = 256
LIMIT = 1 << 25  # components at or beyond it in size could take a score out of a long
GROUP = 8  # dimensions of a table
ANCHORS_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LEAST_PERCENT = 80  # of the positive's score that a negative has at least
CANDIDATE_ROWS, ANCHOR_ROWS = 4096, 1024  # of a tile, about
TOGETHER, STRIP = 64, 1024  # anchors of one table, candidates scored at once


def _planes(dims: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Components (shorter vectors filled up with zeros) as ``bits`` planes of a byte for each eight dimensions."""
    groups = -(-dims // GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, column = batch.num_rows, batch.column("parts")
            size = np.diff(column.offsets.to_numpy())
            parts = np.zeros((n, groups * GROUP), np.int64)
            parts[np.repeat(np.arange(n), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy()
            planes = np.stack([np.packbits((parts >> j) & 1 == 1, axis=1, bitorder="little") for j in range(bits)], axis=1)
            planes = pa.array([p.tobytes() for p in planes], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_row", "vec_id", "label")), planes], ["_row", "vec_id", "label", "planes"])

    return run


def components(planes: np.ndarray) -> np.ndarray:
    """The integers of (row, plane, group) bytes, back from their planes."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    power = np.int64(1) << np.arange(planes.shape[1], dtype=np.int64)
    power[-1] = -power[-1]
    return np.einsum("rjd,j->rd", bits, power)


def subset_sums(parts: np.ndarray, kind: type) -> np.ndarray:
    """Tables (group, subset, anchor): the sums over all subsets of each eight components of each anchor."""
    groups = parts.shape[1] // GROUP
    out = np.zeros((groups, 1 << GROUP, len(parts)), kind)
    for b in range(GROUP):
        out[:, 1 << b : 2 << b] = out[:, : 1 << b] + parts.T.reshape(groups, GROUP, 1, -1)[:, b].astype(kind)
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (anchor, candidate) from an anchor block's tables and the candidates' (row, plane, group) bytes."""
    out = np.empty((tables.shape[2], len(planes)), tables.dtype)
    bits, groups = planes.shape[1:]
    for lo in range(0, len(planes), STRIP):
        strip = planes[lo : lo + STRIP]
        total = np.zeros((len(strip), tables.shape[2]), tables.dtype)
        found = np.empty_like(total)
        for j in range(bits - 1, -1, -1):
            total <<= 1
            for g in range(groups):
                np.take(tables[g], strip[:, j, g], axis=0, out=found, mode="clip")  # bytes are within the table
                if j == bits - 1:
                    total -= found
                else:
                    total += found
        out[:, lo : lo + STRIP] = total.T
    return out


def _score_kind(planes: np.ndarray) -> type:
    """The narrowest integers that hold any score."""
    return np.int32 if planes.shape[2] * GROUP << (2 * planes.shape[1] - 2) < 2**31 else np.int64


def _rows(t: pa.Table, dims: int, bits: int) -> dict[str, np.ndarray]:
    """Columns of a side of a tile in the order that ties take: vec_id, null last, then row."""
    ids, row = t.column("vec_id"), t.column("_row").to_numpy()
    known = ids.is_valid().to_numpy()
    number = ids.fill_null(0).to_numpy()
    order = np.lexsort((row, number, ~known))
    data = b"".join(t.column("planes").to_pylist())
    planes = np.frombuffer(data, np.uint8).reshape(len(t), bits, -(-dims // GROUP))
    columns = {"row": row, "id": number, "known": known, "label": t.column("label").to_numpy(), "planes": planes}
    return {k: v[order] for k, v in columns.items()}


def _best(s: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` highest scores, in order; of equal ones the first."""
    if len(s) > n:
        least = np.partition(s, len(s) - n)[len(s) - n]
        among = np.flatnonzero(s >= least)
        return among[np.argsort(-s[among], kind="stable")][:n]
    return np.argsort(-s, kind="stable")


def _table(found: list[tuple], names: list[str], ids: dict[str, str]) -> pa.Table:
    """Rows of numbers as a table of longs; ``ids`` names the columns that are null unless another one is true."""
    columns = dict(zip(names, np.array(found, np.int64).reshape(-1, len(names)).T, strict=True))
    out = {k: pa.array(v, mask=columns[ids[k]] == 0 if k in ids else None) for k, v in columns.items() if k not in ids.values()}
    return pa.table(out)


def _tile_positives(dims: int, bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The first POSITIVES other rows of its label for each anchor of a tile: label by label."""

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if len(candidates) and len(anchors):
            c, a = _rows(candidates, dims, bits), _rows(anchors, dims, bits)
            for label in np.unique(a["label"]):
                of_c, of_a = np.flatnonzero(c["label"] == label), np.flatnonzero(a["label"] == label)
                for lo in range(0, len(of_a), TOGETHER):
                    some = of_a[lo : lo + TOGETHER]
                    s = scores(subset_sums(components(a["planes"][some]), _score_kind(c["planes"])), c["planes"][of_c])
                    for k, anchor in enumerate(some):
                        others = np.flatnonzero(c["row"][of_c] != a["row"][anchor])
                        for i in others[_best(s[k][others], POSITIVES)]:
                            x = of_c[i]
                            found.append((a["row"][anchor], c["row"][x], c["id"][x], c["known"][x], s[k][i]))
        return _table(found, ["anchor", "row", "positive_id", "known", "positive_score"], {"positive_id": "known"})

    return run


def _tile_negatives(dims: int, bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For each anchor of a tile and each of its positives the first NEGATIVES rows of other labels within reach of its score."""

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        found = []
        if len(candidates) and len(anchors):
            c = _rows(candidates, dims, bits)
            asked = anchors.column("asked").to_pylist()
            by_row = dict(zip(anchors.column("_row").to_pylist(), asked, strict=True))
            a = _rows(anchors, dims, bits)
            for lo in range(0, len(a["row"]), TOGETHER):
                here = slice(lo, lo + TOGETHER)
                s = scores(subset_sums(components(a["planes"][here]), _score_kind(c["planes"])), c["planes"])
                for k, (row, label) in enumerate(zip(a["row"][here], a["label"][here], strict=True)):
                    found += _within(s[k], c, label, int(row), by_row[int(row)])
        return _table(found, ["anchor", "place", "row", "negative_id", "known", "negative_score"], {"negative_id": "known"})

    return run


def least_score(positive: int) -> int:
    """The least whole score of a negative: LEAST_PERCENT * positive <= 100 * score."""
    return -(-LEAST_PERCENT * positive // 100)


def _within(s: np.ndarray, c: dict[str, np.ndarray], label: int, anchor: int, asked: list[dict]) -> Iterator[tuple]:
    least = min(least_score(p["positive_score"]) for p in asked)
    among = np.flatnonzero((s >= least) & (c["label"] != label))
    among = among[np.argsort(-s[among], kind="stable")]
    down = -s[among].astype(np.int64)
    for p in asked:
        lo = int(np.searchsorted(down, -p["positive_score"], side="left"))
        hi = int(np.searchsorted(down, -least_score(p["positive_score"]), side="right"))
        for x in among[lo : min(hi, lo + NEGATIVES)]:
            yield anchor, p["place"], c["row"][x], c["id"][x], c["known"][x], s[x]


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """_row, vec_id, label, parts (integers) of the rows that take part; labels are changed as the query says."""
    x = F.transform(F.col(vector_col), lambda v: F.floor(v.cast("double") * SCALE))
    wrong = F.exists(F.col(vector_col), lambda v: F.coalesce(~(F.abs(v.cast("double")) * SCALE < LIMIT), F.lit(True)))
    own = F.col(label_col).cast("long")
    turned = F.when(F.col(id_col) % 7 == 0, (own + 1) % 10).otherwise(own)
    numbered = vectors.withColumns({"_row": F.monotonically_increasing_id()})
    return numbered.filter(own.isNotNull() & F.col(vector_col).isNotNull() & ~F.coalesce(wrong, F.lit(True))).select(
        "_row", F.col(id_col).cast("long").alias("vec_id"), turned.alias("label"), x.alias("parts")
    )


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """For each anchor and each of its positives the hardest negatives: anchor_id, positive_id, rank, negative_id, both scores.

    A row takes part if it has a label and a vector whose components are all finite (and below LIMIT / SCALE in
    size, beyond which scores would leave a long). Anchors are rows of ids divisible by ANCHORS_EVERY, positives of
    an anchor its first POSITIVES other rows of the same label, negatives of both the first NEGATIVES rows of other
    labels that score from LEAST_PERCENT percent of the positive's score up to that score. Higher scores come first, ties
    by smaller id, null ids last, then by row. Repeated rows are rows of their own; an anchor repeated gives its
    rows again. Shorter vectors count as filled up with zeros. A negative positive score has no negatives. Without
    anchors or rows the result is empty. Other columns are ignored, whatever their names.

    Scale: rows are hashed into blocks and every block of anchors meets every block of rows as one group, a tile of about
    ANCHOR_ROWS x CANDIDATE_ROWS, whatever the labels; tiles are independent and give at most POSITIVES (or POSITIVES *
    NEGATIVES) rows an anchor. Positives only need the tile's pairs of equal labels; negatives need all pairs, again,
    since their bounds are known only once the positives of all tiles are. Nothing is broadcast; the driver sees counts.
    """
    numbered = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"), F.col(label_col).alias("_label"))
    rows = quantised(numbered, "_id", "_vector", "_label")
    anchor = F.col("vec_id") % ANCHORS_EVERY == 0
    at = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(anchor).alias("anchors"), F.max(F.size("parts")).alias("dims"),
        F.min(F.array_min("parts")).alias("least"), F.max(F.array_max("parts")).alias("most"),
    ).first()
    dims = max(at["dims"] or 0, 1)
    bits = max((at["most"] or 0).bit_length(), (~min(at["least"] or 0, 0)).bit_length()) + 1  # with the sign
    n_c, n_a = -(-max(at["n"], 1) // CANDIDATE_ROWS), -(-max(at["anchors"], 1) // ANCHOR_ROWS)
    tasks = min(2 * n_c * n_a, max(256, n_c * n_a // 64))
    planes = written(rows.mapInArrow(_planes(dims, bits), "_row long, vec_id long, label long, planes binary"), "hard-negative-planes")

    block = lambda n: F.pmod(F.xxhash64("_row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = planes.withColumn("_c", block(n_c)).withColumn("_a", every(n_a)).repartition(tasks, "_a", "_c")
    anchors = written(planes.filter(anchor), "hard-negative-anchors").withColumn("_a", block(n_a))

    def tiles(of_anchors: DataFrame, f: Callable, ddl: str) -> DataFrame:
        right = of_anchors.withColumn("_c", every(n_c)).repartition(tasks, "_a", "_c")
        return candidates.groupBy("_a", "_c").cogroup(right.groupBy("_a", "_c")).applyInArrow(f, ddl)

    first = lambda key, score, of: Window.partitionBy(*key).orderBy(F.desc(score), F.asc_nulls_last(of), "row")
    positives = tiles(anchors, _tile_positives(dims, bits), "anchor long, row long, positive_id long, positive_score long")
    positives = positives.withColumn("place", F.row_number().over(first(["anchor"], "positive_score", "positive_id"))).filter(F.col("place") <= POSITIVES)
    positives = written(positives.drop("row"), "hard-negative-positives")
    asked = positives.groupBy("anchor").agg(F.collect_list(F.struct("place", "positive_score")).alias("asked"))  # POSITIVES at most

    asking = anchors.join(asked, anchors["_row"] == asked["anchor"]).drop("anchor")
    found = tiles(asking, _tile_negatives(dims, bits), "anchor long, place long, row long, negative_id long, negative_score long")
    found = found.withColumn("rank", F.row_number().over(first(["anchor", "place"], "negative_score", "negative_id"))).filter(F.col("rank") <= NEGATIVES)
    ids = anchors.select(F.col("_row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return found.join(positives, ["anchor", "place"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS parts
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, a.vec_id = b.vec_id AS itself,
    list_dot_product(a.parts, b.parts)::BIGINT AS score
  FROM v a, v b WHERE a.vec_id % {ANCHORS_EVERY} = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same AND NOT itself
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id, row_number() OVER w::INTEGER AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND {LEAST_PERCENT} * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
