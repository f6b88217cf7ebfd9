"""Operator 4: k-d tree sharding, splitting at distributed weighted medians of the widest metadata dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import attach, checkpointed, table, text_of

SHARDS = 40
LEVELS = 1 << 20  # steps of a coordinate; documents on one step are ordered by a hash of their text
BINS = 1024
ROWS_PER_BUCKET = 50_000


@dataclass
class Node:
    first: int  # shards first .. first + count - 1
    count: int
    dim: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def _leaf_of(node: Node, dims: list[str]) -> Column:
    if node.low is None:
        return F.lit(node.first)
    return F.when(F.col(dims[node.dim]) < node.cut, _leaf_of(node.low, dims)).otherwise(_leaf_of(node.high, dims))


def _open(node: Node) -> list[Node]:
    if node.low is not None:
        return _open(node.low) + _open(node.high)
    return [node] if node.count > 1 else []


def _split(units: DataFrame, root: Node, dims: list[str]) -> bool:
    """Split every leaf that still holds several shards; False when there is none.

    What reaches the driver is bounded by the number of shards: extents per leaf, then histograms of
    BINS sums per leaf. Each refinement looks into the one bin that holds the weighted median.
    """
    leaves = {n.first: n for n in _open(root)}
    if not leaves:
        return False
    at = units.withColumn("_leaf", _leaf_of(root, dims)).filter(F.col("_leaf").isin(list(leaves)))
    aggs = [f(d).alias(f"{k}{i}") for i, d in enumerate(dims) for k, f in (("a", F.min), ("z", F.max))]
    extents = {r["_leaf"]: r for r in at.groupBy("_leaf").agg(F.sum("_bytes").alias("w"), *aggs).collect()}
    todo = {}
    for first, node in leaves.items():
        r = extents.get(first)
        node.dim = 0 if r is None else max(range(len(dims)), key=lambda i: (r[f"z{i}"] - r[f"a{i}"], -i))
        half = node.count // 2
        if r is None:  # nothing in here: any cut will do
            node.cut = 0.0
        else:
            lo = float(int(r[f"a{node.dim}"]))
            todo[first] = {"lo": lo, "step": (int(r[f"z{node.dim}"]) + 1 - lo) / BINS, "below": 0, "want": r["w"] * half / node.count, "slack": r["w"] / node.count / 500}
    while todo:
        some = list(todo)
        pick = lambda f: F.element_at(F.create_map(*[F.lit(x) for k in some for x in (k, f(k))]), F.col("_leaf"))
        value = F.element_at(F.array(*dims), pick(lambda k: leaves[k].dim + 1))
        place = F.floor((value - pick(lambda k: todo[k]["lo"])) / pick(lambda k: todo[k]["step"]))
        sums = at.filter(F.col("_leaf").isin(some)).withColumn("_bin", place).filter((F.col("_bin") >= 0) & (F.col("_bin") < BINS))
        found = sums.groupBy("_leaf", "_bin").agg(F.sum("_bytes").alias("w")).collect()
        for k in some:
            t, node = todo[k], leaves[k]
            upto = t["below"]
            for b, w in sorted((r["_bin"], r["w"]) for r in found if r["_leaf"] == k):
                if upto + w > t["want"]:
                    break
                upto += w
            else:
                b, w = BINS, 0
            lo, hi = t["lo"] + b * t["step"], t["lo"] + (b + 1) * t["step"]
            if w <= t["slack"] or t["step"] < 2.0**-24:
                node.cut = lo if t["want"] - upto <= upto + w - t["want"] else hi
                del todo[k]
            else:
                t.update(lo=lo, step=t["step"] / BINS, below=upto)
    for node in leaves.values():
        half = node.count // 2
        node.low, node.high = Node(node.first, half), Node(node.first + half, node.count - half)
    return True


def kd_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    Size is the UTF-8 length of the text plus 16 (null text: 16). Equal texts form a group, the unit that
    is placed; a group larger than a shard's share is dealt out by row in pieces of an eighth of it. The
    dimensions are the unit's text length (log), smallest id, and codes of its smallest source and language
    hash, each scaled to its range; a hash of the text breaks ties, so a dimension with few values still
    splits evenly. A leaf of k shards is split where k // 2 of its k shares of the bytes lie below. Empty
    and null texts are one group; null ids, sources and languages have codes of their own; repeated rows
    are documents of their own. An empty table gives none. A very long text counts by its size and may make a
    shard of its own; columns not named here are ignored, whatever their names. Slots number a shard's rows gapless from 0, by
    buckets of a hash of the row, then by id.

    Scale: no text moves. The tree is built from sums per leaf and bin; rows meet their group through
    ``attach`` (hot groups by broadcast); slots are counted per bucket of about ``rows_per_bucket`` rows.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).cast("long").alias("_id"),
        F.unhex(F.md5(text)).alias("_key"),
        (F.octet_length(text) + 16).cast("long").alias("_size"),
        F.crc32(text).alias("_crc"),
        F.coalesce(F.crc32(F.col(source_col).cast("string")), F.lit(-1)).alias("_source"),
        F.coalesce(F.crc32(F.col(lang_col).cast("string")), F.lit(-1)).alias("_lang"),
    )
    rows = checkpointed(rows)
    groups = checkpointed(rows.groupBy("_key").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_n")))
    total = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("b"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()

    # fewer than ``shards`` groups can be larger than a shard's share
    large = groups.filter(F.col("_bytes") * shards > total["b"]).select(
        "_key", F.ceil(F.col("_bytes") * (8 * shards) / F.lit(max(total["b"], 1))).alias("_pieces")
    )
    rows = rows.join(F.broadcast(large), "_key", "left").withColumn(
        "_piece", F.coalesce(F.pmod(F.xxhash64("_id", "_row"), F.col("_pieces")), F.lit(0)).cast("int")
    )
    units = rows.groupBy("_key", "_piece").agg(
        F.sum("_size").alias("_bytes"),
        F.count(F.lit(1)).alias("_n"),
        F.log2(F.min("_size").cast("double")).alias("_len"),
        F.coalesce(F.min("_id"), F.lit(-1)).cast("double").alias("_first"),
        F.min("_source").cast("double").alias("_src"),
        F.min("_lang").cast("double").alias("_lng"),
    )
    units = checkpointed(units)
    raw = ["_len", "_first", "_src", "_lng"]
    ends = units.agg(*[f(d).alias(k + d) for d in raw for k, f in (("a", F.min), ("z", F.max))]).first()
    tie = F.pmod(F.xxhash64("_key", "_piece"), F.lit(1 << 30)).cast("double") / float(1 << 30)
    dims = [f"c{d}" for d in raw]
    scaled = units.select(
        "_key", "_piece", "_n", "_bytes",
        *[
            (F.floor((F.col(d) - F.lit(ends["a" + d] or 0.0)) / F.lit(max((ends["z" + d] or 0.0) - (ends["a" + d] or 0.0), 1e-9)) * (LEVELS - 1)) + tie).alias(c)
            for d, c in zip(raw, dims, strict=True)
        ],
    )
    scaled = checkpointed(scaled)
    root = Node(0, shards)
    while _split(scaled, root, dims):
        pass

    placed = checkpointed(scaled.select("_key", "_piece", "_n", _leaf_of(root, dims).cast("int").alias("shard")))
    out = attach(rows.drop("_pieces"), placed, ["_key", "_piece"], "_n", total["n"])
    buckets = max(1, -(-total["n"] // (shards * rows_per_bucket)))
    out = checkpointed(out.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_row"), F.lit(buckets))).drop("_piece", "_source", "_lang", "_key", "_n"))
    counts = out.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy("shard").orderBy("_bucket")
    starts = counts.select("shard", "_bucket", (F.sum("_c").over(upto) - F.col("_c")).alias("_start"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("_id", "_row")
    out = out.join(starts, ["shard", "_bucket"]).withColumn("slot", (F.col("_start") + F.row_number().over(inside) - 1).cast("long"))
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(table(spark, sf_dir, "documents"))
