"""Operator 11: MinHash near-duplicates with tensored banding, candidates verified on their full sets.

An LSH table needs a key of several minhashes, and many tables miss few links. Tensoring makes the keys of HALVES x
HALVES tables out of two collections of HALVES half keys: table (i, j) is keyed by half i of the first and half j of
the second, so 2 * HALVES * WIDTH minhashes do the work of HALVES * HALVES * 2 * WIDTH.

Two sets of similarity s share half i with probability s^WIDTH, and some table unless a whole collection differs: they
are missed with probability 1 - (1 - (1 - s^WIDTH)^HALVES)^2. At s = 0.8 that is 1.2e-6, and less above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import attach, checkpointed, table, text_of, written
from ledgerlake.llm.components import components
from ledgerlake.llm.hashing import blocks, lists, mix, shingle_sets, views
from ledgerlake.llm.ngram_join import bitmap, folded, linked
from ledgerlake.operators.joins import join_sized

SHINGLE = 4
NUMERATOR, DENOMINATOR = 80, 100  # linked when DENOMINATOR * intersection >= NUMERATOR * union
WIDTH, HALVES = 3, 20
PARTS = 1024  # that a hub's documents are dealt to
TILE = 2048

_STEPS = mix(np.arange(1, 2 * 2 * HALVES * WIDTH + WIDTH + 1, dtype=np.uint64))
_FLIP = _STEPS[: 2 * HALVES * WIDTH]
_TIMES = _STEPS[2 * HALVES * WIDTH : 4 * HALVES * WIDTH] | np.uint64(1)
_JOIN = _STEPS[4 * HALVES * WIDTH :] | np.uint64(1)


def half_keys(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(set, 2 * HALVES): the half keys of non-empty sets that lie behind each other in ``flat``, from ``starts`` on."""
    out = np.zeros((len(starts), 2 * HALVES), np.uint64)
    buffer = np.empty_like(flat)
    for h in range(2 * HALVES):
        for w in range(WIDTH):
            f = h * WIDTH + w
            np.bitwise_xor(flat, _FLIP[f], out=buffer)
            np.multiply(buffer, _TIMES[f], out=buffer)
            out[:, h] += np.minimum.reduceat(buffer, starts) * _JOIN[w]
        out[:, h] = mix(out[:, h] + np.uint64(h))
    return out


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: set size, digest of the set, and its half keys."""
    for batch in batches:
        rows = batch.column("_row").to_numpy()
        for first, a, off in blocks(batch.column("text")):
            sets = shingle_sets(a, off, SHINGLE)
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            halves = [np.empty(0, np.uint64)] * len(sets)
            if len(full):
                keys = half_keys(np.concatenate([sets[i] for i in full]), np.cumsum(n[full]) - n[full])
                for i, k in zip(full, keys, strict=True):
                    halves[i] = k
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_pydict(
                {
                    "_row": pa.array(rows[first : first + len(sets)]),
                    "n": pa.array(n),
                    "digest": pa.array(digests, pa.binary()),
                    "halves": lists(halves, pa.int64()),
                }
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("_row").to_numpy()
        for first, a, off in blocks(batch.column("text")):
            sets = shingle_sets(a, off, SHINGLE)
            yield pa.RecordBatch.from_pydict(
                {
                    "_row": pa.array(rows[first : first + len(sets)]),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "sig": pa.array([bitmap(s) for s in sets], pa.binary()),
                    "items": lists(sets, pa.int64()),
                }
            )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by hub and part, the hub itself first: the pairs of a hub and a document that are linked."""
    centre, own = None, np.empty(0, np.int64)
    for batch in batches:
        at = list(zip(batch.column("hub").to_pylist(), batch.column("part").to_pylist(), strict=True))
        row, n, items = batch.column("_row").to_numpy(), batch.column("n").to_numpy(), views(batch.column("items"))
        out = []
        for i, key in enumerate(at):
            if key != centre:
                centre, own = key, items[i].copy()  # outlives its batch
            elif DENOMINATOR * min(len(own), n[i]) >= NUMERATOR * max(len(own), n[i]) and linked(own, items[i]):
                out.append((min(key[0], row[i]), max(key[0], row[i])))
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The linked ones of the pairs (_row, hub), decided on the full sets.

    A hub's documents are dealt to up to PARTS parts that each get a copy of its set and are read as they come.
    """
    pairs = checkpointed(pairs.withColumn("part", F.pmod(F.xxhash64("_row"), F.lit(PARTS)).cast("int")))
    facts = sets.select("_row", "n", "items")
    members = pairs.join(facts, "_row").withColumn("place", F.lit(1))
    centres = pairs.select("hub", "part").distinct().join(facts, F.col("hub") == F.col("_row")).withColumn("place", F.lit(0))
    met = centres.unionByName(members).repartition("hub", "part").sortWithinPartitions("hub", "part", "place")
    return checkpointed(met.select("hub", "part", "_row", "n", "items").mapInArrow(_verified, "a long, b long"))


def _best_hubs(met: DataFrame) -> DataFrame:
    """(_row, hub): each document and, of the hubs it meets in its tables, the one it meets most often."""
    votes = met.filter("_row <> hub").groupBy("_row", "hub").agg(F.count(F.lit(1)).alias("v"))
    return votes.groupBy("_row").agg(F.max_by("hub", F.struct("v", "hub")).alias("hub"))


def _unsettled(keyed: DataFrame, links: DataFrame, total: int) -> DataFrame:
    """(_row, u, key, comp, _m) of the table keys that still hold documents of several components."""
    comp = checkpointed(components(links).withColumnRenamed("node", "_row").withColumnRenamed("component", "comp"))
    now = join_sized(keyed.select("_row", "u", "key"), comp, "_row", "left").withColumn("comp", F.coalesce("comp", "_row"))
    ends = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("_m"))
    several = checkpointed(ends.filter("lo <> hi").select("key", "_m"))
    return written(attach(now, several, ["key"], "_m", total), "tensor-live")


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the tiles, which come sorted, a tile whole before the next."""
    rest: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        tile = t.column("tile").to_numpy()
        if not len(tile):
            continue
        if rest and rest[0].column("tile")[0].as_py() == tile[-1]:  # one long tile goes on
            rest.append(t)
            continue
        cut = int(np.flatnonzero(tile != tile[-1])[-1]) + 1 if (tile != tile[-1]).any() else 0
        yield from _tile_pairs(pa.concat_tables([*rest, t.slice(0, cut)]))
        rest = [t.slice(cut)]
    if rest:
        yield from _tile_pairs(pa.concat_tables(rest))


def _tile_pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links that join the components of a tile. Compared are documents of different components that share a table with the
    tile's first half, if it is the first half that they share: sizes and bitmaps bound the overlap, full sets decide. A link
    joins two components for the rest of the tile."""
    if not len(t):
        return
    tiles = t.column("tile").to_numpy()
    bounds = np.flatnonzero(np.r_[True, tiles[1:] != tiles[:-1], True])
    row, n, comp, side, place = (t.column(c).to_numpy() for c in ("_row", "n", "comp", "side", "place"))
    halves = t.column("halves").combine_chunks().flatten().to_numpy().reshape(len(t), 2 * HALVES)
    sigs = [np.frombuffer(x, np.uint64) for x in t.column("sig").to_pylist()]
    items = [x for c in t.column("items").chunks for x in views(c)]
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        order = lo + np.argsort(n[lo:hi], kind="stable")
        s, r, d, x = n[order], row[order], side[order], halves[order]
        label = np.unique(comp[order], return_inverse=True)[1]
        first, mixed, out, at = int(place[lo]), (d != d[0]).any(), [], {}
        for i in range(len(order) - 1):
            z = np.arange(i + 1, int(np.searchsorted(s, s[i] * DENOMINATOR // NUMERATOR, side="right")))
            z = z[(label[z] != label[i]) & ((d[z] != d[i]) if mixed else True)]
            if len(z):
                z = z[(x[z, HALVES:] == x[i, HALVES:]).any(axis=1) & ~(x[z, :first] == x[i, :first]).any(axis=1)]
            if not len(z):
                continue
            w = len(sigs[order[i]])
            if w not in at:  # all from here on, at the width of this one: bitmaps widen with the size
                at = {w: np.stack([folded(sigs[k], w) for k in order[i:]]), -1: i}
            far = np.bitwise_count(at[w][z - at[-1]] ^ at[w][i - at[-1]]).sum(axis=1, dtype=np.int64)
            both = (s[z] + s[i] - far) // 2
            may = DENOMINATOR * both >= NUMERATOR * (s[z] + s[i] - both)
            for k in z[may][np.argsort(-both[may], kind="stable")]:  # the likeliest first
                if label[k] != label[i] and linked(items[order[i]], items[order[k]]):
                    out.append((min(r[i], r[k]), max(r[i], r[k])))
                    label[label == label[k]] = label[i]
        if out:
            a, b = np.array(out, np.int64).T
            yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})


def _tiled_links(live: DataFrame, heads: DataFrame, sets: DataFrame) -> DataFrame:
    """Links enough to join what is linked among the documents that share a table of ``live``.

    Documents of a first half are dealt to parts of about TILE; each two parts, and each part with itself, are a tile.
    """
    at = checkpointed(live.select("_row", "u", "comp").distinct())
    per = checkpointed(at.groupBy("u").agg(F.count(F.lit(1)).alias("_m")))
    facts = heads.select("_row", "halves").join(sets, "_row")
    parts = F.ceil(F.col("_m") / TILE).cast("int")
    tiled = (
        attach(at, per, ["u"], "_m", at.count())
        .withColumn("_parts", parts)
        .withColumn("_part", F.pmod(F.xxhash64("_row"), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .select(
            F.xxhash64("u", F.least("_part", "_other"), F.greatest("_part", "_other")).alias("tile"), "u", "_row", "comp",
            F.when(F.col("_part") <= F.col("_other"), 0).otherwise(1).alias("side"),
        )
    )
    whole = tiled.join(facts, "_row").withColumn("place", F.array_position("halves", F.col("u")).cast("int") - 1).drop("u")
    return whole.repartition("tile").sortWithinPartitions("tile").mapInArrow(_tiles, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: _row, id, n_shingles, component_id, kept.

    A document's set: its distinct 4-word shingles (A-Z lowered); with fewer words the whole sequence as
    one; null, empty and blank texts have none and are linked with nothing, each a component of its own. Two
    documents link when 100 * intersection >= 80 * union; component_id is the smallest id reachable by links,
    kept is whether that is the row's own id (rows of the same id are then all kept; a null id is not). Repeated
    rows are documents with equal sets. A component of null ids has a null component_id. A very long text is a block
    of its own. Other columns are ignored, whatever their names. An empty table gives none.

    How. (1) Sets are equal by digest; one document stands for each. (2) Half keys that one document holds alone make no
    table key that is shared, so keys are combined from the others only. (3) Each document is compared with the hub it
    meets in most tables, set by set. (4) Tables that then still hold documents of several components are compared in
    full, in tiles, each pair at the first half key it shares: bitmaps bound the overlap, full sets decide. Pairs within
    one component are already decided; no other pair of a table is left out. Hashes have 64 bits, digests 128.

    Scale: shuffled are 2 * HALVES longs a document, the shared table keys, the set of each document with such a key, and
    again for each of its halves that still joins components. Keys, digests, hubs and halves that hold a large share of the
    rows are split. The driver sees counts.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("_row"), text_of(text_col).alias("text"))
    ids = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"))
    heads = written(texts.mapInArrow(_heads, "_row long, n long, digest binary, halves array<long>"), "tensor-heads")
    marks = heads.select("_row", "n", "digest")
    total = marks.count()
    classes = checkpointed(marks.filter("n > 0").groupBy("digest").agg(F.min("_row").alias("rep"), F.count(F.lit(1)).alias("_n")))
    member = checkpointed(attach(marks.filter("n > 0"), classes, ["digest"], "_n", total).select("_row", "rep"))

    reps = join_sized(heads.filter("n > 0"), member.filter("_row <> rep").select("_row"), "_row", "left_anti")
    halves = reps.select("_row", F.posexplode("halves").alias("place", "half"))
    shared = checkpointed(halves.groupBy("half").agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1"))
    held = attach(halves, shared, ["half"], "_m", shared.agg(F.coalesce(F.sum("_m"), F.lit(0))).first()[0])
    first = F.col("place") < HALVES
    by_row = held.groupBy("_row").agg(F.sum("_m").alias("known"), F.collect_list(F.when(first, F.col("half"))).alias("us"), F.collect_list(F.when(~first, F.col("half"))).alias("vs"))
    by_row = written(by_row.filter("size(us) > 0 AND size(vs) > 0"), "tensor-halves")
    keys = by_row.select("_row", "known", "vs", F.explode("us").alias("u")).select("_row", "known", "u", F.explode("vs").alias("v"))
    keys = keys.select("_row", "known", "u", F.xxhash64("u", "v").alias("key"))
    # the hub of a key: the document whose halves are shared most, which is the centre of its copies
    hub = F.max_by("_row", F.struct("known", "_row")).alias("hub")
    counted = checkpointed(keys.groupBy("key").agg(F.count(F.lit(1)).alias("_m"), hub).filter("_m > 1"))
    n_keyed = counted.agg(F.coalesce(F.sum("_m"), F.lit(0))).first()[0]
    keyed = written(attach(keys.drop("known"), counted, ["key"], "_m", n_keyed), "tensor-keys")

    wanted = checkpointed(keyed.select("_row").distinct())
    sets = written(join_sized(texts, wanted, "_row", "left_semi").mapInArrow(_sets, "_row long, n long, sig binary, items array<long>"), "tensor-sets")
    links = _links(_best_hubs(keyed), sets)
    live = _unsettled(keyed, links, n_keyed)
    if not live.isEmpty():
        links = checkpointed(links.unionByName(_tiled_links(live, heads, sets)))

    comp = checkpointed(components(links).select(F.col("node").alias("rep"), "component"))
    of_row = member.join(comp, "rep", "left").select("_row", F.coalesce("component", "rep").alias("component"))
    of_row = marks.select("_row", "n").join(ids, "_row").join(of_row, "_row", "left").withColumn("component", F.coalesce("component", "_row"))
    of_row = checkpointed(of_row)
    least = checkpointed(of_row.groupBy("component").agg(F.min("_id").alias("component_id"), F.count(F.lit(1)).alias("_m")))
    return attach(of_row, least, ["component"], "_m", total).select(
        "_row", F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("_row")
