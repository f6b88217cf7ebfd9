"""Operator 1: Jaccard join of 5-word shingle sets in size-banded tiles with bitmap bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import HOT_SHARE, attach, checkpointed, table, text_of, whole_groups, whole_rows, written
from ledgerlake.llm.components import components
from ledgerlake.llm.hashing import blocks, lists, mix, shingle_sets, trimmed, views
from ledgerlake.operators.joins import join_sized

SHINGLE = 5
NUMERATOR, DENOMINATOR = 80, 100  # linked when DENOMINATOR * intersection >= NUMERATOR * union
SKETCH = 1 << 16
BITS = 1024  # of the bitmap of a small set; larger sets have the next power of two above their size
TILE = 2048
TILE_ITEMS = 1 << 22  # shingles of the documents of a part, whose sets a task may hold
BAND = 1.26  # ratio of the sizes of a band, a little above 1 / 0.8: linked sets are in one band or in neighbouring ones
HUB_ROUNDS = 2


@trimmed
def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts' shingles fall into each of SKETCH buckets."""
    n = np.zeros(SKETCH, np.int64)
    for batch in batches:
        for _, a, off in blocks(batch.column("text")):
            sets = shingle_sets(a, off, SHINGLE)
            n += np.bincount((np.concatenate(sets) >> np.uint64(48)).astype(np.int64), minlength=SKETCH)
    used = np.flatnonzero(n)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()), "n": pa.array(n[used], pa.int64())})


def prefix_length(n: int) -> int:
    """So many first shingles, in one order for all sets, that two linked sets share one of them."""
    least = -(-NUMERATOR * n // DENOMINATOR)
    return n - least + 1 if n else 0


def _prefixes(rare: np.ndarray):
    """Per text: set size, digest of the set, and its prefix in the order (bucket count, hash)."""

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("_row").to_numpy()
            for first, a, off in blocks(batch.column("text")):
                sets = shingle_sets(a, off, SHINGLE)
                heads = []
                for s in sets:
                    p = prefix_length(len(s))
                    order = np.argsort(rare[(s >> np.uint64(48)).astype(np.int64)], kind="stable")[:p]  # s is sorted by hash
                    heads.append(s[order])
                yield pa.RecordBatch.from_pydict(
                    {
                        "_row": pa.array(rows[first : first + len(sets)]),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        "head": lists(heads, pa.int64()),
                        "sig": pa.array([bitmap(s) for s in sets], pa.binary()),
                    }
                )

    return run


def bitmap(s: np.ndarray) -> bytes:
    """One hashed bit per item. Of a power of two of bits, so that a bitmap can be folded to the width of a smaller one."""
    width = max(BITS, 1 << max(len(s) - 1, 0).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(mix(s) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def folded(sig: np.ndarray, words: int) -> np.ndarray:
    """The bitmap (as 64-bit words) that the set has at a smaller width."""
    return sig if len(sig) == words else np.bitwise_or.reduce(sig.reshape(-1, words), axis=0)


@trimmed
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("_row").to_numpy()
        for first, a, off in blocks(batch.column("text")):
            sets = shingle_sets(a, off, SHINGLE)
            yield pa.RecordBatch.from_pydict(
                {
                    "_row": pa.array(rows[first : first + len(sets)]),
                    "items": lists(sets, pa.int64()),
                }
            )


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets, arrays sorted as unsigned, overlap enough."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    if not len(x) or DENOMINATOR * len(x) < NUMERATOR * len(y):
        return False
    x, y = x.view(np.uint64), y.view(np.uint64)
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sorted arrays really intersect enough."""
    for batch in batches:
        keep = [i for i, (x, y) in enumerate(zip(views(batch.column("sa")), views(batch.column("sb")), strict=True)) if linked(x, y)]
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


@trimmed
def _tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in whole_groups(batches, "tile"):
        yield from _tile_pairs(t)


@trimmed
def _tile_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in whole_groups(batches, "tile"):
        yield from _tile_links(t)


def _met(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, Iterator]]:
    """Per tile: its rows by size, the labels of their components, and ``_may_meet`` of them."""
    tiles = t.column("tile").to_numpy()
    bounds = np.flatnonzero(np.r_[True, tiles[1:] != tiles[:-1], True])
    n, comp, above, side = (t.column(c).to_numpy() for c in ("n", "comp", "above", "side"))
    sigs = [np.frombuffer(x, np.uint64) for x in t.column("sig").to_pylist()]
    tokens = [x for c in t.column("tokens").chunks for x in views(c)]
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        order = lo + np.argsort(n[lo:hi], kind="stable")
        label = comp[order]
        yield order, label, _may_meet(n[order], above[order], side[order], label, [tokens[k] for k in order], [sigs[k] for k in order])


def _may_meet(s: np.ndarray, up: np.ndarray, d: np.ndarray, label: np.ndarray, tokens: list, sigs: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, others, bounds of the overlaps): each pair of a tile once, of different labels at that time, that shares a token and
    that sizes and bit counts don't exclude.

    |A ^ B| is at least the number of bits in which the bitmaps differ, so (|A| + |B| - that) / 2 bounds the overlap
    from above. Pairs of the band above belong to its own tile, pairs of one part to that part's.
    """
    held = np.repeat(np.arange(len(s)), [len(x) for x in tokens])
    of = np.concatenate(tokens)
    by = np.argsort(of, kind="stable")
    of, held = of[by], held[by]
    mixed, at = (d != d[0]).any(), {}
    for i in range(len(s) - 1):
        x, y = np.searchsorted(of, tokens[i], side="left"), np.searchsorted(of, tokens[i], side="right")
        z = np.unique(np.concatenate([held[a:b] for a, b in zip(x, y, strict=True)]))
        z = z[(z > i) & (DENOMINATOR * s[i] >= NUMERATOR * s[z]) & (label[z] != label[i]) & ~(up[z] & up[i])]
        z = z[d[z] != d[i]] if mixed else z
        if not len(z):
            continue
        w = len(sigs[i])
        if w not in at:  # all from here on, at the width of this one: bitmaps widen with the size
            at = {w: np.stack([folded(x, w) for x in sigs[i:]]), -1: i}
        far = np.bitwise_count(at[w][z - at[-1]] ^ at[w][i - at[-1]]).sum(axis=1, dtype=np.int64)
        both = (s[z] + s[i] - far) // 2
        may = DENOMINATOR * both >= NUMERATOR * (s[z] + s[i] - both)
        if may.any():
            yield i, z[may], both[may]


def _tile_pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) that may be linked; of a tile with more pairs than documents only these documents, as (a, a)."""
    row, tile = t.column("_row").to_numpy(), t.column("tile").to_numpy()
    for order, _, met in _met(t):
        r, out, many = row[order], [], np.zeros(len(order), bool)
        size = 0
        for i, z, _ in met:
            many[i] = many[z] = True
            size += len(z)
            if size <= len(order):
                out.append(np.stack([np.minimum(r[z], r[i]), np.maximum(r[z], r[i])]))
        if size:
            a, b = np.concatenate(out, axis=1) if size <= len(order) else (r[many], r[many])
            yield pa.RecordBatch.from_pydict({"tile": pa.array(np.full(len(a), tile[order[0]])), "a": pa.array(a), "b": pa.array(b)})


def _tile_links(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links that join the components of a tile, decided on the sets, the likeliest first: at most one a document. A link joins
    two components for the rest of the tile."""
    row, items = t.column("_row").to_numpy(), [x for c in t.column("items").chunks for x in views(c)]
    for order, label, met in _met(t):
        r, out = row[order], []
        for i, z, both in met:
            for k in z[np.argsort(-both, kind="stable")]:
                if label[k] != label[i] and linked(items[order[i]], items[order[k]]):
                    out.append((min(r[i], r[k]), max(r[i], r[k])))
                    label[label == label[k]] = label[i]
        if out:
            a, b = np.array(out, np.int64).T
            yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})


def _near(a: str, b: str) -> str:
    return f"{DENOMINATOR} * least({a}, {b}) >= {NUMERATOR} * greatest({a}, {b})"


def _bounded(hubs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b): the documents and their hubs whose sizes and bitmaps allow a link."""
    side = lambda x, c: sizes.select(F.col("_row").alias(c), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    met = hubs.join(side("a", "_row"), "_row").join(side("b", "hub"), "hub").filter(_near("na", "nb"))
    return met.select(F.least("_row", "hub").alias("a"), F.greatest("_row", "hub").alias("b"), "na", "nb", "sa", "sb").mapInArrow(
        _may_link, "a long, b long"
    ).distinct()


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        cols = (batch.column(c).to_pylist() for c in ("na", "nb", "sa", "sb"))
        for i, (na, nb, sa, sb) in enumerate(zip(*cols, strict=True)):
            x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
            w = min(len(x), len(y))
            both = (na + nb - int(np.bitwise_count(folded(x, w) ^ folded(y, w)).sum(dtype=np.int64))) // 2
            if DENOMINATOR * both >= NUMERATOR * (na + nb - both):
                keep.append(i)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by token: those of tokens of several rows, with the smallest row of the token."""
    rest: list[tuple[np.ndarray, np.ndarray]] = []  # of the last token so far

    def out(token: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.empty(0, np.int64)
        size = np.diff(np.r_[start, len(token)])
        hub = np.minimum.reduceat(row, start) if len(token) else row
        keep = np.repeat(size > 1, size)
        return pa.RecordBatch.from_pydict({"_row": pa.array(row[keep]), "token": pa.array(token[keep]), "hub": pa.array(np.repeat(hub, size)[keep])})

    for batch in batches:
        token, row = batch.column("token").to_numpy(), batch.column("_row").to_numpy()
        if not len(token):
            continue
        rest.append((token, row))
        if token[0] == token[-1] == rest[0][0][-1]:  # one long run goes on
            continue
        token, row = (np.concatenate(x) for x in zip(*rest, strict=True))
        cut = int(np.flatnonzero(token != token[-1])[-1]) + 1 if (token != token[-1]).any() else 0
        if cut:
            yield out(token[:cut], row[:cut])
        rest = [(token[cut:], row[cut:])]
    if rest:
        yield out(*(np.concatenate(x) for x in zip(*rest, strict=True)))


def _sets_of(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(_row, items): the sorted sets of the documents that ``rows`` names."""
    wanted = checkpointed(rows.select("_row").distinct())
    return written(join_sized(texts, wanted, "_row", "left_semi").mapInArrow(_sets, "_row long, items array<long>"), "ngram-sets")


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, decided on the sorted arrays.

    Sets are made of the texts of the documents in pairs only; a document in very many pairs is split by AQE.
    """
    sets = _sets_of(texts, pairs.select(F.explode(F.array("a", "b")).alias("_row")))
    side = lambda x: sets.select(F.col("_row").alias(x), F.col("items").alias(f"s{x}"))
    full = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "sa", "sb")
    return full.mapInArrow(_verified, "a long, b long")


def _tiled_links(live: DataFrame, sizes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links enough to join what is linked among the documents of different components that share a token of ``live``.

    Tokens are brought together by the smallest component that holds them, so the documents of a family meet once and not
    at each token. Sizes fall into bands of ratio BAND: a tile holds a band and the one above, beyond which no link reaches.
    A band of more than TILE documents or TILE_ITEMS shingles is dealt to parts; each two of them, and each with itself, are
    a tile. Bitmaps bound the overlaps. The pairs of a tile that then may be linked are sent out to meet their sets if there are
    no more of them than documents; else the sets come to the tile, which gives at most one link a document.
    """
    at = checkpointed(live.groupBy("lo", "_row", "comp").agg(F.collect_list("token").alias("tokens")))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(BAND))).cast("int")
    places = F.explode(F.array(F.struct(band.alias("band"), F.lit(False).alias("above")), F.struct((band - 1).alias("band"), F.lit(True).alias("above"))))
    dealt = checkpointed(at.select("lo", "_row", "comp").join(sizes.select("_row", "n"), "_row").select("lo", "_row", "comp", "n", places.alias("p")).select("lo", "_row", "comp", "n", "p.*"))
    per = checkpointed(dealt.groupBy("lo", "band").agg(F.count(F.lit(1)).alias("_m"), F.sum("n").alias("_items")).filter("_m > 1"))
    parts = F.ceil(F.greatest(F.col("_m") / TILE, F.col("_items") / TILE_ITEMS)).cast("int")
    tiled = (
        attach(dealt.drop("n"), per, ["lo", "band"], "_m", dealt.count())
        .withColumn("_parts", parts)
        .withColumn("_part", F.pmod(F.xxhash64("_row"), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .select(
            F.xxhash64("lo", "band", F.least("_part", "_other"), F.greatest("_part", "_other")).alias("tile"), "lo", "_row", "comp", "above",
            F.when(F.col("_part") <= F.col("_other"), 0).otherwise(1).alias("side"),
        )
    )
    facts = lambda some: some.join(at.select("lo", "_row", "tokens"), ["lo", "_row"]).join(sizes, "_row").drop("lo")
    dealt_to = lambda whole: whole.repartition("tile").sortWithinPartitions("tile")
    found = checkpointed(dealt_to(facts(tiled)).mapInArrow(_tile, "tile long, a long, b long"))
    links = _links(checkpointed(found.filter("a <> b").select("a", "b").distinct()), texts)
    many = found.filter("a = b").select("tile", F.col("a").alias("_row"))
    n_many = many.count()
    if n_many:
        again = facts(join_sized(tiled, many, ["tile", "_row"], "left_semi", small_rows=n_many))
        met = again.join(_sets_of(texts, many), "_row")
        links = links.unionByName(dealt_to(met).mapInArrow(_tile_sets, "a long, b long"))
    return links


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: _row, id, n_shingles, component_id, set_class (row of the equal set's first).

    A document's set: its distinct 5-word shingles (A-Z lowered); with fewer words the whole sequence as
    one; null, empty and blank texts have none and are linked with nothing, each a component of its own. Two
    documents link when 100 * intersection >= 80 * union; component_id is the smallest id reachable by links.
    Repeated rows are documents with equal sets. An empty table gives none. A very long text is a
    block of its own. Other columns are ignored, whatever their names.

    How. (1) A fixed-size sketch counts shingles by bucket; ordering every set by it, rare first, keeps
    passages that many documents share out of the prefixes. (2) Sets are equal by digest; one document
    stands for each. (3) Linked sets share a shingle of their prefixes (the first fifth), so only documents
    that share one are compared. (4) Rounds pair each document with the hub of its shingles that it shares
    most with; where the bitmaps allow a link the sorted arrays decide. (5) Shingles that then still join several components are
    compared in full: tiles of size bands, up to TILE x TILE documents, only sizes in a ratio of 0.8 meeting, bitmaps
    bounding the overlap, arrays deciding. Pairs within one component are already
    decided and are left out; no other pair is. A tile with more such pairs than documents reads the arrays itself and
    gives the links that join its components. Hashes have 64 bits, digests 128.

    Scale: shuffled are a fifth of the shingles, once, as longs (those of frequent buckets counted in the map
    tasks first), and the sets of documents whose bitmaps allow a link. Sides that are small by count are
    broadcast, else joined by shuffle.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("_row"), text_of(text_col).alias("text"))
    ids = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"))

    counts = texts.select("text").mapInArrow(_count_buckets, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rare = np.zeros(SKETCH, np.int64)
    for r in counts.collect():  # SKETCH rows at most
        rare[r["bucket"]] = r["n"]
    # within noise all are alike: only what stands out moves back
    level = np.maximum(np.log2(np.maximum(rare, 1) / max(float(np.median(rare)), 1.0)) * 8, 0).astype(np.int32)

    heads = written(texts.mapInArrow(_prefixes(level), "_row long, n long, digest binary, head array<long>, sig binary"), "ngram-heads")
    marks = heads.select("_row", "n", "digest")
    total = marks.count()
    classes = checkpointed(marks.groupBy("digest").agg(F.min("_row").alias("rep"), F.count(F.lit(1)).alias("_n")))
    member = checkpointed(attach(marks.filter("n > 0"), classes, ["digest"], "_n", total).select("_row", "rep"))
    copies = member.filter("_row <> rep").select("_row")

    # shingles several documents share; those of frequent buckets may be held by very many
    often = np.flatnonzero(rare > max(10 * total / HOT_SHARE, 2 * float(np.median(rare)))).tolist()
    tokens = join_sized(heads.filter("n > 0").select("_row", "head"), copies, "_row", "left_anti").select("_row", F.explode("head").alias("token"))
    hot = F.shiftrightunsigned("token", 48).isin(often) if 0 < len(often) <= 2000 else F.lit(bool(often))
    plain = tokens.filter(~hot).repartition("token").sortWithinPartitions("token").mapInArrow(_shared, "_row long, token long, hub long")
    counted = checkpointed(tokens.filter(hot).groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("_row").alias("hub")).filter("m > 1"))
    n_hot = counted.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n")).first()["n"]
    tokens = written(plain.unionByName(attach(tokens.filter(hot), counted, ["token"], "m", n_hot).drop("m")), "ngram-tokens")
    n_tokens = tokens.count()

    sizes = heads.select("_row", "n", "sig")
    pairs = checkpointed(_bounded(_best_hubs(tokens.filter("_row <> hub")), sizes))
    links = checkpointed(_links(pairs, texts))
    live = _unsettled(tokens.select("_row", "token"), links, n_tokens)
    for k in range(HUB_ROUNDS - 1):
        if live.isEmpty():
            break
        rank = F.xxhash64("comp", F.lit(k))  # the hub of a shingle: of its component of the smallest hash
        ends = live.groupBy("token").agg(F.min_by("_row", rank).alias("hub"), F.min_by("comp", rank).alias("hub_comp"), F.count(F.lit(1)).alias("_m"))
        met = attach(live, checkpointed(ends), ["token"], "_m", n_tokens).filter("comp <> hub_comp")
        pairs = checkpointed(_bounded(_best_hubs(met), sizes))
        links = checkpointed(links.unionByName(_links(pairs, texts)))
        live = _unsettled(live.select("_row", "token"), links, n_tokens)
    if not live.isEmpty():
        links = checkpointed(links.unionByName(_tiled_links(live, sizes, texts)))

    # one id per component, over the documents of all its classes
    comp = components(links).select(F.col("node").alias("rep"), "component")
    of_row = member.join(checkpointed(comp), "rep", "left").select("_row", "rep", F.coalesce("component", "rep").alias("component"))
    of_row = checkpointed(marks.select("_row", "n").join(ids, "_row").join(of_row, "_row", "left"))
    of_row = of_row.withColumn("component", F.coalesce("component", "_row"))
    least = checkpointed(of_row.groupBy("component").agg(F.min("_id").alias("component_id"), F.count(F.lit(1)).alias("_m")))
    return attach(of_row, least, ["component"], "_m", total).select(
        "_row", F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce("rep", "_row").alias("set_class"), "component"
    )


def _best_hubs(met: DataFrame) -> DataFrame:
    """(_row, hub): of the hubs a document meets at its shingles, the one it meets most often."""
    votes = met.groupBy("_row", "hub").agg(F.count(F.lit(1)).alias("v"))
    return votes.groupBy("_row").agg(F.max_by("hub", F.struct("v", "hub")).alias("hub"))


def _unsettled(tokens: DataFrame, links: DataFrame, total: int) -> DataFrame:
    """(_row, token, comp, lo, m) of the tokens that still join documents of several components, lo the smallest of them."""
    comp = checkpointed(components(links).withColumnRenamed("node", "_row").withColumnRenamed("component", "comp"))
    now = join_sized(tokens, comp, "_row", "left").withColumn("comp", F.coalesce("comp", "_row"))
    ends = now.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
    several = checkpointed(ends.filter("lo <> hi").select("token", "lo", "m"))
    return written(attach(now, several, ["token"], "m", total), "ngram-live")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component stays, whole: that of the smallest id (of repeated ids the first)."""
    marks = jaccard_classes(docs)
    best = marks.groupBy("component").agg(
        F.coalesce(F.min_by("_row", "doc_id"), F.min("_row")).alias("_row")
    )
    gone = marks.select("_row").join(best.select("_row"), "_row", "left_anti")
    return whole_rows(docs).join(gone, "_row", "left_anti").select("_doc.*")
