"""Operator 7: remove bytes of repeated 400-byte strings, found in suffix arrays built by two-stage sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.anchors import anchors
from ledgerlake.llm.common import attach, checkpointed, table, text_of, written
from ledgerlake.llm.hashing import blocks

LENGTH = 400
GRAM = 220
CONTEXTS = 512  # contexts of one anchor that are sorted together
BINS = 8  # of the strings of an anchor with more contexts, by the place of the anchor
BUFFER = 256 << 10


# --- suffix arrays -------------------------------------------------------------------------------


def suffix_order(text: bytes, ends: list[int], keep: list[int]) -> list[int]:
    """Positions of ``text`` in the order of their suffixes, by two-stage sorting.

    ``text`` is a row of strings that end at ``ends``; a suffix stops at the end of its string. Wanted are the
    positions of each string before ``keep`` (one bound per string). A suffix is small if it is smaller than
    its successor. Small ones are sorted directly. All others follow from their successors: in a scan of the
    array from left to right, bucketed by first byte, each entry puts the large suffix before it at the head
    of its bucket. Past ``keep`` a string's suffixes are taken up to its next small one, which starts the chain.
    """
    n = len(text)
    a = np.frombuffer(text, np.uint8).astype(np.int16)
    step = np.empty(n, np.int16)
    step[:-1] = a[1:] - a[:-1]
    last = np.array(ends) - 1
    step[last] = -1  # the empty suffix comes first
    # equal bytes: like the next pair that differs
    turn = np.flatnonzero(step)
    small = step[turn[np.searchsorted(turn, np.arange(n))]] > 0
    wanted = np.zeros(n, bool)
    rises = np.flatnonzero(small)
    begin = 0
    for end, stop in zip(ends, keep, strict=True):
        at = int(np.searchsorted(rises, stop))
        upto = min(int(rises[at]) + 1 if at < len(rises) else end, end)
        wanted[begin : max(stop, upto) if stop > begin else begin] = True
        begin = end
    end_of = np.repeat(np.array(ends), np.diff(np.r_[0, ends]))
    direct = np.flatnonzero(wanted & small)
    stops = end_of[direct].tolist()
    keys = [text[i:e] for i, e in zip(direct.tolist(), stops, strict=True)]
    ranked = direct[sorted(range(len(keys)), key=keys.__getitem__)] if keys else direct
    large = wanted & ~small
    by_large = np.bincount(a[large], minlength=256)
    by_small = np.bincount(a[direct], minlength=256)
    first = np.concatenate([[0], np.cumsum(by_large + by_small)[:-1]])
    out = np.zeros(int(wanted.sum()), np.int64)
    if len(ranked):  # behind the large ones of their bucket, in order
        byte = a[ranked]
        inside = np.arange(len(ranked)) - np.searchsorted(byte, byte)
        out[(first + by_large)[byte] + inside] = ranked
    order, head = out.tolist(), first.tolist()
    is_large = large.tobytes()
    for i in last[large[last]].tolist():  # successors of the empty suffixes
        c = text[i]
        order[head[c]] = i
        head[c] += 1
    starts = np.zeros(n + 1, bool)
    starts[[0, *ends[:-1]]] = True
    is_start = starts.tobytes()
    for j in range(len(order)):
        p = order[j]
        if not is_start[p] and is_large[p - 1]:
            c = text[p - 1]
            order[head[c]] = p - 1
            head[c] += 1
    return order


def repeated(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, class) of every ``length``-byte part of the strings; equal parts have equal classes.

    Adjacent suffixes with a common prefix of ``length`` bytes are in one class.
    """
    text = b"".join(strings)
    ends = np.cumsum([len(s) for s in strings]).tolist()
    keep = [max(e - length + 1, e - len(s)) for e, s in zip(ends, strings, strict=True)]
    order = np.array(suffix_order(text, ends, keep), np.int64)
    of = np.searchsorted(ends, order, side="right")
    ok = order < np.array(keep)[of]
    order, of = order[ok], of[ok]
    same = np.zeros(len(order), bool)
    before = b""
    for i, p in enumerate(order.tolist()):
        now = text[p : p + length]
        same[i] = now == before
        before = now
    return of, order - (np.array(ends) - np.array([len(s) for s in strings]))[of], np.cumsum(~same)


# --- tasks -----------------------------------------------------------------------------------------


def _find_anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("_row").to_numpy()
            for first, a, off in blocks(batch.column("text")):
                at, h = anchors(a, off, length, gram)
                of = np.searchsorted(off, at, side="right") - 1
                lo = np.maximum(off[of], at - (length - gram))
                hi = np.minimum(off[of + 1], at + length)
                raw = a.tobytes()
                digests = [
                    hashlib.blake2b(raw[x:y], digest_size=8, salt=z.to_bytes(4, "little")).digest()
                    for x, y, z in zip(lo.tolist(), hi.tolist(), (at - lo).tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": pa.array(h.view(np.int64)),
                        "ctx": pa.array(np.frombuffer(b"".join(digests), np.int64)),
                        "_row": pa.array(rows[first + of]),
                        "lo": pa.array((lo - off[of]).astype(np.int32)),
                        "len": pa.array((hi - lo).astype(np.int32)),
                        "left": pa.array((at - lo).astype(np.int32)),
                    }
                )

    return run


def _cut(text: bytes, spans: list[dict]) -> dict:
    """The digest of a text without its spans."""
    edge = np.zeros(len(text) + 1, np.int32)
    for s in spans:
        edge[s["a"]] += 1
        edge[s["b"]] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    left = np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text
    runs = int((gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())) if len(text) else 0
    return {"n_bytes": len(text), "n_removed": len(text) - len(left), "n_spans": runs, "kept": left, "kept_sha256": hashlib.sha256(left).hexdigest()}


_DONE = pa.schema(
    [("_row", pa.int64()), ("_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
)
_DONE_DDL = "_row long, _id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
_FIRST = pa.schema([("kind", pa.int32()), *_DONE, ("text", pa.binary()), ("spans", _SPANS), ("anchor", pa.int64()), ("part", pa.int32()), ("core", pa.int64()), ("single", pa.bool_()), ("lo", pa.int32())])
_FIRST_DDL = f"kind int, {_DONE_DDL}, text binary, spans array<struct<a:int,b:int>>, anchor long, part int, core long, single boolean, lo int"


def _pieces(text: bytes, left: int, length: int, gram: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(bin, hash of its core, start, bytes) of the strings of a context whose anchor is ``left`` bytes in.

    Strings go to bins by how far in they hold the anchor. Those of a bin have a core in common, all but
    length / BINS or so of their bytes; strings of two contexts can only be equal if the cores of a bin are.
    """
    width = -(-(length - gram + 1) // BINS)
    for b in range(BINS):
        core = text[left - b * width : left - (b + 1) * width + 1 + length]
        low, high = max(0, left - (b + 1) * width + 1, left - (length - gram)), min(left - b * width, len(text) - length)
        if low <= high:
            yield b, int.from_bytes(hashlib.blake2b(core, digest_size=8).digest(), "big", signed=True), low, text[low : high + length]


def _first_cut(keep_text: bool, length: int, gram: int):
    """Texts whose spans are all known are done (kind 0); of others the text (1) and the asked contexts (2, whole or
    in bins) go on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, doc, text, spans, asked in zip(*(batch.column(c).to_pylist() for c in ("_row", "_id", "text", "spans", "asked")), strict=True):
                if not asked:
                    done = _cut(text, spans or [])
                    out.append({"kind": 0, "_row": row, "_id": doc, **done, "kept": done["kept"] if keep_text else None})
                    continue
                out.append({"kind": 1, "_row": row, "_id": doc, "text": text, "spans": spans or []})
                for q in asked:
                    context = text[q["lo"] : q["lo"] + q["len"]]
                    pieces = _pieces(context, q["left"], length, gram) if q["many"] else [(None, None, 0, context)]
                    for part, core, at, piece in pieces:
                        out.append({"kind": 2, "_row": row, "anchor": q["anchor"], "single": q["single"], "part": part, "core": core, "lo": q["lo"] + at, "text": piece})
                if len(out) > 5000:
                    yield pa.RecordBatch.from_pylist(out, _FIRST)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, _FIRST)

    return run


def _last_cut(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, doc, text, spans, more in zip(*(batch.column(c).to_pylist() for c in ("_row", "_id", "text", "spans", "more")), strict=True):
                done = _cut(text, (spans or []) + (more or []))
                out.append({"_row": row, "_id": doc, **done, "kept": done["kept"] if keep_text else None})
            if out:
                yield pa.RecordBatch.from_pylist(out, _DONE)

    return run


_FOUND = pa.schema([("_row", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()), ("known", pa.bool_())])


def _sort_contexts(length: int):
    """Rows come sorted by key. Spans of strings repeated within a group; of groups that hold only a share of the
    texts that could be equal also a digest of each distinct string, to be compared with the other shares."""

    def flush(pending: list[tuple]) -> pa.RecordBatch:
        of, start, cls = repeated([t for *_, t in pending], length)
        # contexts of one text overlap: a class counts its distinct places
        row = np.array([p[1] for p in pending])[of]
        place = np.array([p[2] for p in pending])[of] + start
        size = np.bincount(cls)
        twin = np.flatnonzero(size[cls] > 1)
        twin = twin[np.lexsort((place[twin], row[twin], cls[twin]))]
        again = (cls[twin][1:] == cls[twin][:-1]) & (row[twin][1:] == row[twin][:-1]) & (place[twin][1:] == place[twin][:-1])
        np.subtract.at(size, cls[twin][1:][again], 1)
        rows = {c: [] for c in _FOUND.names}

        def add(*values) -> None:
            for c, v in zip(_FOUND.names, values, strict=True):
                rows[c].append(v)

        many = np.array([p[3] for p in pending])
        single = np.array([p[4] for p in pending])
        hit = np.flatnonzero((size[cls] > 1) & single[of])
        hit = hit[np.lexsort((start[hit], of[hit]))]
        if len(hit):  # runs of neighbouring starts make one span
            new = np.r_[True, (of[hit][1:] != of[hit][:-1]) | (start[hit][1:] > start[hit][:-1] + 1)]
            heads = np.flatnonzero(new)
            for h, t in zip(heads, np.r_[heads[1:], len(hit)] - 1, strict=True):
                p = pending[of[hit[h]]]
                add(p[1], p[2] + int(start[hit[h]]), p[2] + int(start[hit[t]]) + length, None, None, None)
        seen = set()
        for i in np.flatnonzero(many[of]):
            if size[cls[i]] > 1:
                if cls[i] in seen:
                    continue
                seen.add(cls[i])
            p, s = pending[of[i]], int(start[i])
            d = np.frombuffer(hashlib.blake2b(p[5][s : s + length], digest_size=16).digest(), np.int64)
            add(p[1], p[2] + s, p[2] + s + length, int(d[0]), int(d[1]), size[cls[i]] > 1 or not single[of[i]])
        return pa.RecordBatch.from_pydict({f.name: pa.array(rows[f.name], f.type) for f in _FOUND}, _FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []
        held, key = 0, None
        for batch in batches:
            cols = (batch.column(c).to_pylist() for c in ("key", "_row", "lo", "many", "single", "text"))
            for new, row, lo, many, single, text in zip(*cols, strict=True):
                if new != key:
                    if held > BUFFER or (pending and (many or pending[-1][3])):
                        yield flush(pending)
                        pending, held = [], 0
                    key = new
                pending.append((key, row, lo, many, single, text))
                held += len(text)
        if pending:
            yield flush(pending)

    return run


# --- the operator ------------------------------------------------------------------------------------


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    contexts: int = CONTEXTS,
    keep_text: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: _row, id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left).

    Every byte covered by a ``length``-byte string that also starts anywhere else in the corpus, the same
    text included, is removed; strings never cross texts and are judged on the input. Null and empty texts
    have no bytes. Repeated rows repeat each other. Null ids are kept. An empty table gives none.
    A very long text is cut whole, in blocks. Other columns are ignored, whatever their names.

    How. Every string has a content-chosen anchor, so equal strings share one. Anchors seen once are done with.
    The context of an anchor is all strings that have it, at most 2 * length - gram bytes. Equal contexts
    (64 bits of a digest beside the 64 of the anchor) seen twice are repeated as a whole. Where an anchor
    has different contexts, one of each is fetched, and the suffix array of the contexts of an anchor,
    by two-stage sorting, shows by its adjacent common prefixes which strings repeat. The contexts of an
    anchor with more than ``contexts`` are first told apart by longer cores (see ``_pieces``); where a core, too, is
    held by more, shares of them are sorted apart and then exchange 128-bit digests of their distinct
    strings, so that no group, however large, is one task.

    Scale: rows move per anchor (about 2 / (length - gram) of the bytes), texts once, contexts only where
    they differ; whatever is grouped by anchor goes through ``attach``.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("text"))
    found = texts.select("_row", "text").mapInArrow(_find_anchors(length, gram), "anchor long, ctx long, _row long, lo int, len int, left int")
    found = written(found, "suffix-anchors")
    total = found.count()
    shared = found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), (F.min("ctx") != F.max("ctx")).alias("differ")
    ).filter("n > 1")
    here = written(attach(found, checkpointed(shared), ["anchor"], "n", total).drop("n"), "suffix-shared")
    kinds = here.groupBy("anchor", "ctx").agg(
        F.count(F.lit(1)).alias("m"),
        F.min("_row").alias("_row"),
        F.min_by("lo", "_row").alias("lo"),
        F.min("len").alias("len"),
        F.min("left").alias("left"),
        F.max("differ").alias("differ"),
    )
    kinds = written(kinds, "suffix-contexts")
    n_here = here.count()
    whole = attach(here.select("anchor", "ctx", "_row", "lo", "len"), kinds.select("anchor", "ctx", "m"), ["anchor", "ctx"], "m", n_here).filter("m > 1")
    # a text has at most one anchor per byte
    spans = whole.groupBy("_row").agg(F.collect_list(F.struct(F.col("lo").alias("a"), (F.col("lo") + F.col("len")).alias("b"))).alias("spans"))

    differ = kinds.filter("differ").select("anchor", "ctx", "m", "_row", "lo", "len", "left")
    per = checkpointed(differ.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")))
    differ = attach(differ, per, ["anchor"], "k", n_here)
    ask = F.struct("anchor", (F.col("k") > contexts).alias("many"), (F.col("m") == 1).alias("single"), "lo", "len", "left")
    asked = differ.groupBy("_row").agg(F.collect_list(ask).alias("asked"))
    joined = texts.join(spans, "_row", "left").join(asked, "_row", "left").select("_row", "_id", F.col("text").cast("binary").alias("text"), "spans", "asked")
    first = written(joined.mapInArrow(_first_cut(keep_text, length, gram), _FIRST_DDL), "suffix-texts")

    pieces = first.filter("kind = 2").select("anchor", "part", "core", "_row", "lo", "single", "text")
    few = pieces.filter("part IS NULL").select(F.xxhash64("anchor").alias("key"), "_row", "lo", F.lit(False).alias("many"), "single", "text")
    binned = pieces.filter("part IS NOT NULL")
    alike = binned.groupBy("anchor", "part", "core").agg(F.count(F.lit(1)).alias("k"), (F.min("_row") != F.max("_row")).alias("rows"), (F.min("lo") != F.max("lo")).alias("places"))
    alike = checkpointed(alike.filter("rows OR places").select("anchor", "part", "core", "k"))
    binned = attach(binned, alike, ["anchor", "part", "core"], "k", n_here)
    share = F.pmod(F.xxhash64("_row", "lo"), F.ceil(F.col("k") / contexts))
    binned = binned.select(F.xxhash64("anchor", "part", "core", share).alias("key"), "_row", "lo", (F.col("k") > contexts).alias("many"), "single", "text")
    pieces = few.unionByName(binned).repartition("key").sortWithinPartitions("key")
    hits = written(pieces.mapInArrow(_sort_contexts(length), "_row long, a int, b int, d1 long, d2 long, known boolean"), "suffix-hits")
    across = hits.filter("d1 IS NOT NULL")
    place = F.struct("_row", "a")
    twice = checkpointed(across.groupBy("d1", "d2").agg((F.max("known") | (F.min(place) != F.max(place))).alias("again")).filter("again"))
    more = across.filter("NOT known").join(twice, ["d1", "d2"], "left_semi").select("_row", "a", "b")
    more = more.unionByName(hits.filter("d1 IS NULL").select("_row", "a", "b"))
    more = more.groupBy("_row").agg(F.collect_list(F.struct("a", "b")).alias("more"))
    last = first.filter("kind = 1").select("_row", "_id", "text", "spans").join(more, "_row", "left")
    last = last.mapInArrow(_last_cut(keep_text), _DONE_DDL)
    return first.filter("kind = 0").select(*_DONE.names).unionByName(last).withColumnRenamed("_id", id_col)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"), keep_text=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("has_repeats"))
