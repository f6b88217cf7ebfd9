"""Operator 9: pack documents into fixed windows with the lexically nearest unused documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import table, text_of, written
from ledgerlake.llm.hashing import trimmed
from ledgerlake.llm.tokens import worker_bpe

WINDOW = 1024
END = 0  # the id after each document
SHARD_DOCS = 1024  # documents of one inverted index
TASK_BYTES = 24 << 20
QUERY_TERMS = 32
LOOK = 48  # nearest neighbours tried whole before one is cut
K1, B = 1.2, 0.75


class Bm25:
    """Inverted index of one shard: postings by term with BM25 weights; the terms are token ids.

    ``stats``: the number of documents of the whole table, their mean length and how many hold each term.
    """

    def __init__(self, docs: list[np.ndarray], stats: tuple[int, float, np.ndarray] | None = None) -> None:
        found = [np.unique(d, return_counts=True) for d in docs]
        size = np.array([max(len(d), 1) for d in docs], np.float64)
        of = np.repeat(np.arange(len(docs)), [len(t) for t, _ in found])
        term = np.concatenate([t for t, _ in found]) if found else np.empty(0, np.uint32)
        tf = np.concatenate([c for _, c in found]).astype(np.float64) if found else np.empty(0)
        df = np.bincount(term, minlength=1) if len(term) else np.zeros(1)
        total, mean, held = stats or (len(docs), size.mean() if len(docs) else 1.0, df)
        idf = np.log1p((total - held + 0.5) / (held + 0.5))
        norm = K1 * (1 - B + B * size / mean)
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[of]) if len(term) else tf
        self.n = len(docs)
        self.begin = np.concatenate([[0], np.cumsum([len(t) for t, _ in found])]).astype(np.int64)
        self.term, self.weight = term, weight
        order = np.argsort(term, kind="stable")
        self.docs, self.by_term = of[order], weight[order]
        self.at = np.concatenate([[0], np.cumsum(df)]).astype(np.int64)

    def scores(self, seed: int, terms: int = QUERY_TERMS) -> np.ndarray:
        """Of all documents of the shard, for the heaviest terms of the seed."""
        z = slice(self.begin[seed], self.begin[seed + 1])
        t, w = self.term[z], self.weight[z]
        if len(t) > terms:
            t = t[np.argpartition(-w, terms)[:terms]]
        spans = [slice(self.at[x], self.at[x + 1]) for x in t]
        if not spans:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.docs[s] for s in spans]), np.concatenate([self.by_term[s] for s in spans]), self.n)


def pack_shard(docs: list[np.ndarray], window: int = WINDOW, stats: tuple[int, float, np.ndarray] | None = None) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold every id of ``docs`` once.

    Whole windows of a long document are cut off first. Then the longest unused rest is the seed of a window;
    its nearest unused neighbours fill it in order of score, whole while they fit, the nearest of those
    that don't fit is cut to the space left. Only the last sequence can be shorter than the window.
    """
    out: list[list[tuple[int, int, int]]] = []
    start = np.zeros(len(docs), np.int64)
    rest = np.array([len(d) for d in docs], np.int64)
    for i, n in enumerate(rest):
        for k in range(0, int(n) // window * window, window):
            out.append([(i, k, window)])
        start[i] = int(n) // window * window
    rest = rest % window
    index = Bm25(docs, stats)
    order = np.lexsort((np.arange(len(docs)), -rest))
    place = 0
    unused = rest > 0
    left = int(unused.sum())

    def take(i: int, space: int) -> tuple[int, int, int]:
        nonlocal left
        n = min(int(rest[i]), space)
        piece = (i, int(start[i]), n)
        start[i] += n
        rest[i] -= n
        if not rest[i]:
            unused[i] = False
            left -= 1
        return piece

    while left:
        while not unused[order[place]]:
            place += 1
        seed = int(order[place])
        pieces = [take(seed, window)]
        space = window - pieces[0][2]
        score = np.where(unused, index.scores(seed), -1.0) if space and left else None
        while space and left:
            k = min(LOOK, left)
            near = np.argpartition(-score, k - 1)[:k]
            near = near[np.lexsort((near, -score[near]))]
            cut = -1
            for i in near:
                if rest[i] <= space:
                    space -= int(rest[i])
                    pieces.append(take(int(i), window))
                    score[i] = -1.0
                    if not space:
                        break
                elif cut < 0:
                    cut = int(i)
            if space and cut >= 0:
                pieces.append(take(cut, space))
                space = 0
        out.append(pieces)
    return out


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _encoded(path: str | None):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = worker_bpe(path, whole=True), np.array([END], np.uint32).tobytes()
        for batch in batches:
            for k in range(0, len(batch), 256):
                some = batch.slice(k, 256)
                ids = [t + end for t in map(bytes, bpe.encode(some.column("text").to_pylist()))]
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("_id", "_lang", "_hash", "_row")), pa.array(ids, pa.binary())], names=["_id", "_lang", "_hash", "_row", "ids"])

    return run


@trimmed
def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term (and all documents, -1, and their ids, -2) of a task."""
    held, docs, size = np.zeros(0, np.int64), 0, 0
    for batch in batches:
        for t in batch.column("ids").to_pylist():
            ids = np.frombuffer(t, np.uint32)
            terms = np.unique(ids)
            if terms[-1] >= len(held):
                held = np.concatenate([held, np.zeros(int(terms[-1]) + 1 - len(held), np.int64)])
            held[terms] += 1
            docs, size = docs + 1, size + len(ids)
    seen = np.flatnonzero(held)
    yield pa.RecordBatch.from_pydict({"term": pa.array(np.r_[-1, -2, seen]), "n": pa.array(np.r_[docs, size, held[seen]])})


def statistics(ids: DataFrame) -> tuple[int, float, np.ndarray]:
    """Number of documents, mean length and documents per term of the whole table; one row per term is collected."""
    rows = ids.select("ids").mapInArrow(_count_terms, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in rows}
    docs, size = found.pop(-1, 0), found.pop(-2, 0)
    held = np.zeros(max(found, default=0) + 1)
    held[list(found)] = list(found.values())
    return docs, size / max(docs, 1), held


def _packer(window: int, shard_docs: int, stats: tuple[int, float, np.ndarray]):
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made = 0
        pending: list[tuple[int | None, np.ndarray]] = []

        def flush(shard: list[tuple[int | None, np.ndarray]]) -> pa.RecordBatch:
            nonlocal made
            cols: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            docs = [d for _, d in shard]
            for pieces in pack_shard(docs, window, stats):
                at = 0
                for i, s, n in pieces:
                    for c, v in zip(cols, (shard[i][0], s, n, docs[i][s : s + n].tobytes(), len(docs[i]), (part << 32) + made, at), strict=True):
                        cols[c].append(v)
                    at += n
                made += 1
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
            return pa.RecordBatch.from_pydict({c: pa.array(v, k) for (c, v), k in zip(cols.items(), kinds, strict=True)})

        for batch in batches:
            for i, t in zip(batch.column("_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                pending.append((i, np.frombuffer(t, np.uint32)))
                if len(pending) >= 2 * shard_docs:
                    yield flush(pending[:shard_docs])
                    pending = pending[shard_docs:]
        if pending:
            yield flush(pending)

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    window: int = WINDOW,
    shard_docs: int = SHARD_DOCS,
    task_bytes: int = TASK_BYTES,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    A document is the ids of its whole text, added tokens of the vocabulary's file as one id each, then id 0 (null and empty
    texts: that id alone). A very long text fills sequences of its own; other columns are ignored, whatever their names. Every id is in
    one piece; a sequence holds at most ``window`` ids, all but the last of an index shard exactly that
    many. Documents are spread by language, then by a hash of the text, so that an index shard (about
    ``shard_docs`` documents) holds texts of one language, and equal texts meet unless they are very many.
    Repeated rows are documents of their own; null ids are kept; an empty table gives none.

    Weights of terms follow the counts of the whole table; neighbours come from the seed's own shard only.

    Scale: the ids are written, counted by term and shuffled once, by range, into tasks of about ``task_bytes``; the row number is part
    of the range key, so no language and no group of copies makes a task larger. A task holds the ids of at
    most two index shards at a time. ``vocabulary`` is the path of a tokenizers file every executor has.
    """
    total = docs.agg(F.sum(F.octet_length(text_of(text_col)))).first()[0] or 0
    lang = F.coalesce(F.crc32(F.col(lang_col).cast("string")), F.lit(-1)).cast("long") if lang_col else F.lit(0).cast("long")
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        text_of(text_col).alias("text"),
        lang.alias("_lang"),
        F.xxhash64(text_of(text_col)).alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )
    ids = written(rows.mapInArrow(_encoded(vocabulary), "_id long, _lang long, _hash long, _row long, ids binary"), "packing-ids")
    spread = ids.repartitionByRange(max(1, -(-total // task_bytes)), "_lang", "_hash", "_row")
    spread = spread.sortWithinPartitions("_lang", "_hash", "_row").select("_id", "ids")
    out = spread.mapInArrow(_packer(window, shard_docs, statistics(ids)), SCHEMA)
    return out.withColumnRenamed("doc_id", id_col)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
