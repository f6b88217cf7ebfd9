"""Operator 6: toxicity by multiple-instance learning, sentence scores combined by noisy-or."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import table, text_of
from ledgerlake.llm.hashing import blocks, give_back, mix, word_hashes, word_spans

BITS = 18
SAMPLE = 6000  # labelled documents of each class, at most, that the classifier is fitted on
EPOCHS = 16
RATE = 0.3
PENALTY = 1e-6
LIMIT = 0.5
STEMS = (4, 6)  # bytes of a word's beginning that are features beside the word: inflected forms share them
LEAST_DOCS = 8  # sampled documents a feature occurs in; rarer ones only tell documents apart

_GAPS = np.ones(256, bool)  # words: letters, digits, and all bytes beyond ASCII
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _GAPS[_lo:_hi] = False
_STOPS = np.zeros(256, bool)  # sentences end at . ! ? and line ends
_STOPS[[10, 13, 33, 46, 63]] = True


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def features(a: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features of the words, the sentence of each; the text of each sentence, its first and last byte), for a block.

    A word's features are hashes of itself and of its first bytes. Sentences without a word are none.
    """
    starts, ends, at = word_spans(a, off, _GAPS)
    hashes = [word_hashes(a, starts, ends)]
    hashes += [mix(word_hashes(a, starts, np.minimum(starts + k, ends)) + np.uint64(k)) for k in STEMS]
    word = (np.stack(hashes, axis=1).ravel() >> np.uint64(64 - BITS)).astype(np.int64)
    marks = _STOPS[a].astype(np.int64)
    first = off[:-1][off[:-1] < off[1:]]
    marks[first] += 1
    number = np.cumsum(marks)[starts] if len(starts) else np.empty(0, np.int64)
    new = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else np.empty(0, np.int64)
    sentence = np.cumsum(np.r_[False, number[1:] != number[:-1]]) if len(number) else number
    of = np.repeat(np.arange(len(off) - 1), np.diff(at))[new] if len(new) else new
    stop = ends[np.r_[new[1:], len(ends)] - 1] if len(new) else new
    return word, np.repeat(sentence, 1 + len(STEMS)), of, starts[new], stop


def _probabilities(model: Model, word: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    z = model.bias + np.bincount(sentence, model.weights[word], n)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(p: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """1 - product of (1 - p) over the sentences of each text; 0 without any."""
    return -np.expm1(np.bincount(of, np.log1p(-np.minimum(p, 1 - 1e-12)), n))


def fit(docs: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, batch: int = 64) -> Model:
    """Log loss of the noisy-or by Adagrad; each document is (features in order, number of them per sentence).

    With q the product of (1 - p), the slope at a sentence is p for label 0 and -p q / (1 - q) for label 1:
    the blame goes to the sentences that are likeliest already.
    """
    model = Model(np.zeros(1 << BITS), -4.0)
    slope2, bias2 = np.full(1 << BITS, 1e-3), 1e-3
    order = np.random.default_rng(7)
    seen = np.zeros(1 << BITS, np.int64)
    for word, _ in docs:
        seen[np.unique(word)] += 1
    usual = seen >= LEAST_DOCS
    for i, (word, sizes) in enumerate(docs):
        keep = usual[word]
        docs[i] = (word[keep], np.bincount(np.repeat(np.arange(len(sizes)), sizes)[keep], minlength=len(sizes)).astype(np.int32))
    toxic = np.asarray(toxic, float)
    for _ in range(epochs if len(docs) else 0):
        for ids in np.array_split(order.permutation(len(docs)), -(-len(docs) // batch)):
            some = [docs[i] for i in ids]
            counts = np.array([len(n) for _, n in some])
            base = np.r_[0, np.cumsum(counts)]
            word = np.concatenate([w for w, _ in some])
            sentence = np.repeat(np.arange(base[-1]), np.concatenate([n for _, n in some]))
            of = np.repeat(np.arange(len(some)), counts)
            p = _probabilities(model, word, sentence, base[-1])
            q = np.clip(1 - noisy_or(p, of, len(some)), 1e-9, 1 - 1e-9)
            share = np.where(toxic[ids] > 0, -q / (1 - q), 1.0) * weight[ids]
            slope = (p * share[of]) / len(ids)
            g = np.bincount(word, slope[sentence], 1 << BITS)
            touched = np.unique(word)
            g = g[touched] + PENALTY * model.weights[touched]
            slope2[touched] += g * g
            model.weights[touched] -= RATE * g / np.sqrt(slope2[touched])
            gb = float(slope.sum())
            bias2 += gb * gb
            model.bias -= RATE * gb / np.sqrt(bias2)
    return model


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, toxic = batch.column("_id").to_numpy(), batch.column("_toxic").to_numpy()
        for first, a, off in blocks(batch.column("text")):
            word, sentence, of, _, _ = features(a, off)
            n = len(off) - 1
            text = of[sentence] if len(of) else of
            cut = np.searchsorted(text, np.arange(n + 1))
            ws = [word[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
            ss = [np.bincount(sentence[x:y] - sentence[x]) if y > x else sentence[:0] for x, y in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(ids[first : first + n]),
                    "toxic": pa.array(toxic[first : first + n]),
                    "words": pa.array([w.astype(np.int32).tobytes() for w in ws], pa.binary()),
                    "sentences": pa.array([s.astype(np.int32).tobytes() for s in ss], pa.binary()),
                }
            )


def _fitted(shares: dict[int, int]):
    """The model of the gathered sample, as one row; ``shares``: labels of each class in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = list(batches)
        rows = [(i, t, b, k) for b in kept for k, (i, t) in enumerate(zip(b.column("id").to_pylist(), b.column("toxic").to_pylist(), strict=True))]
        rows.sort(key=lambda r: r[0])
        toxic = np.array([r[1] for r in rows])
        weight = np.ones(len(rows))
        for c in (0, 1):
            if (toxic == c).any():
                weight[toxic == c] = shares[c] / sum(shares.values()) * len(rows) / (toxic == c).sum()
        of = lambda b, name, k: np.frombuffer(b.column(name)[k].as_buffer(), np.int32)  # noqa: E731  (a view: the sample is held once)
        model = fit([(of(b, "words", k), of(b, "sentences", k)) for _, _, b, k in rows], toxic, weight)
        out = pa.RecordBatch.from_pydict({"weights": pa.array([model.weights.tobytes()], pa.binary()), "bias": pa.array([float(model.bias)])})
        del kept, rows, model
        give_back()
        yield out

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on up to ``sample`` labelled documents of each class, chosen by a hash of their id.

    ``labels``: id and toxic (0 or 1); null labels don't count. Documents are weighted so that the classes
    have their share of all labels. Of several rows of an id one counts. Without any label the model scores all alike,
    near 0. The sample is gathered and fitted in a task; the driver gets the weights.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("_toxic")).filter("_id IS NOT NULL AND _toxic IS NOT NULL")
    shares = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect() if r["_toxic"] in (0, 1)}
    picks = [known.filter(F.col("_toxic") == c).orderBy(F.xxhash64("_id"), "_id").limit(sample) for c in (0, 1)]
    chosen = picks[0].unionByName(picks[1]).dropDuplicates(["_id"])  # at most 2 * sample ids
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    rows = texts.mapInArrow(_sample_features, "id long, toxic int, words binary, sentences binary")
    one = rows.groupBy("id").agg(F.min(F.struct("words", "sentences", "toxic")).alias("r")).select("id", "r.toxic", "r.words", "r.sentences")
    fitted = one.repartition(1).mapInArrow(_fitted(shares), "weights binary, bias double").first()
    if fitted is None:  # no partition at all
        return fit([], np.empty(0), np.empty(0))
    return Model(np.frombuffer(fitted["weights"], np.float64), fitted["bias"])


def _score(model: Model, spans: bool):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(len(batch))
            where: list = [[] for _ in range(len(batch) if spans else 0)]
            for first, a, off in blocks(batch.column("_text")):
                word, sentence, of, begin, end = features(a, off)
                n = len(off) - 1
                p = _probabilities(model, word, sentence, len(of))
                scores[first : first + n] = noisy_or(p, of, n)
                if spans:
                    best = np.zeros(n)
                    np.maximum.at(best, of, p)
                    hot = (scores[first + of] >= LIMIT) & ((p >= LIMIT) | (p == best[of]))
                    for i in np.flatnonzero(hot):
                        where[first + of[i]].append({"start": int(begin[i] - off[of[i]]), "end": int(end[i] - off[of[i]]), "score": float(p[i])})
            out = {c: batch.column(c) for c in batch.schema.names if c != "_text"}
            out["_toxicity"] = pa.array(scores)
            if spans:
                out["_sentences"] = pa.array(where, kind)
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return run


def with_toxicity(docs: DataFrame, model: Model, text_col: str = "text", spans: bool = True, carry: list[str] | None = None) -> DataFrame:
    """_doc (the row, or its columns ``carry``), _toxicity (0 to 1) and, if asked, _sentences of each row of ``docs``.

    _sentences: byte spans and scores of the offending sentences. Null, empty and wordless texts score 0. A
    text of 0.5 or more names its sentences of 0.5 or more, and in any case its worst one. The score depends
    on the text alone; a very long text is scored whole; an empty table gives none; the row is carried as a struct, so no
    name of a column clashes. No row moves.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("_doc"), text_of(text_col).alias("_text"))
    schema = T.StructType([row.schema["_doc"], T.StructField("_toxicity", T.DoubleType())])
    if spans:
        place = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
        schema = schema.add("_sentences", T.ArrayType(place))
    return row.mapInArrow(_score(model, spans), schema)


def learned(labels: DataFrame) -> DataFrame:
    """The labels a model may learn from: those of ids whose crc32 is no multiple of 5."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, learned(labels))
    out = with_toxicity(docs, model, spans=False, carry=["doc_id"]).select("_doc.doc_id", "_toxicity")
    return out.select(
        "doc_id",
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0).alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= LIMIT).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` scoring below 0.5, whole."""
    model = train(docs, learned(labels))
    return with_toxicity(docs, model, spans=False).filter(F.col("_toxicity") < LIMIT).select("_doc.*")
