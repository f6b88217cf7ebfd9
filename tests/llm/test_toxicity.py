import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlake.llm.hashing import blocks
from ledgerlake.llm.toxicity import LIMIT, features, fit, noisy_or, op6_toxicity, train, with_toxicity, without_toxic

from .helpers import empty, hostile, prose, stable


def corpus(n, seed=0):
    """Toxic documents hold one or two bad words in one sentence; the others share all else."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sentences = [prose(rng, rng.randrange(4, 12), 300) for _ in range(rng.randrange(1, 15))]
        bad = i % 4 == 0
        if bad:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(["idiotic", "idioten", "moron", "scum"])
        rows.append((i, ". ".join(sentences) + ".", int(bad)))
    return rows


def test_learns_from_documents_and_finds_the_sentence(spark, tmp_dir):
    rows = corpus(1200)
    df = stable(spark.createDataFrame(rows, "doc_id long, text string, toxic int"), tmp_dir)
    labels = df.select("doc_id", "toxic").filter("doc_id < 900")
    model = train(df.select("doc_id", "text"), labels)
    got = with_toxicity(df, model).filter("_doc.doc_id >= 900").select("_doc.*", "_toxicity", "_sentences").collect()
    right = sum((r["_toxicity"] >= LIMIT) == bool(r["toxic"]) for r in got)
    assert right >= 0.97 * len(got)
    for r in got:
        assert 0 <= r["_toxicity"] <= 1
        if r["_toxicity"] >= LIMIT and r["toxic"]:
            raw = r["text"].encode()
            worst = max(r["_sentences"], key=lambda s: s["score"])
            assert any(w in raw[worst["start"] : worst["end"]].decode() for w in ("idiot", "moron", "scum"))


def test_features_of_blocks_are_those_of_each_text():
    texts = ["One two. Three! four", "", None, "...", "a\nb", "é ü. x", "same same"] * 3
    alone = {}
    for t in texts:
        (_, a, off), = blocks(pa.array([t], pa.string())) if t else [(0, np.empty(0, np.uint8), np.zeros(2, np.int64))]
        alone[t] = [x.tolist() for x in features(a, off)[:2]]
    for _, a, off in blocks(pa.array(texts, pa.string())):
        word, sentence, of, _, _ = features(a, off)
        for i, t in enumerate(texts):
            mine = of[sentence] == i if len(of) else np.zeros(0, bool)
            got = sentence[mine]
            assert word[mine].tolist() == alone[t][0]
            assert (got - got.min() if len(got) else got).tolist() == alone[t][1]


def test_noisy_or():
    p = np.array([0.5, 0.5, 0.1])
    assert np.allclose(noisy_or(p, np.array([0, 0, 2]), 4), [0.75, 0, 0.1, 0])


def test_fit_without_documents():
    assert fit([], np.empty(0), np.empty(0)).weights.sum() == 0


def test_hostile_rows(spark, tmp_dir):
    rows, df = hostile(spark)
    docs = stable(df, tmp_dir)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (5, 1)], "doc_id long, toxic int")
    model = train(docs, labels)
    got = with_toxicity(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        if not (r["_doc"]["text"] or "").strip():
            assert r["_toxicity"] == 0 and r["_sentences"] == []
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    scores = {repr(r["_doc"]): r["_toxicity"] for r in got}
    assert sorted(repr(r) for r in kept.collect()) == sorted(repr(r["_doc"]) for r in with_toxicity(docs, train(docs, labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))).collect() if r["_toxicity"] < LIMIT)
    assert len(scores)


def test_empty_tables(spark, tmp_dir):
    docs = stable(empty(spark), tmp_dir)
    nobody = spark.createDataFrame([], "doc_id long, toxic int")
    assert without_toxic(docs, nobody).count() == 0


def test_query_on_given_tables(spark):
    got = op6_toxicity(spark, "/root/testdata/sf0.001")
    assert got.filter("held_out <> (crc32(cast(doc_id AS string)) % 5 = 0) OR predicted <> cast(score >= 0.5 AS int)").count() == 0
