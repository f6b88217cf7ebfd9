import math
import struct
from collections import Counter

import xxhash

from ledgerlake.llm.quality_rules import marked_corpus, quality_rules

from .helpers import WORD, empty, hostile, stable, words

BUCKETS = 256


def h(data, seed=42):
    return xxhash.xxh64(data, seed=seed).intdigest()


def two(a, b):
    return h(struct.pack("<Q", b), h(struct.pack("<Q", a)))


def grams(text):
    one = [h(w.encode()) for w in words(text)]
    return [x % BUCKETS for x in one + [two(a, b) for a, b in zip(one, one[1:], strict=False)]]


def counts(text):
    w = words(text)
    three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times, covered = Counter(three), set()
    for i, x in enumerate(three):
        if times[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_and_ratio_against_brute_force(spark, tmp_dir):
    rows, df = hostile(spark)
    extra = [(900, "# a | b\n# a | b\n\n# a | b\n<x> " * 9, None, None, 0, "", "", "", "", ""), (901, " ".join(f"t{i % 60}" for i in range(200)), None, None, 0, "", "", "", "", "")]
    rows = rows + extra
    docs = stable(spark.createDataFrame(rows, df.schema), tmp_dir)
    good = [r[0] for r in rows if r[0] is not None and r[0] % 3 == 0]
    trusted = spark.createDataFrame([(i,) for i in good + good[:3] + [None, 10**9]], "doc_id long")
    got = quality_rules(docs, trusted, buckets=BUCKETS, threshold=-0.05).collect()
    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(grams(r[1]))
        if r[0] in good:
            target.update(grams(r[1]))
    nr, nt = sum(raw.values()), sum(target.values())
    ratio = [math.log((target[b] + 1) / (nt + BUCKETS)) - math.log((raw[b] + 1) / (nr + BUCKETS)) for b in range(BUCKETS)]
    want = {}
    for r in rows:
        c = counts(r[1])
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        g = grams(r[1])
        score = sum(ratio[b] for b in g) / max(len(g), 1)
        want.setdefault((r[0], *c, failed), []).append(score)
    assert len(got) == len(rows)
    for r in got:
        key = (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert any(abs(r["log_ratio"] - s) < 1e-9 for s in want[key]), key
        assert r["kept"] == (not r["base_failed"] and r["log_ratio"] >= -0.05)


def test_empty_tables(spark, tmp_dir):
    nobody = spark.createDataFrame([], "doc_id long")
    assert quality_rules(stable(empty(spark), tmp_dir), nobody).count() == 0
    _, df = hostile(spark)
    assert quality_rules(stable(df, tmp_dir, "d"), nobody).filter("log_ratio IS NULL OR isnan(log_ratio)").count() == 0


def test_no_text_moves_however_many_are_trusted(spark, tmp_dir):
    """The same plan with Spark's own broadcasts off: marks come back to the texts, on several input partitions."""
    rows, df = hostile(spark)
    docs = stable(df, tmp_dir)
    trusted = spark.createDataFrame([(r[0],) for r in rows if r[0] is not None and r[0] % 2], "doc_id long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        corpus = marked_corpus(docs, trusted, "doc_id", "text")
        plan = corpus._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        got = sorted(((r["_text"], r["_t"]) for r in corpus.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == sorted(((r[1], r[0] is not None and r[0] % 2 == 1) for r in rows), key=repr)
