"""Importance resampling against sums in plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import resampling as R
from ledgerlake.llm.hashing import crc32_spans

from .helpers import LOWER, as_multiset, empty, hostile, stable

FEATURE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    return [zlib.crc32(w.encode()) % 10_000 for w in FEATURE.findall((text or "").translate(LOWER))]


def brute(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    out = []
    for i, (d, text) in enumerate(rows):
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, i])
    enough = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    for k, r in enumerate(enough[: 10 * len(enough) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def result(df):
    return [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()]


def targets(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def test_hostile_rows(spark, tmp_dir):
    rows, df = hostile(spark)
    wanted = ["w1 w2 w3 w1", None, "", "Idiot été 日本", "x" * 3000]
    got = result(R.resampled(stable(df, tmp_dir), targets(spark, wanted)))
    assert as_multiset(got) == as_multiset(brute([(r[0], r[1]) for r in rows], wanted))
    assert [r[4] for r in got if r[4]] and sorted(r[4] for r in got if r[4]) == list(range(1, 1 + len([r for r in got if r[4]])))


@pytest.mark.parametrize("target", [[], ["w1 w2"]])
def test_empty_tables(spark, tmp_dir, target):
    assert R.resampled(stable(empty(spark), tmp_dir), targets(spark, target)).collect() == []


def test_empty_target(spark, tmp_dir):
    rows = [(1, "a b c " * 20), (2, "d"), (3, None)]
    df = stable(spark.createDataFrame(rows, "doc_id long, text string"), tmp_dir)
    assert as_multiset(result(R.resampled(df, targets(spark, [])))) == as_multiset(brute(rows, []))


def test_ties_go_to_the_smaller_id(spark, tmp_dir):
    """Copies of one id have one score; ten documents, so one is drawn, and of its copies the first."""
    rows = [(5, "a " * 30)] * 10
    got = result(R.resampled(stable(spark.createDataFrame(rows, "doc_id long, text string"), tmp_dir), targets(spark, ["a"])))
    assert sorted(str(r[4]) for r in got) == ["1"] + ["None"] * 9


def test_planes_sum_exactly():
    """Counts beyond one plane, gains of both signs, texts without words."""
    rng = np.random.default_rng(4)
    gain = rng.integers(-9000, 9000, R.BUCKETS)
    gain[:5] = [0, 1, -1, 8999, -9000]
    bucket = np.concatenate([rng.integers(0, R.BUCKETS, 5000), np.full(70_000, 4), np.full(3, 9999)])
    at = np.array([0, 0, 2500, 75_000, 75_003, 75_003])
    want = [int(gain[bucket[a:b]].sum()) for a, b in zip(at[:-1], at[1:])]
    assert R.sums(bucket, at, R.gain_planes(gain)).tolist() == want


def test_crc_of_spans():
    data = "ab é日本 x".encode() + b"y" * 200 + b" " + bytes(range(97, 123)) * 2
    a = np.frombuffer(data, np.uint8)
    starts, ends = np.array([0, 3, 12, 0, 5]), np.array([2, 11, 213, len(data), 5])
    assert crc32_spans(a, starts, ends).tolist() == [zlib.crc32(data[i:j]) for i, j in zip(starts, ends)]
    assert crc32_spans(a, starts[:0], ends[:0]).tolist() == []
