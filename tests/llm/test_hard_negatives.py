"""Hard negatives against inner products of all anchors and rows."""

import math
import random

import numpy as np
import pytest

from ledgerlake.llm import hard_negatives as H

from .helpers import as_multiset

DDL = "vec_id long, embedding array<float>, label int, _row string, rank string, planes string, anchor string, parts string"


def brute(rows):
    good = []
    for i, (d, v, label, *_) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in v]
        good.append((i, d, (label + 1) % 10 if d is not None and d % 7 == 0 else label, v))
    out = []
    for i, d, label, v in good:
        if d is None or d % 100:
            continue
        s = [(-sum(x * y for x, y in zip(v, w)), e is None, e or 0, j, e, m) for j, e, m, w in good if j != i]
        s.sort()
        for p in [x for x in s if x[5] == label][:5]:
            near = [x for x in s if x[5] != label and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]]
            out += [(d, p[4], k + 1, x[4], -p[0], -x[0]) for k, x in enumerate(near[:5])]
    return out


def result(df):
    return [tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect()]


def hostile(seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(420):
        v = [rng.gauss(0, 0.2) + (0.3 if k == i % 4 else 0) for k in range(20)]
        rows.append((i, v, rng.randrange(-1, 5)))
    for i in range(420, 460):  # ties
        rows.append((i, [0.5, 0.25] * 10, i % 3))
    rows += [(500, [0.5, 0.25] * 10, 1), (500, [0.5, 0.25] * 10, 1), rows[3], rows[3]]  # repeated, an anchor too
    rows += [(600, None, 1), (601, [1.0, None], 1), (700, [float("nan")] * 20, 2), (702, [float("inf")] * 20, 2), (703, [0.1] * 20, None)]
    rows += [(None, [0.5, 0.25] * 10, 1), (None, [0.5, 0.25] * 10, 2), (None, None, None), (800, [], 1), (801, [0.9], 0), (900, [-3.0] * 20, 1), (901, [2.0] * 23, 1)]
    rows += [(-100, [0.2] * 20, 1), (-7, [0.3] * 20, 9)]
    return [(*r, "r", "k", "p", "a", "q") for r in rows]


@pytest.mark.parametrize(("candidates", "anchors"), [(4096, 1024), (50, 2)])
def test_hostile_rows(spark, tmp_dir, monkeypatch, candidates, anchors):
    monkeypatch.setattr(H, "CANDIDATE_ROWS", candidates)
    monkeypatch.setattr(H, "ANCHOR_ROWS", anchors)
    rows = hostile()
    path = f"{tmp_dir}/v"
    spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(path)
    want = brute(rows)
    assert len(want) > 50
    assert as_multiset(result(H.hard_negatives(spark.read.parquet(path)))) == as_multiset(want)


def test_no_rows_and_no_anchors(spark, tmp_dir):
    for k, rows in enumerate(([], [(1, [0.1], 1, *"rkpaq")], [(100, [0.1], 1, *"rkpaq")], [(100, [], 1, *"rkpaq"), (2, [], 1, *"rkpaq")])):
        path = f"{tmp_dir}/v{k}"
        spark.createDataFrame(rows, DDL).write.parquet(path)
        assert H.hard_negatives(spark.read.parquet(path)).collect() == []


@pytest.mark.parametrize("most", [3, 200, 40_000, 2_000_000])
def test_scores_are_inner_products(most):
    rng = np.random.default_rng(most)
    rows, anchors = rng.integers(-most, most, (1500, 24)), rng.integers(-most, most, (70, 24))
    bits = int(most).bit_length() + 1
    planes = lambda x: np.stack([np.packbits((x >> j) & 1 == 1, axis=1, bitorder="little") for j in range(bits)], axis=1)
    p = planes(rows)
    assert (H.components(p) == rows).all()
    assert (H.scores(H.subset_sums(H.components(planes(anchors)), H._score_kind(p)), p) == anchors @ rows.T).all()


def test_least_score():
    for p in range(-30, 60):
        s = H.least_score(p)
        assert 80 * p <= 100 * s and 80 * p > 100 * (s - 1)
