import itertools

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import ngram_join
from ledgerlake.llm.components import components
from ledgerlake.llm.ngram_join import jaccard_classes, keep_one, prefix_length

from .helpers import LOWER, empty, hostile, prose, stable, words


def shingles(text):
    w = words((text or "").translate(LOWER))
    return set(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else {tuple(w)} if w else set()


def expected(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("rounds, tile", [(1, 4), (2, 512)])
def test_components_against_all_pairs(spark, tmp_dir, monkeypatch, rounds, tile):
    monkeypatch.setattr(ngram_join, "HUB_ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "TILE", tile)
    rows, df = hostile(spark)
    got = jaccard_classes(stable(df, tmp_dir)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_chains_of_near_copies_of_different_hubs(spark, tmp_dir):
    """Links only between neighbours of a chain: components reach further than any one hub."""
    import random

    rng = random.Random(4)
    w = prose(rng, 200, 100000).split()
    rows = []
    for i in range(12):
        w = w[10:] + prose(rng, 10, 100000).split()
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_classes(stable(df, tmp_dir)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_tile_gives_no_more_rows_than_documents():
    """Near copies that all may be linked with each other: neither their pairs nor more links than join them leave the tile."""
    rng = np.random.default_rng(6)
    base = rng.integers(1, 2**63, 300)
    sets = [np.unique(np.r_[base[rng.random(300) < 0.93], rng.integers(1, 2**63, 4)]) for _ in range(120)]
    n = [len(s) for s in sets]
    tile = {"tile": [7] * 120, "_row": list(range(120)), "n": n, "comp": list(range(120)), "above": [False] * 120, "side": [0] * 120}
    tile |= {"tokens": pa.array([base[:3]] * 120), "sig": [ngram_join.bitmap(s.view(np.uint64)) for s in sets], "items": pa.array(sets)}
    batch = pa.RecordBatch.from_pydict(tile)
    out = pa.Table.from_batches(ngram_join._tile(iter([batch.drop_columns(["items"])])))
    assert 0 < len(out) <= 120
    assert set(out.column("a").to_pylist()) == set(out.column("b").to_pylist())

    root = list(range(120))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def classes(pairs):
        root[:] = range(120)
        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(x) for x in range(120)]

    true = [(a, b) for a, b in itertools.combinations(range(120), 2) if ngram_join.linked(sets[a], sets[b])]
    links = [(r["a"], r["b"]) for b in ngram_join._tile_sets(iter([batch])) for r in b.to_pylist()]
    assert len(links) < 120 < len(true)
    assert set(links) <= set(true)
    assert classes(links) == classes(true)


def test_one_of_each_component_stays(spark, tmp_dir):
    rows, df = hostile(spark)
    kept = keep_one(stable(df, tmp_dir))
    assert kept.columns == df.columns
    want = {c for _, _, c in expected(rows)} - {None}
    assert {r["doc_id"] for r in kept.collect()} - {None} >= want
    blank = sum(not shingles(r[1]) for r in rows)
    sets = {c for i, n, c in expected(rows) if n and c is not None}
    alone = [i for i, n, c in expected(rows) if n and c is None]
    assert kept.count() == len(sets) + len(alone) + blank


def test_prefix_bound():
    for n in range(1, 300):
        for m in range(n, n * 100 // 80 + 1):
            least = -(-80 * (n + m) // 180)  # of a linked pair's intersection
            if least <= n:
                assert prefix_length(n) >= n - least + 1
                assert prefix_length(m) >= m - least + 1


def test_bitmap_bound_never_excludes():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 3000)).astype(np.uint64))
        b = np.unique(np.r_[a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64)])
        x, y = (np.frombuffer(ngram_join.bitmap(s), np.uint64) for s in (a, b))
        w = min(len(x), len(y))
        far = int(np.bitwise_count(ngram_join.folded(x, w) ^ ngram_join.folded(y, w)).sum())
        assert (len(a) + len(b) - far) / 2 >= len(np.intersect1d(a, b))


def test_components_of_random_graphs(spark):
    import random

    rng = random.Random(9)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_empty_table(spark, tmp_dir):
    assert jaccard_classes(stable(empty(spark), tmp_dir)).count() == 0
    assert keep_one(stable(empty(spark), tmp_dir, "e")).count() == 0
