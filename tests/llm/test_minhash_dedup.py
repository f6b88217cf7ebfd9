"""Near-duplicates by tensored MinHash against all pairs of full sets."""

import random

import numpy as np
import pytest

from ledgerlake.llm import minhash_dedup as M
from ledgerlake.llm.common import table
from ledgerlake.llm.hashing import mix

from .helpers import LOWER, as_multiset, empty, hostile, prose, stable, words


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id, n, component, kept) of (doc_id, text) rows: all pairs, through an inverted index."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in index.setdefault(x, []):
                common[j] = common.get(j, 0) + 1
            index[x].append(i)
        for j, both in common.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(sets[i]), least.get(root(i)), d is not None and d == least[root(i)]) for i, (d, _) in enumerate(rows)]


def result(df):
    return [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()]


def test_against_all_pairs_of_a_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert as_multiset(result(M.op11_minhash_dedup(spark, "/root/testdata/sf0.01"))) == as_multiset(want)


def test_hostile_rows(spark, tmp_dir):
    rows, df = hostile(spark)
    assert as_multiset(result(M.near_duplicates(stable(df, tmp_dir)))) == as_multiset(brute([(r[0], r[1]) for r in rows]))


def test_empty_table(spark, tmp_dir):
    assert M.near_duplicates(stable(empty(spark), tmp_dir)).collect() == []


@pytest.mark.parametrize("tile", [2048, 8])
def test_chains_and_loose_copies_reach_the_tiles(spark, tmp_dir, monkeypatch, tile):
    """Copies that drift: neighbours link, distant ones don't, so hubs settle a part and the tiles the rest."""
    monkeypatch.setattr(M, "TILE", tile)
    rng = random.Random(5)
    texts = []
    for g in range(4):
        w = prose(rng, 150, 5000).split()
        for _ in range(25):
            w = list(w)
            for _ in range(2):
                w[rng.randrange(len(w))] = f"g{g}e{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    df = stable(spark.createDataFrame(rows, "doc_id long, text string"), tmp_dir)
    assert as_multiset(result(M.near_duplicates(df))) == as_multiset(brute(rows))


def test_half_keys_are_shared_as_often_as_the_similarity_says():
    rng = np.random.default_rng(3)
    n, trials, shared, tables = 120, 200, 0, 0
    inter = int(round(2 * n * 0.8 / 1.8))
    for _ in range(trials):
        items = mix(rng.integers(0, 2**63, 2 * n - inter).astype(np.uint64))
        k = M.half_keys(np.concatenate([np.sort(items[:n]), np.sort(items[n - inter :])]), np.array([0, n]))
        same = k[0] == k[1]
        shared += int(same.sum())
        tables += bool(same[: M.HALVES].any() and same[M.HALVES :].any())
    assert abs(shared / (trials * 2 * M.HALVES) - (inter / (2 * n - inter)) ** M.WIDTH) < 0.03
    assert tables == trials


def test_a_pair_of_a_tile_is_emitted_at_the_first_half_it_shares():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    items = np.unique(mix(rng.integers(0, 2**63, 100).astype(np.uint64)))
    halves = M.half_keys(np.concatenate([items, items]), np.array([0, len(items)])).view(np.int64)
    seen = []
    for place in range(M.HALVES):
        t = pa.table(
            {
                "tile": [1, 1], "_row": [7, 3], "n": [100, 100], "comp": [7, 3], "side": [0, 0], "place": [place] * 2,
                "halves": pa.array(halves.tolist(), pa.list_(pa.int64())), "sig": [M.bitmap(items)] * 2, "items": pa.array([items.view(np.int64).tolist()] * 2, pa.list_(pa.int64())),
            }
        )
        seen += [(place, r) for b in M._tile_pairs(t) for r in b.to_pylist()]
    assert seen == [(0, {"a": 3, "b": 7})]
