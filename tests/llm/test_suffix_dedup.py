import hashlib
import random

import pytest

from ledgerlake.llm.suffix_dedup import repeated, suffix_dedup, suffix_order

from .helpers import empty, hostile, prose, stable


def expected(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for j in range(len(t) - length + 1):
            seen.setdefault(t[j : j + length], []).append((i, j))
    gone = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, j in places:
                gone[i][j : j + length] = b"\x01" * length
    out = []
    for t, g in zip(texts, gone, strict=True):
        kept = bytes(b for b, x in zip(t, g, strict=True) if not x)
        out.append((len(t), sum(g), len([x for x in bytes(g).split(b"\x00") if x]), hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, tmp_dir, df, rows, **options):
    got = suffix_dedup(stable(df, tmp_dir), **options).collect()
    want = expected([(r[1] or "").encode() for r in rows], options["length"])
    mine = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got), key=repr)
    assert mine == sorted(((r[0], *w) for r, w in zip(rows, want, strict=True)), key=repr)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


@pytest.mark.parametrize("contexts", [2, 512])
def test_hostile_rows_against_brute_force(spark, tmp_dir, contexts):
    rows, df = hostile(spark)
    check(spark, tmp_dir, df, rows, length=60, gram=33, contexts=contexts)


@pytest.mark.parametrize("contexts", [3, 512])
def test_shared_passages_edits_and_periods(spark, tmp_dir, contexts):
    rng = random.Random(3)
    passage, rows = prose(rng, 60, 10**6), []
    for i in range(40):
        rows.append((i, f"{prose(rng, 20, 10**6)} {passage[rng.randrange(80):]} {prose(rng, 5, 50)}"))
    rows += [(50, "ab" * 300), (51, "x" * 500), (52, "xyz " * 90 + passage), (53, passage), (54, passage[:99]), (55, "é" * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(spark, tmp_dir, df, rows, length=100, gram=56, contexts=contexts)


def test_orders_and_classes_of_random_strings():
    rng = random.Random(1)
    for _ in range(400):
        alphabet = rng.choice([b"a", b"ab", b"abc", bytes(range(97, 105))])
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 6))]
        text, ends, n = b"".join(strings), [], rng.randrange(1, 7)
        for s in strings:
            ends.append((ends[-1] if ends else 0) + len(s))
        keep = [max(e - n + 1, e - len(s)) for e, s in zip(ends, strings, strict=True)]
        order = suffix_order(text, ends, keep)
        suffixes = [text[p : next(e for e in ends if e > p)] for p in order]
        assert suffixes == sorted(suffixes) and len(set(order)) == len(order)
        want, got = {}, {}
        for i, s in enumerate(strings):
            for j in range(len(s) - n + 1):
                want.setdefault(s[j : j + n], set()).add((i, j))
        for i, j, c in zip(*repeated(strings, n), strict=True):
            got.setdefault(int(c), set()).add((int(i), int(j)))
        assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_empty_table(spark, tmp_dir):
    assert suffix_dedup(stable(empty(spark), tmp_dir)).count() == 0
