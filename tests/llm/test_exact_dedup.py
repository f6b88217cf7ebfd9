import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerlake.llm.exact_dedup import exact_dedup, keep_first

from .helpers import empty, hostile, stable

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(SPACE.sub(" ", r[1] or ""), []).append(r[0])
    out = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        left = True
        for i in sorted(ids, key=lambda x: (x is None, x)):
            out[i, keep, len(ids), left, sha] += 1
            left = False
    return out


def test_classes_of_hostile_rows(spark, tmp_dir):
    rows, df = hostile(spark)
    got = exact_dedup(stable(df, tmp_dir)).drop("_row").collect()
    assert Counter(tuple(r) for r in got) == expected(rows)


def test_collisions_of_the_hash_are_told_apart(spark, tmp_dir):
    rows, df = hostile(spark)
    docs = stable(df, tmp_dir)
    weak = exact_dedup(docs, hash_of=lambda t: F.pmod(F.length(t), F.lit(3))).drop("_row").collect()
    assert Counter(tuple(r) for r in weak) == expected(rows)


def test_kept_rows_are_whole_and_one_of_each(spark, tmp_dir):
    rows, df = hostile(spark)
    kept = keep_first(stable(df, tmp_dir))
    assert kept.columns == df.columns
    texts = [SPACE.sub(" ", r["text"] or "") for r in kept.collect()]
    assert Counter(texts) == Counter(set(SPACE.sub(" ", r[1] or "") for r in rows))
    assert kept.filter("_row <> 'r'").count() == 0


def test_empty_table(spark, tmp_dir):
    assert exact_dedup(stable(empty(spark), tmp_dir)).count() == 0
    assert keep_first(stable(empty(spark), tmp_dir, "e")).count() == 0
