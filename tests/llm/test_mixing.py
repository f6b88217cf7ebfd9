from collections import Counter

import duckdb

from ledgerlake.llm.mixing import SQL, mix_report, mixed

from .helpers import empty, hostile, prose, stable, words


def shares(sizes):
    """Water filling by rounds, as the rule says it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(order)
    while free:
        left, w = total - sum(target.values()), sum(weight[s] for s in free)
        over = {s for s in free if 3 * sizes[s] <= left * weight[s] / w}
        if not over:
            return {**target, **{s: left * weight[s] / w for s in free}}
        target.update({s: 3 * sizes[s] for s in over})
        free -= over
    return target


def test_hostile_rows_reach_their_targets(spark, tmp_dir):
    rows, df = hostile(spark)
    got = mix_report(stable(df, tmp_dir)).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    want = shares(dict(size))
    assert sorted(round(t, 6) for t in want.values()) == sorted({round(r["target"], 6) for r in got} | {round(t, 6) for t in want.values() if not t})
    assert all(0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in got)
    longest = max(r["size"] for r in got)
    for t in {r["target"] for r in got}:
        assert abs(sum(r["taken"] for r in got if r["target"] == t) - t) <= longest
    again = mix_report(stable(df.repartition(3), tmp_dir, "again")).collect()
    assert Counter(map(repr, ((r["doc_id"], r["size"], r["target"]) for r in got))) == Counter(map(repr, ((r["doc_id"], r["size"], r["target"]) for r in again)))


def test_against_sql_and_targets_of_many_words(spark, tmp_dir):
    import random

    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randrange(1, 120)), rng.choice([None, "a", "b", "b", "b", "c", "d", "ü", "Z"])) for i in range(1500)]
    docs = stable(spark.createDataFrame(rows, "doc_id long, text string, source string"), tmp_dir)
    got = mix_report(docs).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_dir}/docs.parquet/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.sql(SQL).fetchall())
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    want = shares(dict(size))
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 60
    copies = {r["doc_id"]: r["copies"] for r in got if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed(docs).collect()) == copies


def test_sources_without_words_and_one_source(spark, tmp_dir):
    rows = [(1, "", "a"), (2, None, "a"), (3, "x y z", "b"), (4, "x y", "c")]
    got = {r["doc_id"]: r for r in mix_report(stable(spark.createDataFrame(rows, "doc_id long, text string, source string"), tmp_dir)).collect()}
    assert got[1]["target"] == 0 and got[1]["taken"] == 0 and got[2]["copies"] == 0
    one = mix_report(stable(spark.createDataFrame(rows[2:3], "doc_id long, text string, source string"), tmp_dir, "one")).collect()
    assert [(r["target"], r["taken"]) for r in one] == [(3.0, 3)]


def test_empty_table(spark, tmp_dir):
    docs = stable(empty(spark), tmp_dir)
    assert mix_report(docs).count() == 0
    assert mixed(docs).columns == docs.columns and mixed(docs).count() == 0
