import zlib

from ledgerlake.llm.sharding import kd_shards

from .helpers import empty, hostile, prose, stable


def check_law(rows, got, shards):
    assert sorted(repr(r["doc_id"]) for r in got) == sorted(repr(r[0]) for r in rows)
    by_shard = {}
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        by_shard.setdefault(r["shard"], []).append(r)
    for some in by_shard.values():
        assert sorted(r["slot"] for r in some) == list(range(len(some)))
    return [sum(r["size"] for r in by_shard.get(s, [])) for s in range(shards)]


def test_hostile_rows(spark, tmp_dir):
    rows, df = hostile(spark)
    got = kd_shards(stable(df, tmp_dir), shards=5, rows_per_bucket=7).collect()
    check_law(rows, got, 5)
    want = sorted((len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == want
    again = kd_shards(stable(df.repartition(2), tmp_dir, "again"), shards=5).collect()
    assert sorted((repr(r["doc_id"]), r["shard"]) for r in got) == sorted((repr(r["doc_id"]), r["shard"]) for r in again)


def test_bytes_are_near_equal_and_equal_texts_together(spark, tmp_dir):
    import random

    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(5, 90)), rng.choice(["en", "de"]), "big" if i % 3 else f"s{i % 7}") for i in range(1500)]
    copies = [(2000 + i, rows[i % 40][1], "fr", f"s{i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows + copies, "doc_id long, text string, lang string, source string")
    got = kd_shards(stable(df, tmp_dir), shards=12).collect()
    sizes = check_law(rows + copies, got, 12)
    assert max(sizes) < 1.1 * sum(sizes) / 12 and min(sizes) > 0.9 * sum(sizes) / 12
    where = {}
    text = {r[0]: r[1] for r in rows + copies}
    for r in got:
        where.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_a_group_larger_than_a_shard_is_dealt_out(spark, tmp_dir):
    rows = [(i, "same text of a hot group", "en", "s") for i in range(2000)] + [(5000 + i, f"text {i} " * 3, "en", "s") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    sizes = check_law(rows, kd_shards(stable(df, tmp_dir), shards=8).collect(), 8)
    assert max(sizes) < 1.35 * sum(sizes) / 8 and min(sizes) > 0.65 * sum(sizes) / 8


def test_empty_table(spark, tmp_dir):
    assert kd_shards(stable(empty(spark), tmp_dir)).count() == 0
