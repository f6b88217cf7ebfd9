"""The incremental layer: runs and versions, totals and rejects, copies dropped in flight, whole swaps."""

import datetime as dt
import json
import os
import random

import pandas as pd
import pytest

from ledgerlake import schemas as S
from ledgerlake.plans.silver import clean
from ledgerlake.session import path_exists, remove_path
from ledgerlake.sinks import versions as V
from ledgerlake.sinks.writers import write_bronze, write_observed, write_silver, write_star
from ledgerlake.sources.layers import read_bronze, read_silver
from ledgerlake.streaming import incremental as I
from ledgerlake.streaming import republished as R
from tests.helpers import invoice

T0 = dt.datetime(2024, 1, 1)


def land(spark, path, messages):
    """(id, total, minute): raw rows; the offset is the minute."""
    rows = [(json.dumps(invoice(id_nfe=i, valor_total_nf=t)), 0, m, T0 + dt.timedelta(minutes=m)) for i, t, m in messages]
    write_observed(spark.createDataFrame(rows, S.BRONZE).coalesce(1), path, "json")


def same(spark, bronze, layer):
    want = clean(read_bronze(spark, bronze)).silver
    return sorted(map(repr, read_silver(spark, layer, want.schema).collect())) == sorted(map(repr, want.collect()))


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_a_batch_writes_in_proportion_to_itself_and_runs_stay_few(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    land(spark, f"{raw}/run00", [(f"n{i}", "10.00", i) for i in range(4000)])
    I.run_incremental_silver(spark, f"{raw}/*", out, f"{tmp_dir}/ck")
    first = V.current(spark, out).content["runs"]
    whole = size(f"{out}/{first[0]['folder']}")
    for k in range(1, 9):
        land(spark, f"{raw}/run{k:02d}", [(f"n{(k * 7 + i) % 4010}", f"{k}.00", 4000 + 10 * k + i) for i in range(10)])
        I.run_incremental_silver(spark, f"{raw}/*", out, f"{tmp_dir}/ck")
        runs = V.current(spark, out).content["runs"]
        assert runs[0] == first[0]  # the large run is not rewritten
        assert sum(r["rows"] for r in runs[1:]) <= 10 * k
        assert size(f"{out}/{I.BATCHES}/{V.current(spark, out).number:020d}") < whole / 4
        assert len(runs) <= 5 and all(a["rows"] > b["rows"] for a, b in zip(runs, runs[1:]))
    assert same(spark, f"{raw}/*", out)


def test_a_reader_sees_the_version_it_started_with(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    land(spark, f"{raw}/run0", [("a", "1.00", 0), ("b", "1.00", 1)])
    I.run_incremental_silver(spark, f"{raw}/*", out, f"{tmp_dir}/ck")
    reader = read_silver(spark, out)
    for k in range(1, V.KEEP):
        land(spark, f"{raw}/run{k}", [("a", f"{k + 1}.00", 10 * k), ("c", "5.00", 10 * k + 1)])
        I.run_incremental_silver(spark, f"{raw}/*", out, f"{tmp_dir}/ck")
        assert {r.id_nfe: r.valor_total_nf for r in reader.collect()} == {"a": 1.0, "b": 1.0}
    assert {r.id_nfe: r.valor_total_nf for r in read_silver(spark, out).collect()} == {"a": float(V.KEEP), "b": 1.0, "c": 5.0}


def test_old_versions_go(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    for k in range(7):
        land(spark, f"{raw}/run{k}", [("a", f"{k + 1}.00", k)])
        I.run_incremental_silver(spark, f"{raw}/*", out, f"{tmp_dir}/ck")
    assert len(os.listdir(f"{out}/{V.MANIFESTS}")) <= 2 * V.KEEP  # with checksum files
    named = {r["folder"] for n in V._numbers(spark, out) for r in json.loads(V._read_text(spark, f"{out}/{V.MANIFESTS}/{n:020d}.json"))["runs"]}
    assert {f"{I.RUNS}/{n}" for n in os.listdir(f"{out}/{I.RUNS}")} <= named


@pytest.mark.parametrize("keep_for", [None, "24 hours"])
def test_totals_and_rejects_equal_the_batch_also_after_a_crash(spark, tmp_dir, monkeypatch, keep_for):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    rng = random.Random(3)
    minute = 0
    for k in range(4):
        messages = []
        for _ in range(30):
            messages.append((rng.choice(["a", "b", "c", "d", "e", None]), rng.choice(["1.00", "2.00", "0", "x"]), minute))
            minute += 1
        land(spark, f"{raw}/run{k}", messages)
        if k == 2:  # the job dies after it has written the batch, before the batch is part of the layer
            before = V.current(spark, out)

            def dies(*_):
                raise RuntimeError("lost")

            with monkeypatch.context() as m:
                m.setattr(I, "commit", dies)
                with pytest.raises(Exception, match="lost"):
                    I.run_incremental_silver(spark, f"{raw}/*", out, f"{tmp_dir}/ck", keep_for=keep_for)
            assert V.current(spark, out) == before
            assert sum(r.rows for r in I.stream_reject_counts(spark, out).filter("stage = 'input'").collect()) == 60
        I.run_incremental_silver(spark, f"{raw}/*", out, f"{tmp_dir}/ck", keep_for=keep_for)
        res = clean(read_bronze(spark, f"{raw}/*"))
        assert same(spark, f"{raw}/*", out)
        assert sorted(map(tuple, I.stream_reject_counts(spark, out).collect())) == sorted(map(tuple, res.reject_counts().collect()))
        want = res.tagged.filter("reject_reason IS NOT NULL").select("id_nfe", "offset", "reject_reason")
        got = I.read_rejects(spark, out).select("id_nfe", "_pos_offset", "reject_reason")
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    assert I.batch_totals(spark, out).count() == 4


def test_a_batch_counts_once_and_two_writers_conflict(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    land(spark, raw, [("a", "1.00", 0), ("a", "2.00", 1), ("b", "0", 2)])
    batch = I.tagged_stream(read_bronze(spark, raw))
    totals = I.merge_batch(batch, out, "q", 0)
    assert totals == {"input": 3, "null_required": 0, "invalid_value": 1, "valid": 2, "dropped": 0, "held": 0, "ids": 1}
    assert I.merge_batch(batch, out, "q", 0) is None and V.current(spark, out).number == 1
    before = V.current(spark, out)
    I.merge_batch(batch, out, "q", 1)
    with pytest.raises(V.ConflictError):
        V.commit(spark, out, {"runs": []}, before)


def test_batches_without_valid_rows_or_any(spark, tmp_dir):
    out = f"{tmp_dir}/silver"
    land(spark, f"{tmp_dir}/raw", [("a", "0", 0)])
    schema = clean(read_bronze(spark, f"{tmp_dir}/raw")).silver.schema
    I.merge_batch(I.tagged_stream(spark.createDataFrame([], S.BRONZE)), out, "q", 0)
    assert I.read_rejects(spark, out).count() == 0
    I.merge_batch(I.tagged_stream(read_bronze(spark, f"{tmp_dir}/raw")), out, "q", 1)
    assert read_silver(spark, out, schema).count() == 0 and I.read_rejects(spark, out).count() == 1
    assert {r.stage: r.rows for r in I.stream_reject_counts(spark, out).collect()} == {
        "input": 1, "null_required": 0, "invalid_value": 1, "duplicate": 0, "output": 0,
    }


def test_republished_copies_are_dropped_and_the_state_is_bounded(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/silver"
    for k in range(3):  # the same five documents each time, one of them changed in the second and back in the third
        land(spark, f"{raw}/run{k}", [(f"n{i}", "9.00" if (k, i) == (1, 2) else "1.00", 10 * k + i) for i in range(5)])
        run = I.run_incremental_silver(spark, f"{raw}/*", out, f"{tmp_dir}/ck", keep_for="24 hours")
        assert (run["input"], run["dropped"], run["ids"], run["held"]) == (5, [0, 4, 4][k], [5, 1, 1][k], 5)
        assert same(spark, f"{raw}/*", out)
    assert sum(r["rows"] for r in V.current(spark, out).content["runs"]) <= 7


def _frame(rows, seen=False):
    cols = ["id", "content", "timestamp", "partition", "offset"] + (["seen"] if seen else [])
    return pd.DataFrame(rows, columns=cols)


def test_newer_copies_against_a_dictionary():
    """Any order of arrival, contents that return, positions that repeat, ids that expire."""
    rng = random.Random(7)
    held, known = _frame([], True).astype({"seen": "int64"}), {}
    for now in range(40):
        batch = [(rng.choice("abcdef"), rng.choice("xyz"), pd.Timestamp(rng.randrange(60), unit="s"), rng.randrange(2), rng.randrange(9)) for _ in range(rng.randrange(9))]
        through, held = R.newer_copies(_frame(batch), held, now, 5)
        want = []
        for i in sorted({r[0] for r in batch}):
            last = max((r for r in batch if r[0] == i), key=lambda r: r[2:])
            old = known.get(i)
            if old is None or last[2:] > old[1]:
                if old is None or last[1] != old[0]:
                    want.append(i)
                known[i] = [last[1], last[2:], now]
            else:
                known[i][2] = now
        same_position = len({r[0:1] + r[2:] for r in batch}) < len({r[0:1] + r[2:] + r[1:2] for r in batch})
        if not same_position:
            assert sorted(through["id"]) == want
        known = {r.id: [r.content, (r.timestamp, r.partition, r.offset), r.seen] for r in held.itertuples()}
        assert all(now - v[2] < 5 for v in known.values())


def test_time_to_hold():
    assert [R.milliseconds(x) for x in ("1 second", "5 minutes", "24 hours", "2 days")] == [1000, 300_000, 86_400_000, 172_800_000]
    with pytest.raises(ValueError):
        R.milliseconds("soon")


def test_a_layer_stays_until_the_next_is_whole(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    old = spark.range(3).selectExpr("cast(id as string) AS id_nfe")
    write_silver(old, path)
    broken = spark.range(100, 104).selectExpr("if(id = 103, raise_error('dies'), cast(id as string)) AS id_nfe")
    with pytest.raises(Exception, match="dies"):
        write_silver(broken, path)
    assert sorted(r.id_nfe for r in read_silver(spark, path).collect()) == ["0", "1", "2"]
    assert write_silver(spark.range(7).selectExpr("cast(id as string) AS id_nfe"), path) == 7
    assert read_silver(spark, path).count() == 7 and not path_exists(spark, V._beside(path, "old"))


def test_a_swap_that_stops_half_way_is_read_and_finished(spark, tmp_dir):
    path = f"{tmp_dir}/bronze"
    land(spark, f"{tmp_dir}/x", [("a", "1.00", 0)])
    write_bronze(read_bronze(spark, f"{tmp_dir}/x"), path)
    V._move(spark, path, V._beside(path, "old"))  # died between the renames
    assert V.settled(spark, path) == V._beside(path, "old") and read_bronze(spark, path).count() == 1
    land(spark, f"{tmp_dir}/y", [("a", "1.00", 0), ("b", "1.00", 1)])
    assert write_bronze(read_bronze(spark, f"{tmp_dir}/y"), path) == 2
    assert V.settled(spark, path) == path and read_bronze(spark, path).count() == 2


def test_star_tables_are_swapped_after_all_are_written(spark, tmp_dir):
    good = spark.range(2)
    bad = spark.range(2).selectExpr("if(id = 1, raise_error('dies'), id) AS id")
    write_star({"dim_data": good, "fato_vendas": good}, tmp_dir)
    with pytest.raises(Exception, match="dies"):
        write_star({"dim_data": spark.range(9), "fato_vendas": bad}, tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/dim_data").count() == 2 and spark.read.parquet(f"{tmp_dir}/fato_vendas").count() == 2
    remove_path(spark, f"{tmp_dir}/dim_data")


def test_landed_publications_are_compressed(spark):
    from ledgerlake.workloads import deduplicated_stream

    raw = deduplicated_stream(spark, "/root/testdata/sf0.001").rsplit("/", 1)[0] + "/raw/*"
    files = spark.read.text(raw).select("_metadata.file_name").distinct().collect()
    assert files and all(r.file_name.endswith(".json.gz") for r in files)
