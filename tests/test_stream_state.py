"""The state of the stream that drops copies: where it lies, and how it is split."""

import datetime as dt
import json
import os

from ledgerlake.plans.silver import clean
from ledgerlake.sinks.writers import write_bronze
from ledgerlake.sources.layers import read_bronze, read_silver
from ledgerlake.streaming import incremental as I
from ledgerlake.streaming import republished as R
from tests.helpers import bronze_df, invoice


def land(spark, path, k):
    rows = bronze_df(spark, [invoice(id_nfe=f"N{i}", valor_total_nf="9.00" if i == k else "1.00") for i in range(30)])
    write_bronze(rows.withColumn("timestamp", rows["timestamp"] + dt.timedelta(hours=k)), path)


def test_states_lie_outside_the_heap_in_buckets_by_the_size_of_the_files(spark, tmp_dir, monkeypatch):
    raw, out, ck = f"{tmp_dir}/raw", f"{tmp_dir}/silver", f"{tmp_dir}/ck"
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    monkeypatch.setattr(R, "BUCKETS", 3)
    monkeypatch.setattr(R, "BUCKET_BYTES", 100)
    for k in range(3):
        land(spark, f"{raw}/run{k}", k)
        run = I.run_incremental_silver(spark, f"{raw}/*", out, ck, keep_for="24 hours")
        # the second and third run change two documents each
        assert (run["input"], run["dropped"], run["held"]) == (30, [0, 28, 28][k], 30)
        assert sorted(map(repr, read_silver(spark, out).collect())) == sorted(map(repr, clean(read_bronze(spark, f"{raw}/*")).silver.collect()))
        if k == 0:  # the number is that of the first run's files, whatever comes later
            size = sum(os.path.getsize(f"{raw}/run0/{f}") for f in os.listdir(f"{raw}/run0") if f.startswith("part-") or f == "_SUCCESS")
            buckets = json.load(open(f"{ck}/buckets.json"))
            assert buckets == -(-size // 100) > 3
        assert json.load(open(f"{ck}/buckets.json")) == buckets
    settings = json.loads(open(f"{ck}/offsets/0").read().splitlines()[1])["conf"]
    assert settings["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_a_checkpoint_without_a_note_keeps_its_buckets(spark, tmp_dir):
    ck = f"{tmp_dir}/ck"
    land(spark, f"{tmp_dir}/raw", 0)
    assert R.state_buckets(spark, ck) == R.BUCKETS and not os.path.exists(ck)  # a topic: the size is not known
    os.makedirs(f"{ck}/offsets")
    assert R.state_buckets(spark, ck, f"{tmp_dir}/raw") == R.BUCKETS and not os.path.exists(f"{ck}/buckets.json")
