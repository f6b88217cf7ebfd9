import json
import os

import pytest

from ledgerlake.plans.bronze import bronze_rows
from ledgerlake.sinks import messages as M
from ledgerlake.sinks.writers import register_tables, save_result, write_bronze, write_observed, write_silver
from ledgerlake.sources import messages as SM
from ledgerlake.sources.layers import read_bronze, read_silver
from ledgerlake.streaming.incremental import run_incremental_silver
from tests.helpers import bronze_df, invoice, records_df


def test_message_frame_keys_and_values(spark):
    recs = records_df(spark, [invoice(id_nfe="NFe9", nome_emitente="Ação"), invoice(id_nfe=None)])
    rows = M.message_frame(recs).collect()
    assert rows[0].key == b"NFe9" and rows[1].key == b""
    body = json.loads(rows[0].value.decode("utf-8"))
    assert body["nome_emitente"] == "Ação" and "cnpj_destinatario" in body and body["cnpj_destinatario"] is None


def test_kafka_options():
    assert SM.topic_options("b:1", "t") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest", "endingOffsets": "latest"}
    assert M.publication_options("b:1", "t")["kafka.acks"] == "all"


def test_kafka_missing_connector_is_reported(spark):
    for reader in (SM.read_topic, SM.read_topic_stream):
        try:
            reader(spark, "localhost:1", "t")
        except RuntimeError as e:
            assert "connector" in str(e)
        except Exception:  # noqa: BLE001  (connector present but no broker)
            pass


def test_bronze_projection_and_json_round_trip(spark, tmp_dir):
    msgs = spark.createDataFrame(
        [(b"k", json.dumps(invoice()).encode(), "t", 0, 5, None, 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int",
    )
    b = bronze_rows(msgs)
    assert b.columns == ["payload", "partition", "offset", "timestamp"]
    path = os.path.join(tmp_dir, "bronze")
    assert write_bronze(b, path) == 1
    back = read_bronze(spark, path).first()
    assert json.loads(back.payload)["id_nfe"] == "NFe1" and back.offset == 5


def test_empty_bronze_folder_reads_as_zero_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty")
    write_bronze(bronze_df(spark, []), path)
    assert read_bronze(spark, path).count() == 0


def test_parquet_catalog_and_csv(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    p = os.path.join(tmp_dir, "t")
    assert write_silver(df, p) == 2 and read_silver(spark, p).count() == 2
    register_tables(spark, "test_db", {"t": p}, database_location=os.path.join(tmp_dir, "db"))
    assert spark.table("test_db.t").count() == 2
    spark.sql("DROP TABLE test_db.t")
    assert read_silver(spark, p).count() == 2  # dropping the table keeps the data
    assert save_result(df, os.path.join(tmp_dir, "csv")) == 2
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "csv")).count() == 2
    assert write_observed(df.filter("x > 1"), os.path.join(tmp_dir, "o"), "json") == 1
    from ledgerlake.sinks.writers import save_result_table

    spark.sql(f"CREATE DATABASE IF NOT EXISTS results_db LOCATION '{os.path.join(tmp_dir, 'rdb')}'")
    assert save_result_table(df, "results_db.q") == 2 and spark.table("results_db.q").count() == 2


def test_incremental_clean_layer_continues_where_it_stopped(spark, tmp_dir):
    bronze_dir, out = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    write_bronze(bronze_df(spark, [invoice(id_nfe="a"), invoice(id_nfe="a"), invoice(id_nfe="x", valor_total_nf="0")]),
                 bronze_dir + "/run1")
    run_incremental_silver(spark, bronze_dir + "/*", out, out + "_ck")
    assert sorted(r.id_nfe for r in read_silver(spark, out).collect()) == ["a"]
    write_bronze(bronze_df(spark, [invoice(id_nfe="a"), invoice(id_nfe="b")]), bronze_dir + "/run2")
    run_incremental_silver(spark, bronze_dir + "/*", out, out + "_ck")
    assert sorted(r.id_nfe for r in read_silver(spark, out).collect()) == ["a", "b"]


def test_incremental_layer_keeps_one_row_per_id_for_ever(spark, tmp_dir):
    import datetime as dt

    from ledgerlake import schemas as S
    from ledgerlake.plans.silver import clean
    from ledgerlake.sources.layers import read_bronze

    bronze_dir, out = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    runs = [  # the same invoices again and again, days apart; then a changed copy, then an old one arriving late
        (day(0), [invoice(id_nfe=i) for i in "abc"]),
        (day(5), [invoice(id_nfe=i) for i in "abc"]),
        (day(30), [invoice(id_nfe="a", valor_total_nf="77.00"), invoice(id_nfe="d")]),
        (day(2), [invoice(id_nfe="a", valor_total_nf="55.00"), invoice(id_nfe="b", valor_total_nf="0")]),
    ]
    for k, (when, payloads) in enumerate(runs):
        rows = [(json.dumps(p), 0, 100 * k + n, when) for n, p in enumerate(payloads)]
        write_bronze(spark.createDataFrame(rows, S.BRONZE), f"{bronze_dir}/run{k}")
        run_incremental_silver(spark, bronze_dir + "/*", out, out + "_ck")
        batch = clean(read_bronze(spark, bronze_dir + "/*")).silver
        assert sorted(map(repr, read_silver(spark, out, batch.schema).collect())) == sorted(map(repr, batch.collect()))
    assert {r.id_nfe: r.valor_total_nf for r in read_silver(spark, out).collect()}["a"] == 77.0


def test_incremental_hot_id_is_spread_before_the_id_dedupe(spark, tmp_dir):
    bronze_dir, out = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    payloads = [invoice(id_nfe="hot")] * 90 + [invoice(id_nfe=f"c{i}") for i in range(10)]
    write_bronze(bronze_df(spark, payloads).repartition(4), bronze_dir)
    run_incremental_silver(spark, bronze_dir, out, out + "_ck")
    got = sorted(r.id_nfe for r in read_silver(spark, out).collect())
    assert got == sorted(["hot"] + [f"c{i}" for i in range(10)])


def test_incremental_backfill_is_not_dropped_as_late(spark, tmp_dir):
    import datetime as dt

    from ledgerlake import schemas as S

    bronze_dir, out = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")

    def land(run, when, ids):
        rows = [(json.dumps(invoice(id_nfe=i)), 0, n, when) for n, i in enumerate(ids)]
        write_bronze(spark.createDataFrame(rows, S.BRONZE), f"{bronze_dir}/run{run}")

    land(1, dt.datetime(2024, 3, 1), ["a", "b", "a"])
    run_incremental_silver(spark, bronze_dir + "/*", out, out + "_ck")
    land(2, dt.datetime(2024, 1, 1), ["c", "a"])  # published two months before the newest message seen
    run_incremental_silver(spark, bronze_dir + "/*", out, out + "_ck")
    assert sorted(r.id_nfe for r in read_silver(spark, out).collect()) == ["a", "b", "c"]


def test_raw_layer_as_text_table(spark, tmp_dir):
    from ledgerlake.sinks.writers import register_raw_text_table

    path = os.path.join(tmp_dir, "bronze")
    write_bronze(bronze_df(spark, [invoice(id_nfe="a"), invoice(id_nfe="b")]), path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS raw_db LOCATION '{os.path.join(tmp_dir, 'rawdb')}'")
    register_raw_text_table(spark, "raw_db", "nfe", path)
    rows = spark.sql("SELECT get_json_object(payload, '$.payload') AS p FROM raw_db.nfe").collect()
    assert len(rows) == 2
    ids = sorted(json.loads(r.p)["id_nfe"] for r in rows)
    assert ids == ["a", "b"]
