import json
import os

import pytest

from ledgerlake.operators.quality import QualityGateError
from ledgerlake.plans.layers import load_bronze, load_gold, load_silver, validate_silver
from ledgerlake.plans.star import timestamp_grain_fact_rows
from ledgerlake.sinks.writers import read_star
from tests.helpers import invoice


def _messages(spark, payloads):
    rows = [(p["id_nfe"].encode() if p.get("id_nfe") else b"", json.dumps(p).encode(), "nfe-raw", 0, i, None, 0)
            for i, p in enumerate(payloads)]
    return spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int")


def test_stages_end_to_end(spark, tmp_dir):
    payloads = [invoice(id_nfe=f"n{i}", cnpj_emitente=f"{i % 3}", data_emissao=f"2021-0{1 + i % 3}-10T10:00:00-03:00")
                for i in range(9)]
    payloads += payloads[:4] + [invoice(id_nfe="bad", valor_total_nf="x")]
    b, s, g, q = (os.path.join(tmp_dir, x) for x in ("bronze", "silver", "gold", "quarantine"))
    assert load_bronze(_messages(spark, payloads), b) == 14
    totals = load_silver(spark, b, s, q)
    assert totals["written"] == 9 and totals["duplicate"] == 4 and totals["null_required"] == 1
    assert totals["quarantined"] == 5
    assert all(r["passed"] for r in validate_silver(spark, s, 9))
    with pytest.raises(QualityGateError):
        validate_silver(spark, s, 100)
    rows = load_gold(spark, s, g)
    assert rows == {"dim_emitente": 3, "dim_data": 3, "dim_localidade": 1, "fato_vendas": 9}
    star = read_star(spark, g)
    assert star["fato_vendas"].rows == 9


def test_second_run_gives_the_same_gold(spark, tmp_dir):
    payloads = [invoice(id_nfe=f"n{i}", cnpj_emitente=f"{i % 4}") for i in range(12)]
    b, s = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    load_bronze(_messages(spark, payloads), b)
    load_silver(spark, b, s)
    load_gold(spark, s, tmp_dir + "/g1")
    load_gold(spark, s, tmp_dir + "/g2")
    for t in ["dim_emitente", "fato_vendas"]:
        a = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/g1/{t}").collect())
        c = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/g2/{t}").collect())
        assert a == c


def test_timestamp_grain_fact_rows_without_pairs(spark):
    df = spark.createDataFrame([("d1", "t1"), ("d1", "t2"), ("d1", "t2"), ("d2", "t3")], "d string, t string")
    got = {r.data: (r.notas, r.instantes, r.linhas_fato) for r in timestamp_grain_fact_rows(df, "t", "d").collect()}
    assert got == {"d1": (3, 2, 6), "d2": (1, 1, 1)}
