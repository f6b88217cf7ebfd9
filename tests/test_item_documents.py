"""The documents of ``xml_items`` are those of whole orders."""

import datetime as dt
import re

from ledgerlake import workloads

SCHEMA = (
    "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
    "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


def line(order, number, part, price=10.5):
    return (order, number, part, 7, 2.0, price, 0.1, 0.0, "A", "O", dt.datetime(2024, 1, 1))


def test_a_document_holds_all_items_of_its_order(spark, tmp_dir, monkeypatch):
    rows = [line(5, 2, 22), line(5, 1, 21), line(9, 1, 90, None), line(5, 10, 30), line(5, 2, 22), line(None, 1, 1), line(None, 2, None), line(6, None, 4)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_dir}/lineitem.parquet")
    seen, parse = [], workloads.parse_documents

    def spy(docs, *args, **named):
        seen.extend(docs.collect())
        return parse(docs, *args, **named)

    monkeypatch.setattr(workloads, "parse_documents", spy)
    got = workloads.q_xml_items(spark, tmp_dir).collect()
    dets = sorted((d["arquivo_origem"] or "", re.findall(r"<cProd>(\d+)</cProd>", d["value"]), d["value"].count("<det")) for d in seen)
    # lines without an order are not the lines of one order
    assert dets == [("", [], 1), ("", ["1"], 1), ("nfe_5.xml", ["21", "22", "22", "30"], 4), ("nfe_6.xml", ["4"], 1), ("nfe_9.xml", ["90"], 1)]
    of_order = [(r["numero_item"], r["codigo"], r["valor_total_item"]) for r in got if r["arquivo_origem"] == "nfe_5.xml"]
    assert of_order == [("1", "21", "10.50"), ("2", "22", "10.50"), ("2", "22", "10.50"), ("10", "30", "10.50")]
    assert len(got) == len(rows)
    assert {(r["id_nfe"], r["numero_item"], r["codigo"]) for r in got if r["arquivo_origem"] is None} == {(None, "1", "1"), (None, "2", None)}
    nine = [r for r in got if r["arquivo_origem"] == "nfe_9.xml"]
    assert [(r["id_nfe"], r["numero_item"], r["valor_total_item"], r["quantidade"]) for r in nine] == [(f"NFe{9:044d}", "1", None, "2.0000")]
