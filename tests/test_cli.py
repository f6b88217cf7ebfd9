import json
import os

from ledgerlake.cli import main
from ledgerlake.sources.layers import read_silver
from tests.test_xml import FULL, NS


def _write(d, name, text):
    with open(os.path.join(d, name), "w") as fh:
        fh.write(text)


def test_all_stages_over_documents(spark, tmp_dir, capsys):
    xml = os.path.join(tmp_dir, "xml")
    os.makedirs(xml)
    for i in range(5):
        doc = FULL.replace('Id="NFe35"', f'Id="NFe{i}"').replace("<vDesc></vDesc>", "<vDesc>0.00</vDesc>")
        _write(xml, f"nfe_{i:03d}.xml", doc)
    _write(xml, "nfe_900.xml", FULL[:300])  # damaged
    _write(xml, "nfe_901.xml", f'<nfeProc xmlns="{NS}"><protNFe/></nfeProc>')  # no body
    base = os.path.join(tmp_dir, "run")
    assert main(["run", "--xml-dir", xml, "--base", base, "--expected", "5"], spark=spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["ingest"] == {"published": 5, "errors": 2}
    assert out["silver"]["output"] == 5 and out["gold"]["fato_vendas"] == 5
    assert out["questions"]["sales_by_state"] == 1
    rows = spark.read.option("header", True).csv(os.path.join(base, "results", "sales_by_state")).collect()
    assert rows[0].uf == "SP" and rows[0].quantidade_nfe == "5" and rows[0].faturamento_total == "75.0"

    # a second ingest run republishes the same documents: the clean layer still has one row per invoice
    msgs = os.path.join(base, "messages")
    assert main(["ingest", "--xml-dir", xml, "--message-dir", msgs], spark=spark) == 0
    assert main(["bronze", "--message-dir", msgs, "--bronze", base + "/bronze2"], spark=spark) == 0
    assert main(["silver", "--bronze", base + "/bronze2", "--silver", base + "/silver2"], spark=spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["input"] == 10 and out["duplicate"] == 5 and out["output"] == 5

    # the gate stops the run
    assert main(["validate", "--silver", base + "/silver2", "--expected", "100"], spark=spark) == 1
    assert main(["check-source", "--message-dir", msgs], spark=spark) == 0
    empty = os.path.join(tmp_dir, "empty_topic")
    spark.read.parquet(msgs).limit(0).write.parquet(empty)
    assert main(["check-source", "--message-dir", empty], spark=spark) == 1


def test_sql_over_the_lake(spark, tmp_dir, capsys):
    xml = os.path.join(tmp_dir, "xml")
    os.makedirs(xml)
    for i, uf in enumerate(["SP", "SP", "RJ"]):
        doc = (FULL.replace('Id="NFe35"', f'Id="NFe{i}"').replace("<vDesc></vDesc>", "<vDesc>0.00</vDesc>")
               .replace("<UF>SP</UF>", f"<UF>{uf}</UF>"))
        _write(xml, f"nfe_{i}.xml", doc)
    base = os.path.join(tmp_dir, "lake")
    assert main(["run", "--xml-dir", xml, "--base", base], spark=spark) == 0
    q = os.path.join(tmp_dir, "q.sql")
    _write(tmp_dir, "q.sql", """
        SELECT l.uf, l.regiao, COUNT(f.id_nfe) AS quantidade_nfe, ROUND(SUM(f.valor_total), 2) AS faturamento_total
        FROM gold.fato_vendas f JOIN gold.dim_localidade l ON f.id_localidade = l.id_localidade
        GROUP BY l.uf, l.regiao ORDER BY faturamento_total DESC;""")
    capsys.readouterr()
    assert main(["sql", "--base", base, "--file", q], spark=spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"] == [
        {"uf": "SP", "regiao": "Sudeste", "quantidade_nfe": 2, "faturamento_total": 30.0},
        {"uf": "RJ", "regiao": "Sudeste", "quantidade_nfe": 1, "faturamento_total": 15.0},
    ]
    _write(tmp_dir, "raw.sql", "SELECT COUNT(*) AS n FROM bronze.nfe")
    assert main(["sql", "--base", base, "--file", os.path.join(tmp_dir, "raw.sql")], spark=spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"] == [{"n": 3}]


def test_gold_and_questions_stages(spark, tmp_dir, capsys):
    xml = os.path.join(tmp_dir, "xml")
    os.makedirs(xml)
    stamps = ["2021-01-29T09:00:00-03:00", "2021-01-29T15:00:00-03:00", "2021-02-01T10:00:00-03:00"]
    for i, at in enumerate(stamps):
        doc = (FULL.replace('Id="NFe35"', f'Id="NFe{i}"').replace("<vDesc></vDesc>", "<vDesc>0.00</vDesc>")
               .replace("2021-01-29T10:32:11-03:00", at))
        _write(xml, f"nfe_{i}.xml", doc)
    base = os.path.join(tmp_dir, "lake")
    assert main(["ingest", "--xml-dir", xml, "--message-dir", f"{base}/messages"], spark=spark) == 0
    assert main(["bronze", "--message-dir", f"{base}/messages", "--bronze", f"{base}/bronze"], spark=spark) == 0
    assert main(["silver", "--bronze", f"{base}/bronze", "--silver", f"{base}/silver"], spark=spark) == 0
    capsys.readouterr()
    assert main(["gold", "--silver", f"{base}/silver", "--gold", f"{base}/gold", "--grain", "timestamp"], spark=spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["dim_data"] == 3 and out["fato_vendas"] == 3  # one calendar row per instant, no fan-out
    assert main(["questions", "--gold", f"{base}/gold", "--out", f"{base}/results", "--format", "parquet"], spark=spark) == 0
    monthly = spark.read.parquet(f"{base}/results/monthly_evolution").orderBy("mes").collect()
    assert [(r.ano, r.mes, r.quantidade_nfe) for r in monthly] == [(2021, 1, 2), (2021, 2, 1)]


def test_ingest_restores_session_settings(spark, tmp_dir):
    from ledgerlake.plans.ingest import ingest_documents

    xml = os.path.join(tmp_dir, "xml")
    os.makedirs(xml)
    _write(xml, "nfe_1.xml", FULL)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    out = ingest_documents(spark, xml, "t", os.path.join(tmp_dir, "m"))
    assert out == {"published": 1, "errors": 0}
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_incremental_clean_layer_from_the_message_folder(spark, tmp_dir):
    xml = os.path.join(tmp_dir, "xml")
    os.makedirs(xml)
    for i in range(3):
        doc = FULL.replace('Id="NFe35"', f'Id="NFe{i}"').replace("<vDesc></vDesc>", "<vDesc>0.00</vDesc>")
        _write(xml, f"nfe_{i}.xml", doc)
    msgs, silver = os.path.join(tmp_dir, "messages"), os.path.join(tmp_dir, "silver")
    assert main(["ingest", "--xml-dir", xml, "--message-dir", msgs], spark=spark) == 0
    assert main(["silver-stream", "--message-dir", msgs, "--silver", silver], spark=spark) == 0
    assert read_silver(spark, silver).count() == 3
    # the next scheduled ingest republishes everything: the incremental layer gains nothing
    assert main(["ingest", "--xml-dir", xml, "--message-dir", msgs], spark=spark) == 0
    plain = os.path.join(tmp_dir, "plain")
    assert main(["silver-stream", "--message-dir", msgs, "--silver", silver, "--snapshot", plain], spark=spark) == 0
    assert sorted(r.id_nfe for r in read_silver(spark, silver).collect()) == ["NFe0", "NFe1", "NFe2"]
    assert sorted(r.id_nfe for r in spark.read.parquet(plain).collect()) == ["NFe0", "NFe1", "NFe2"]


def test_sql_never_cuts_a_result(spark, tmp_dir, monkeypatch, capsys):
    from ledgerlake import cli

    monkeypatch.setattr(cli, "register_lake", lambda *a: None)
    for n, code in ((1000, 0), (1001, 2)):
        path = os.path.join(tmp_dir, f"q{n}.sql")
        with open(path, "w") as fh:
            fh.write(f"SELECT id FROM range({n})")
        assert main(["sql", "--base", tmp_dir, "--file", path], spark=spark) == code
        printed = capsys.readouterr()
        assert ("--out" in printed.err) == (code == 2) and (len(printed.out) > 1000) == (code == 0)


def test_ingest_needs_a_target(spark, tmp_dir):
    import pytest

    with pytest.raises(SystemExit):
        main(["ingest", "--xml-dir", tmp_dir], spark=spark)
