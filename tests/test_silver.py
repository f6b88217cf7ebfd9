from ledgerlake.operators.cleaning import DUPLICATE, INVALID_VALUE, NULL_REQUIRED
from ledgerlake.plans.silver import REASON, clean
from tests.helpers import bronze_df, invoice


def _counts(res):
    return {r.stage: r.rows for r in res.reject_counts().collect()}


def test_rules_and_reasons(spark):
    payloads = [
        invoice(id_nfe="ok1"),
        invoice(id_nfe="ok2", valor_desconto="0"),  # discount 0 kept
        invoice(id_nfe=None),  # required id missing
        {k: v for k, v in invoice(id_nfe="nocnpj").items() if k != "cnpj_emitente"},  # key absent
        invoice(id_nfe="abc", valor_total_nf="abc"),  # failed cast -> NULL -> required
        invoice(id_nfe="zero", valor_total_nf="0"),
        invoice(id_nfe="neg", valor_produtos="-0.01"),
        invoice(id_nfe="nulldesc", valor_desconto=None),  # not required, but range rule drops NULL
        "this is not json",
        invoice(id_nfe="ok1"),  # republished identical copy
        invoice(id_nfe="", cnpj_emitente=""),  # empty strings pass the required rule
    ]
    res = clean(bronze_df(spark, payloads))
    got = {r.id_nfe for r in res.silver.collect()}
    assert got == {"ok1", "ok2", ""}
    reasons = {(r.id_nfe, r[REASON]) for r in res.tagged.collect() if r[REASON]}
    assert (None, NULL_REQUIRED) in reasons and ("nocnpj", NULL_REQUIRED) in reasons
    assert ("abc", NULL_REQUIRED) in reasons
    assert {("zero", INVALID_VALUE), ("neg", INVALID_VALUE), ("nulldesc", INVALID_VALUE)} <= reasons
    c = _counts(res)
    assert c == {"input": 11, NULL_REQUIRED: 4, INVALID_VALUE: 3, DUPLICATE: 1, "output": 3}
    assert c["input"] == c[NULL_REQUIRED] + c[INVALID_VALUE] + c[DUPLICATE] + c["output"]
    q = res.quarantine()
    assert q.count() == 8
    assert q.filter(q[REASON] == DUPLICATE).count() == 1


def test_valid_copy_survives_invalid_later_copy(spark):
    res = clean(bronze_df(spark, [invoice(id_nfe="x", valor_total_nf="10.00"), invoice(id_nfe="x", valor_total_nf="-1")]))
    rows = res.silver.collect()
    assert len(rows) == 1 and rows[0].valor_total_nf == 10.0


def test_latest_valid_copy_wins(spark):
    res = clean(bronze_df(spark, [invoice(id_nfe="x", nome_emitente="OLD"), invoice(id_nfe="x", nome_emitente="NEW")]))
    assert [r.nome_emitente for r in res.silver.collect()] == ["NEW"]


def test_trim_after_dedupe_spaces_only(spark):
    res = clean(bronze_df(spark, [invoice(nome_emitente="  A  ", municipio_emitente="\tB", uf_emitente=" SP")]))
    r = res.silver.first()
    assert r.nome_emitente == "A" and r.municipio_emitente == "\tB" and r.uf_emitente == " SP"


def test_same_result_after_repartitioning(spark):
    payloads = [invoice(id_nfe=f"id{i % 37}", nome_emitente=f"N{i}") for i in range(300)]
    b = bronze_df(spark, payloads)
    a = sorted(tuple(r) for r in clean(b.repartition(7)).silver.collect())
    c = sorted(tuple(r) for r in clean(b.coalesce(1)).silver.collect())
    assert a == c and len(a) == 37


def test_hot_key_reduced_before_shuffle(spark):
    # one id holds most rows; the plan must aggregate partially before the exchange
    payloads = [invoice(id_nfe="hot")] * 200 + [invoice(id_nfe=f"c{i}") for i in range(20)]
    res = clean(bronze_df(spark, payloads).repartition(8))
    plan = res.silver._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert res.silver.count() == 21


def test_empty_bronze(spark):
    res = clean(bronze_df(spark, []))
    assert res.silver.count() == 0
    assert _counts(res)["output"] == 0


def test_rules_are_parameters(spark):
    from ledgerlake.plans.silver import SilverRules

    rules = SilverRules(key="code", fields=["code", "qty", "name"], amounts=["qty"], required=["code"],
                        positive=["qty"], non_negative=[], trimmed=["name"])
    payloads = [{"code": "a", "qty": "2", "name": " x "}, {"code": "a", "qty": "3", "name": "y"},
                {"code": "b", "qty": "0", "name": "z"}, {"qty": "1"}]
    res = clean(bronze_df(spark, payloads), rules)
    assert [tuple(r) for r in res.silver.collect()] == [("a", 3.0, "y")]
    assert {r.stage: r.rows for r in res.reject_counts().collect()} == {
        "input": 4, NULL_REQUIRED: 1, INVALID_VALUE: 1, DUPLICATE: 1, "output": 1}


def test_amounts_that_are_no_money_are_rejected(spark):
    from ledgerlake.operators.quality import quality_report
    from ledgerlake.plans.analytics import sales_by_state
    from ledgerlake.plans.star import build_star

    bad = ["NaN", "Infinity", "-Infinity", "1e17", "1e16", "abc"]
    payloads = [invoice(id_nfe=f"b{i}", valor_total_nf=v) for i, v in enumerate(bad)]
    payloads += [invoice(id_nfe="p", valor_produtos="NaN"), invoice(id_nfe="ok", valor_total_nf="100.00")]
    res = clean(bronze_df(spark, payloads))
    assert [r.id_nfe for r in res.silver.collect()] == ["ok"]
    reasons = {r.id_nfe: r.reject_reason for r in res.quarantine().collect()}
    assert reasons == {**{f"b{i}": "invalid_value" for i in range(5)}, "b5": "null_required", "p": "invalid_value"}
    star = build_star(res.silver)
    got = sales_by_state(star.fato_vendas, star.dim_localidade).collect()
    assert [(r.quantidade_nfe, r.faturamento_total) for r in got] == [(1, 100.0)]
    hostile = spark.createDataFrame([("a", float("nan")), ("b", float("inf")), ("c", 1e17), ("d", 5.0)], "id string, v double")
    report = {r.check: r.observed for r in quality_report(hostile, "id", ["id"], ["v"], []).collect()}
    assert report["invalid_values"] == 3
