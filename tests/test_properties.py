"""Operators against brute force on random inputs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions.money import exact_sum, rounded_mean
from ledgerlake.operators.dedupe import latest_per_key
from ledgerlake.operators.keys import with_dense_key

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

maybe_int = st.one_of(st.none(), st.integers(-5, 5))
rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), maybe_int, maybe_int, st.sampled_from(["x", "y", None])),
    min_size=0,
    max_size=40,
)


def _key(v):
    return (v is not None, v if v is not None else 0)  # NULL sorts lowest


@SETTINGS
@given(rows, st.integers(1, 5))
def test_latest_per_key_matches_brute_force(spark, data, parts):
    df = spark.createDataFrame(data, "k string, o int, p int, v string").repartition(parts)
    got = sorted((tuple(r) for r in latest_per_key(df, ["k"], ["o"]).collect()), key=repr)
    best = {}
    for k, o, p, v in data:
        cand = (k, o, p, v)
        if k not in best or tuple(map(_key, cand[1:])) > tuple(map(_key, best[k][1:])):
            best[k] = cand
    assert got == sorted(best.values(), key=repr)


@SETTINGS
@given(st.lists(st.text(alphabet="abcxyz", min_size=0, max_size=4), unique=True, max_size=60), st.integers(1, 6))
def test_dense_key_is_rank_in_key_order(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "s string")
    got = {r.s: r.k for r in with_dense_key(df.repartition(parts), ["s"], "k", parts).df.collect()}
    expected = {k: i + 1 for i, k in enumerate(sorted(keys, key=lambda s: s.encode()))}
    assert got == expected


@SETTINGS
@given(st.lists(st.integers(-100_000, 100_000), min_size=1, max_size=30))
def test_rounded_mean_is_decimal_half_up(spark, cents):
    vals = [c / 100 for c in cents]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.agg(rounded_mean(exact_sum("x"), F.count("x")).alias("m")).first().m
    exact = sum(Decimal(c) for c in cents) / Decimal(100) / Decimal(len(cents))
    sign = -1 if exact < 0 else 1
    expected = float(sign * abs(exact).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    assert got == expected


amount = st.one_of(st.none(), st.sampled_from(["0", "-0.01", "0.00", "1.50", "abc", "100", "7.25"]))
payload = st.fixed_dictionaries(
    {},
    optional={
        "id_nfe": st.one_of(st.none(), st.sampled_from(["a", "b", "c", ""])),
        "cnpj_emitente": st.one_of(st.none(), st.just("1")),
        "data_emissao": st.one_of(st.none(), st.just("2021-01-01T10:00:00-03:00")),
        "valor_total_nf": amount,
        "valor_produtos": amount,
        "valor_desconto": amount,
        "nome_emitente": st.sampled_from([" x ", "y", None]),
    },
)


def _num(v):
    try:
        return float(v)
    except (TypeError, ValueError):
        return None


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(payload, max_size=25))
def test_clean_layer_matches_the_rules(spark, payloads):
    from ledgerlake.plans.silver import clean
    from tests.helpers import bronze_df

    res = clean(bronze_df(spark, payloads))
    got = {r.id_nfe: (r.valor_total_nf, r.nome_emitente) for r in res.silver.collect()}
    counts = {r.stage: r.rows for r in res.reject_counts().collect()}

    # brute force: required, then ranges, then the latest valid copy (list order = offset order)
    null_required = invalid = 0
    survivors = {}
    for p in payloads:
        total, prod, desc = _num(p.get("valor_total_nf")), _num(p.get("valor_produtos")), _num(p.get("valor_desconto"))
        if p.get("id_nfe") is None or p.get("cnpj_emitente") is None or total is None or p.get("data_emissao") is None:
            null_required += 1
        elif prod is None or desc is None or not (total > 0 and prod > 0 and desc >= 0):
            invalid += 1
        else:
            name = p.get("nome_emitente")
            survivors[p["id_nfe"]] = (total, name.strip(" ") if name is not None else None)
    assert got == survivors
    valid = len(payloads) - null_required - invalid
    assert counts == {"input": len(payloads), "null_required": null_required, "invalid_value": invalid,
                      "duplicate": valid - len(survivors), "output": len(survivors)}


invoice_row = st.tuples(
    st.sampled_from(["SP", "RJ", "AM", "XX", None]),
    st.integers(1, 30000),  # total in cents
    st.sampled_from(["2020-12-31T23:30:00-03:00", "2021-01-15T10:00:00-03:00", "2021-02-01T00:10:00-03:00"]),
    st.sampled_from(["1", "2", "3"]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(invoice_row, min_size=1, max_size=30))
def test_questions_match_brute_force(spark, rows):
    from ledgerlake.functions.lookup import REGION_BY_STATE, UNKNOWN_LABEL
    from ledgerlake.plans import analytics
    from ledgerlake.plans.star import build_star
    from tests.helpers import invoice, silver_df

    inv = [invoice(id_nfe=f"n{i}", uf_emitente=uf, valor_total_nf=f"{c / 100:.2f}", data_emissao=at, cnpj_emitente=e)
           for i, (uf, c, at, e) in enumerate(rows)]
    s = build_star(silver_df(spark, inv), num_partitions=2)

    def mean(cents):
        q = (Decimal(sum(cents)) / Decimal(len(cents))).quantize(Decimal("1"), rounding=ROUND_HALF_UP)
        return float(q) / 100

    by_state = {}
    by_month = {}
    for uf, c, at, _ in rows:
        by_state.setdefault((uf, REGION_BY_STATE.get(uf, UNKNOWN_LABEL)), []).append(c)
        by_month.setdefault((int(at[:4]), int(at[5:7])), []).append(c)  # the dates are local (-03:00)
    exp_state = {k: (len(v), sum(v) / 100, mean(v)) for k, v in by_state.items()}
    exp_month = {k: (len(v), sum(v) / 100, mean(v)) for k, v in by_month.items()}
    got_state = {(r.uf, r.regiao): (r.quantidade_nfe, r.faturamento_total, r.ticket_medio)
                 for r in analytics.sales_by_state(s.fato_vendas, s.dim_localidade).collect()}
    got_month = {(r.ano, r.mes): (r.quantidade_nfe, r.faturamento_total, r.ticket_medio)
                 for r in analytics.monthly_evolution(s.fato_vendas, s.dim_data).collect()}
    assert got_state == exp_state
    assert got_month == exp_month


xml_text = st.one_of(
    st.none(),
    st.text(alphabet=st.sampled_from(list("abcXYZ019 &<>\"'ãçéÁ#/-.")), min_size=0, max_size=12),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(xml_text, xml_text, xml_text, xml_text), min_size=1, max_size=10))
def test_xml_documents_round_trip(spark, values):
    from ledgerlake import schemas as S
    from ledgerlake.sinks.xml import invoice_document
    from ledgerlake.sources.xml import parse_documents

    rows = []
    for i, (name, town, nat, total) in enumerate(values):
        r = {c: None for c in S.INVOICE_FIELDS}
        r.update(id_nfe=f"N{i}", numero_nfe=str(i), nome_emitente=name, municipio_emitente=town,
                 natureza_operacao=nat, valor_total_nf=total, arquivo_origem=f"f{i}.xml")
        rows.append(tuple(r[c] for c in S.INVOICE_FIELDS))
    recs = spark.createDataFrame(rows, S.INVOICE)
    docs = recs.select(invoice_document().alias("value"), "arquivo_origem")
    back = {r.id_nfe: (r.nome_emitente, r.municipio_emitente, r.natureza_operacao, r.valor_total_nf)
            for r in parse_documents(docs).invoices.collect()}
    expected = {f"N{i}": tuple(v if v else None for v in vals) for i, vals in enumerate(values)}
    assert back == expected


json_text = st.one_of(st.none(), st.text(alphabet=st.sampled_from(list('ab "\\\n\t/{}[]:,çÃ€')), max_size=10))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(json_text, json_text), min_size=1, max_size=10))
def test_json_messages_round_trip(spark, values):
    from ledgerlake.functions.json import extract_text_fields, record_json

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(values)], "i int, a string, b string")
    msg = df.select("i", record_json("a", "b").alias("payload"))
    back = msg.select("i", extract_text_fields("payload", ["a", "b"]).alias("p")).select("i", "p.a", "p.b")
    assert sorted(tuple(r) for r in back.collect()) == [(i, a, b) for i, (a, b) in enumerate(values)]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(payload, min_size=1, max_size=15), st.integers(1, 3))
def test_incremental_equals_batch_for_republished_copies(spark, payloads, copies):
    import os
    import tempfile

    from ledgerlake.plans.silver import clean
    from ledgerlake.sinks.writers import write_bronze
    from ledgerlake.sources.layers import read_bronze, read_silver
    from ledgerlake.streaming.incremental import run_incremental_silver
    from tests.helpers import bronze_df

    # one invoice per id (the last payload of an id), republished ``copies`` times unchanged
    unique = list({str(p.get("id_nfe")): p for p in payloads}.values())
    d = tempfile.mkdtemp(prefix="ledgerlake-prop-")
    for run in range(copies):
        write_bronze(bronze_df(spark, unique), os.path.join(d, "bronze", f"run{run}"))
    batch_df = clean(read_bronze(spark, os.path.join(d, "bronze", "*"))).silver
    batch = sorted(map(tuple, batch_df.collect()), key=repr)
    out = os.path.join(d, "silver")
    run_incremental_silver(spark, os.path.join(d, "bronze", "*"), out, out + "_ck")
    stream = sorted(map(tuple, read_silver(spark, out, batch_df.schema).collect()), key=repr)
    assert stream == batch


gate_row = st.tuples(
    st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
    st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 2.5])),
    st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 2.5])),
    st.one_of(st.none(), st.sampled_from([-0.5, 0.0, 1.0])),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(gate_row, max_size=20))
def test_quality_report_matches_brute_force(spark, rows):
    from ledgerlake.operators.quality import quality_report

    df = spark.createDataFrame(rows, "id string, total double, prod double, disc double")
    got = {r.check: r.observed for r in quality_report(df, "id", ["id", "total"], ["total", "prod"], ["disc"]).collect()}
    distinct = len({r[0] for r in rows})  # NULL counts as one key, as dropping duplicates does
    invalid = sum(1 for _, t, p, d in rows if (t is not None and t <= 0) or (p is not None and p <= 0)
                  or (d is not None and d < 0))
    assert got == {
        "row_count": len(rows),
        "duplicate_keys": len(rows) - distinct,
        "invalid_values": invalid,
        "null_amounts": sum(1 for _, t, p, d in rows if t is None or p is None or d is None),
        "null_required": sum(1 for i, t, _, _ in rows if i is None or t is None),
    }
