import uuid

from ledgerlake.plans import analytics
from ledgerlake.plans.star import build_star
from tests.helpers import invoice, silver_df

INV = [
    invoice(id_nfe="a", cnpj_emitente="1", uf_emitente="AM", valor_total_nf="100.00", data_emissao="2021-01-05T10:00:00-03:00"),
    invoice(id_nfe="b", cnpj_emitente="1", uf_emitente="AM", valor_total_nf="23.27", data_emissao="2021-01-06T10:00:00-03:00"),
    invoice(id_nfe="c", cnpj_emitente="2", uf_emitente="PE", valor_total_nf="123.27", data_emissao="2021-02-05T10:00:00-03:00"),
    invoice(id_nfe="d", cnpj_emitente="3", uf_emitente="XX", valor_total_nf="1.01", data_emissao="2020-12-05T10:00:00-03:00"),
    invoice(id_nfe="e", cnpj_emitente="4", uf_emitente="SP", valor_total_nf="1.00", data_emissao="2020-12-05T10:00:00-03:00"),
] + [
    invoice(id_nfe=f"t{i}", cnpj_emitente=f"{10 + i}", uf_emitente="RJ", valor_total_nf="50.00",
            data_emissao="2021-03-01T10:00:00-03:00") for i in range(12)
]


def _star(spark):
    return build_star(silver_df(spark, INV), num_partitions=2)


def test_sales_by_state(spark):
    s = _star(spark)
    rows = [tuple(r) for r in analytics.sales_by_state(s.fato_vendas, s.dim_localidade).collect()]
    assert rows[0] == ("RJ", "Sudeste", 12, 600.0, 50.0)
    assert ("AM", "Norte", 2, 123.27, 61.64) in rows  # 61.635 rounds half up
    assert ("XX", "Não identificado", 1, 1.01, 1.01) in rows


def test_top_emitters_tie_broken_by_cnpj(spark):
    s = _star(spark)
    rows = analytics.top_emitters(s.fato_vendas, s.dim_emitente, s.dim_localidade).collect()
    assert len(rows) == 10
    assert [r.cnpj for r in rows[:2]] == ["1", "2"]  # 123.27 each: tie -> cnpj order
    assert [r.cnpj for r in rows[2:]] == [str(10 + i) for i in range(12)][:8]


def test_monthly_evolution_in_time_order(spark):
    s = _star(spark)
    rows = [tuple(r) for r in analytics.monthly_evolution(s.fato_vendas, s.dim_data).collect()]
    assert rows == [(2020, 12, 2, 2.01, 1.01), (2021, 1, 2, 123.27, 61.64), (2021, 2, 1, 123.27, 123.27),
                    (2021, 3, 12, 600.0, 50.0)]


def test_sql_and_dataframe_forms_agree(spark):
    s = _star(spark)
    prefix = "t_" + uuid.uuid4().hex[:8] + "_"
    s.register_views(prefix)
    pairs = {
        "sales_by_state": analytics.sales_by_state(s.fato_vendas, s.dim_localidade),
        "top_emitters": analytics.top_emitters(s.fato_vendas, s.dim_emitente, s.dim_localidade),
        "monthly_evolution": analytics.monthly_evolution(s.fato_vendas, s.dim_data),
    }
    for name, df in pairs.items():
        sql = analytics.question_sql(spark, name, prefix)
        assert [tuple(r) for r in sql.collect()] == [tuple(r) for r in df.collect()], name
        assert sql.columns == df.columns


def test_plan_choice_by_dimension_size(spark):
    s = _star(spark)
    big = analytics.top_emitters(s.fato_vendas, s.dim_emitente, s.dim_localidade, max_broadcast_rows=0)
    small = analytics.top_emitters(s.fato_vendas, s.dim_emitente, s.dim_localidade)
    assert [tuple(r) for r in big.collect()] == [tuple(r) for r in small.collect()]
    plan = big._jdf.queryExecution().optimizedPlan().toString()
    # large dimension: the fact is grouped by its foreign keys below the joins
    assert plan.rfind("Aggregate [id_emitente") > plan.find("Join")
    plan = small._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [id_emitente" not in plan
