"""The three revenue questions over the star schema, as DataFrames and as SQL.

Plan choice by dimension size: a dimension small enough to broadcast is joined
to the fact first and the aggregate runs once, partially on the map side (one
shuffle of partial sums). A dimension too large to broadcast would make the
whole fact shuffle for the join, so the fact is first aggregated by its
foreign key -- one row per member, reduced map-side even for a member holding
a large share of the sales -- and only those rows meet the dimension. Sums are
exact decimals; means are exact half-up to the cent (see ``functions.money``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import as_double, rounded_mean, to_money
from ..operators.joins import DEFAULT_MAX_BROADCAST_ROWS, join_sized
from ..operators.keys import Keyed


def _by_members(
    fact: DataFrame, dims: list[tuple[Keyed, str, list[str]]], keys: list[str], max_broadcast_rows: int
) -> DataFrame:
    """Measures grouped by dimension attributes ``keys``.

    ``dims``: (dimension, foreign key, attributes taken from it).
    """
    all_small = all(d.rows <= max_broadcast_rows for d, _, _ in dims)
    fks = [fk for _, fk, _ in dims]
    if all_small:
        f = fact.select(*fks, "id_nfe", to_money("valor_total").alias("__v"))
        n, total, nv = F.count("id_nfe"), F.sum("__v"), F.count("__v")
    else:
        f = fact.groupBy(*fks).agg(
            F.count("id_nfe").alias("__n"), F.sum(to_money("valor_total")).alias("__sum"), F.count(to_money("valor_total")).alias("__nv")
        )
        n, total, nv = F.sum("__n"), F.sum("__sum"), F.sum("__nv")
    for dim, fk, attrs in dims:
        f = join_sized(f, dim.df.select(fk, *attrs), fk, "inner", max_broadcast_rows, dim.rows)
    g = f.groupBy(*keys).agg(n.alias("__qn"), total.alias("__t"), nv.alias("__tn"))
    return g.select(
        *keys,
        F.col("__qn").cast("long").alias("quantidade_nfe"),
        as_double("__t").alias("faturamento_total"),
        rounded_mean("__t", "__tn").alias("ticket_medio"),
    )


def sales_by_state(fact: Keyed, localidade: Keyed, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Invoices, revenue and mean ticket per state, highest revenue first."""
    out = _by_members(fact.df, [(localidade, "id_localidade", ["uf", "regiao"])], ["uf", "regiao"], max_broadcast_rows)
    return out.orderBy(F.col("faturamento_total").desc(), F.col("uf"), F.col("regiao"))


def top_emitters(
    fact: Keyed,
    emitente: Keyed,
    localidade: Keyed,
    n: int = 10,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """The ``n`` issuers with the highest revenue (ties broken by CNPJ)."""
    dims = [(emitente, "id_emitente", ["cnpj", "nome"]), (localidade, "id_localidade", ["uf"])]
    out = _by_members(fact.df, dims, ["cnpj", "nome", "uf"], max_broadcast_rows)
    return out.orderBy(F.col("faturamento_total").desc(), "cnpj", "uf", "nome").limit(n)


def monthly_evolution(fact: Keyed, data: Keyed, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Invoices, revenue and mean ticket per calendar month, in time order."""
    out = _by_members(fact.df, [(data, "id_data", ["ano", "mes"])], ["ano", "mes"], max_broadcast_rows)
    return out.orderBy("ano", "mes")


# ---- SQL forms (Spark SQL over the star tables registered as views) ----------
def _sql_mean(total: str, count: str) -> str:
    return (
        f"CAST(SIGN({total}) AS DOUBLE) * (CAST(CAST(ABS({total}) * 100 AS DECIMAL(38,0)) * 2 + {count} AS DECIMAL(38,0))"
        f" DIV CAST(NULLIF(2 * {count}, 0) AS DECIMAL(38,0))) / CAST(100 AS DOUBLE)"
    )


_SUM = "SUM(TRY_CAST(f.valor_total AS DECIMAL(18,2)))"
_MEASURES = (
    "COUNT(f.id_nfe) AS quantidade_nfe,\n"
    f"  CAST({_SUM} AS DOUBLE) AS faturamento_total,\n"
    f"  {_sql_mean(_SUM, 'COUNT(TRY_CAST(f.valor_total AS DECIMAL(18,2)))')} AS ticket_medio"
)

QUESTIONS_SQL = {
    "sales_by_state": f"""
SELECT l.uf, l.regiao,
  {_MEASURES}
FROM {{p}}fato_vendas f
JOIN {{p}}dim_localidade l ON f.id_localidade = l.id_localidade
GROUP BY l.uf, l.regiao
ORDER BY faturamento_total DESC, l.uf, l.regiao""",
    "top_emitters": f"""
SELECT e.cnpj, e.nome, l.uf,
  {_MEASURES}
FROM {{p}}fato_vendas f
JOIN {{p}}dim_emitente e ON f.id_emitente = e.id_emitente
JOIN {{p}}dim_localidade l ON f.id_localidade = l.id_localidade
GROUP BY e.cnpj, e.nome, l.uf
ORDER BY faturamento_total DESC, e.cnpj, l.uf, e.nome
LIMIT 10""",
    "monthly_evolution": f"""
SELECT d.ano, d.mes,
  {_MEASURES}
FROM {{p}}fato_vendas f
JOIN {{p}}dim_data d ON f.id_data = d.id_data
GROUP BY d.ano, d.mes
ORDER BY d.ano, d.mes""",
}


def question_sql(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    """Run one question as SQL over views ``<prefix>fato_vendas`` etc. (see ``Star.register_views``)."""
    df = spark.sql(QUESTIONS_SQL[name].format(p=prefix))
    return df.withColumn("quantidade_nfe", F.col("quantidade_nfe").cast("long"))
