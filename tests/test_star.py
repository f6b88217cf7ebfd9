import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.lookup import UNKNOWN_LABEL
from ledgerlake.plans.star import TIMESTAMP_GRAIN, build_star, dim_data, timestamp_grain_fact_rows
from tests.helpers import invoice, silver_df


def _star(spark, invoices, **kw):
    return build_star(silver_df(spark, invoices), num_partitions=3, **kw)


def test_two_invoices_on_one_date_do_not_fan_out(spark):
    inv = [
        invoice(id_nfe="a", data_emissao="2019-01-31T09:00:00-03:00"),
        invoice(id_nfe="b", data_emissao="2019-01-31T15:00:00-03:00"),
        invoice(id_nfe="c", data_emissao="2019-02-01T15:00:00-03:00"),
    ]
    s = _star(spark, inv)
    assert s.fato_vendas.rows == 3 and s.dim_data.rows == 2
    fact = s.fato_vendas.df.collect()
    assert [r.id_venda for r in sorted(fact, key=lambda r: r.id_nfe)] == [1, 2, 3]
    assert all(r.id_data is not None and r.id_emitente == 1 and r.id_localidade == 1 for r in fact)


def test_timestamp_grain_keeps_one_fact_row_per_invoice(spark):
    inv = [
        invoice(id_nfe="a", data_emissao="2019-01-31T09:00:00-03:00"),
        invoice(id_nfe="b", data_emissao="2019-01-31T15:00:00-03:00"),
    ]
    s = _star(spark, inv, grain=TIMESTAMP_GRAIN)
    assert s.dim_data.rows == 2  # two calendar rows share the date
    assert [r.data for r in s.dim_data.df.collect()] == ["2019-01-31", "2019-01-31"]
    assert s.fato_vendas.rows == 2  # resolved on the instant: no fan-out
    fact = {r.id_nfe: r.id_data for r in s.fato_vendas.df.collect()}
    assert fact == {"a": 1, "b": 2}
    # joining that dimension on the date instead would give invoices x instants rows
    measure = timestamp_grain_fact_rows(
        silver_df(spark, inv).select("data_emissao", F.substring("data_emissao", 1, 10).alias("d")), "data_emissao", "d"
    ).first()
    assert (measure.notas, measure.instantes, measure.linhas_fato) == (2, 2, 4)


def test_date_depends_on_the_zone(spark):
    inv = [invoice(id_nfe="a", data_emissao="2021-01-29T22:32:11-03:00")]
    sp = dim_data(silver_df(spark, inv), "America/Sao_Paulo", num_partitions=2).df.first()
    utc = dim_data(silver_df(spark, inv), "UTC", num_partitions=2).df.first()
    assert (sp.data, sp.dia, sp.mes, sp.ano, sp.trimestre) == ("2021-01-29", 29, 1, 2021, 1)
    assert utc.data == "2021-01-30"


def test_unknown_and_null_state_and_unparseable_date(spark):
    inv = [
        invoice(id_nfe="a", uf_emitente="XX"),
        invoice(id_nfe="b", uf_emitente=None, cnpj_emitente="2"),
        invoice(id_nfe="c", data_emissao="not a date", cnpj_emitente="3"),
    ]
    s = _star(spark, inv)
    loc = {r.uf: (r.id_localidade, r.regiao) for r in s.dim_localidade.df.collect()}
    assert loc[None] == (1, UNKNOWN_LABEL) and loc["XX"][1] == UNKNOWN_LABEL and loc["SP"][1] == "Sudeste"
    fact = {r.id_nfe: r for r in s.fato_vendas.df.collect()}
    assert fact["b"].id_localidade == 1  # NULL UF points at the NULL member
    assert fact["c"].id_data is None  # unparseable date: NULL key
    assert s.dim_data.df.filter(F.col("data").isNull()).count() == 1


def test_issuer_latest_attributes_win(spark):
    inv = [
        invoice(id_nfe="a", nome_emitente="OLD NAME", data_emissao="2020-01-01T10:00:00-03:00"),
        invoice(id_nfe="b", nome_emitente="NEW NAME", data_emissao="2021-01-01T10:00:00-03:00"),
    ]
    s = _star(spark, inv)
    assert [r.nome for r in s.dim_emitente.df.collect()] == ["NEW NAME"]


def test_keys_unique_and_resolve(spark):
    inv = [invoice(id_nfe=f"n{i:03d}", cnpj_emitente=f"{i % 7:014d}", uf_emitente=["SP", "RJ", "AM"][i % 3],
                   data_emissao=f"2020-01-{1 + i % 28:02d}T10:00:00-03:00") for i in range(60)]
    s = _star(spark, inv)
    f = s.fato_vendas.df
    assert f.count() == 60 and f.select("id_venda").distinct().count() == 60
    for dim, key in [(s.dim_emitente, "id_emitente"), (s.dim_data, "id_data"), (s.dim_localidade, "id_localidade")]:
        assert dim.df.select(key).distinct().count() == dim.rows
        assert f.join(dim.df, key, "left_anti").count() == 0
    assert s.dim_emitente.rows == 7 and s.dim_localidade.rows == 3 and s.dim_data.rows == 28


def test_fact_row_check(spark):
    from ledgerlake.plans.star import dim_emitente, dim_localidade, fato_vendas

    inv = [invoice(id_nfe="a"), invoice(id_nfe="b")]
    sil = silver_df(spark, inv)
    with pytest.raises(AssertionError):
        fato_vendas(sil, dim_emitente(sil), dim_data(sil), dim_localidade(sil), expected_rows=3)


def test_location_lookup_from_tables(spark):
    from tests.conftest import SF_SMALL

    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    region = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    lookup = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("uf"), F.col("r_name").alias("regiao"), F.initcap("n_name").alias("estado_completo"))
    inv = [invoice(id_nfe="a", uf_emitente="NATION_1"), invoice(id_nfe="b", uf_emitente="NOWHERE", cnpj_emitente="9")]
    s = _star(spark, inv, location_lookup=lookup)
    got = {r.uf: (r.regiao, r.estado_completo) for r in s.dim_localidade.df.collect()}
    assert got == {"NATION_1": ("AMERICA", "Nation_1"), "NOWHERE": (UNKNOWN_LABEL, UNKNOWN_LABEL)}
    assert s.fato_vendas.rows == 2


def test_shuffle_joins_give_the_same_star(spark):
    inv = [invoice(id_nfe=f"n{i:03d}", cnpj_emitente=f"{i % 5:014d}", uf_emitente=[None, "SP", "XX"][i % 3],
                   data_emissao=f"2020-02-{1 + i % 20:02d}T10:00:00-03:00") for i in range(40)]
    a = _star(spark, inv)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for skew_handling in ["true", "false"]:  # adaptive skew splitting, or salted joins
            spark.conf.set("spark.sql.adaptive.skewJoin.enabled", skew_handling)
            b = _star(spark, inv, max_broadcast_rows=0)
            for name in ["dim_emitente", "dim_data", "dim_localidade", "fato_vendas"]:
                assert sorted(map(tuple, a.tables()[name].collect()), key=repr) == sorted(
                    map(tuple, b.tables()[name].collect()), key=repr), (name, skew_handling)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


def test_roles_name_other_columns(spark):
    from ledgerlake.plans.star import StarRoles

    inv = [invoice(id_nfe="a", cnpj_emitente="1"), invoice(id_nfe="b", cnpj_emitente="2", uf_emitente="RJ")]
    renamed = silver_df(spark, inv).select(
        F.col("id_nfe").alias("doc"), F.col("cnpj_emitente").alias("seller"), F.col("nome_emitente").alias("seller_name"),
        F.col("uf_emitente").alias("state"), F.col("municipio_emitente").alias("town"), F.col("data_emissao").alias("at"),
        F.col("valor_total_nf").alias("total"), F.col("valor_produtos").alias("goods"), F.col("valor_desconto").alias("off"))
    roles = StarRoles("doc", "seller", "seller_name", "state", "town", "at", "total", "goods", "off")
    a = _star(spark, inv)
    b = build_star(renamed, num_partitions=3, roles=roles)
    for name in ["dim_emitente", "dim_data", "dim_localidade", "fato_vendas"]:
        assert sorted(map(tuple, a.tables()[name].collect()), key=repr) == sorted(
            map(tuple, b.tables()[name].collect()), key=repr)
