from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions.dates import local_date
from ledgerlake.functions.json import extract_text_fields, record_json
from ledgerlake.functions.lookup import UNKNOWN_LABEL, map_lookup, state_attributes
from ledgerlake.functions.money import exact_sum, rounded_mean
from ledgerlake.functions.text import empty_to_null, trim_spaces


def test_rounded_mean_is_exact_half_up(spark):
    # 1.005 has no exact double; the mean of 1.00 and 1.01 is exactly 1.005 -> 1.01
    df = spark.createDataFrame([(1, 1.00), (1, 1.01), (2, 61.63), (2, 61.64), (3, -1.00), (3, -1.01)], "g int, x double")
    out = {r.g: r.m for r in df.groupBy("g").agg(rounded_mean(exact_sum("x"), F.count("x")).alias("m")).collect()}
    assert out == {1: 1.01, 2: 61.64, 3: -1.01}


def test_exact_sum_does_not_depend_on_order(spark):
    vals = [0.1, 0.2, 0.3] * 1000
    a = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").coalesce(1)
    sa = a.agg(exact_sum("x").alias("s")).first().s
    sb = b.agg(exact_sum("x").alias("s")).first().s
    assert sa == sb == Decimal("600.00")


def test_local_date_uses_the_given_zone(spark):
    df = spark.createDataFrame([("2021-01-29T22:32:11-03:00",), ("nonsense",)], "s string")
    r = df.select(
        local_date("s", "America/Sao_Paulo").alias("sp"), local_date("s", "UTC").alias("utc")
    ).collect()
    assert str(r[0].sp) == "2021-01-29" and str(r[0].utc) == "2021-01-30"
    assert r[1].sp is None and r[1].utc is None


def test_text_without_offset_keeps_its_written_date(spark):
    df = spark.createDataFrame([("2021-01-29",), ("2021-01-29T01:00:00",), ("2021-01-29T01:00:00Z",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ["UTC", "Asia/Tokyo", "America/Sao_Paulo"]:
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [str(r.d) for r in df.select(local_date("s", "America/Sao_Paulo").alias("d")).collect()]
            assert got == ["2021-01-29", "2021-01-29", "2021-01-28"], zone  # 01:00Z is 22:00 the day before in SP
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_state_lookup_default_for_unknown_null_and_padded(spark):
    df = spark.createDataFrame([("SP",), ("XX",), (None,), (" SP",), ("am",)], "uf string")
    rows = df.select("uf", *[v.alias(k) for k, v in state_attributes("uf").items()]).collect()
    got = {r.uf: (r.regiao, r.estado_completo) for r in rows}
    assert got["SP"] == ("Sudeste", "São Paulo")
    for k in ["XX", None, " SP", "am"]:
        assert got[k] == (UNKNOWN_LABEL, UNKNOWN_LABEL)


def test_map_lookup_custom_default(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [r.v for r in df.select(map_lookup("k", {"a": "A"}, "none").alias("v")).orderBy("k").collect()] == ["A", "none"]


def test_trim_only_spaces(spark):
    df = spark.createDataFrame([("  ab  ",), ("\tab\t",), ("",)], "s string")
    assert [r.t for r in df.select(trim_spaces("s").alias("t")).collect()] == ["ab", "\tab\t", ""]
    assert [r.t for r in df.select(empty_to_null("s").alias("t")).collect()][2] is None


def test_json_extract_never_raises(spark):
    rows = [
        ('{"a": "x", "b": 1.5, "c": {"d": 1}}',),
        ('{"a": null}',),
        ('{"a": "x"',),
        ("garbage",),
        ('[{"a": "x"}]',),
        (None,),
    ]
    df = spark.createDataFrame(rows, "p string")
    got = [tuple(r) for r in df.select(extract_text_fields("p", ["a", "b", "c"]).alias("s")).select("s.*").collect()]
    assert got[0] == ("x", "1.5", '{"d":1}')
    assert got[1] == (None, None, None)
    assert got[2] == (None, None, None)
    assert got[3] == (None, None, None)
    assert got[5] == (None, None, None)


def test_record_json_keeps_nulls_and_non_ascii(spark):
    df = spark.createDataFrame([("Não", None)], "a string, b string")
    assert df.select(record_json("a", "b").alias("j")).first().j == '{"a":"Não","b":null}'


def test_fixed_state_table_shape():
    from ledgerlake.functions.lookup import NAME_BY_STATE, REGION_BY_STATE, STATES

    assert len(STATES) == 27 and len(REGION_BY_STATE) == 27 and len(NAME_BY_STATE) == 27
    assert set(REGION_BY_STATE.values()) == {"Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul"}


def test_rounded_mean_of_large_groups_just_below_a_cent(spark):
    from ledgerlake.functions.money import rounded_mean
    from ledgerlake.plans.analytics import _sql_mean

    rows = [(2_000_001, "500", 1_000_000), (20_000_001, "12345", 10_000_000), (999, "7", 499)]
    values = [(n, str(int(k) * n + extra), int(k) / 100) for n, k, extra in rows]
    df = spark.createDataFrame(values, "n long, cents string, want double")
    df = df.selectExpr("n", "CAST(CAST(cents AS DECIMAL(30,0)) / 100 AS DECIMAL(34,2)) AS t", "want")
    got = df.select("want", rounded_mean("t", "n").alias("a")).collect()
    assert [r.a for r in got] == [r.want for r in got]
    df.createOrReplaceTempView("mean_boundary")
    got = spark.sql(f"SELECT want, {_sql_mean('t', 'n')} AS a FROM mean_boundary").collect()
    assert [r.a for r in got] == [r.want for r in got]
    zero = spark.createDataFrame([(0, 1.0), (3, -0.05)], "n long, x double").selectExpr("n", "CAST(x AS DECIMAL(18,2)) AS t")
    assert [r.a for r in zero.select(rounded_mean("t", "n").alias("a")).collect()] == [None, -0.02]
