import pytest

from ledgerlake import schemas as S
from ledgerlake.operators.quality import QualityGateError, enforce, quality_report, require_not_empty
from tests.helpers import invoice, silver_df


def _report(spark, invoices, expected=None):
    df = silver_df(spark, invoices)
    return quality_report(df, "id_nfe", S.REQUIRED_FIELDS, S.POSITIVE_FIELDS, S.NON_NEGATIVE_FIELDS, expected)


def test_clean_layer_passes(spark):
    rows = enforce(_report(spark, [invoice(id_nfe="a"), invoice(id_nfe="b")], 2))
    assert {r["check"] for r in rows} == {"row_count", "duplicate_keys", "invalid_values", "null_amounts", "null_required"}


def test_each_check_fails(spark):
    bad = [
        invoice(id_nfe="a"),
        invoice(id_nfe="a"),
        invoice(id_nfe="b", valor_total_nf="-1"),
        invoice(id_nfe="c", valor_desconto=None),
        invoice(id_nfe=None, cnpj_emitente=None),
    ]
    got = {r.check: (r.observed, r.expected, r.passed) for r in _report(spark, bad, 100).collect()}
    assert got["row_count"] == (5, 100, False)
    assert got["duplicate_keys"] == (1, 0, False)
    assert got["invalid_values"] == (1, 0, False)  # NULL discount is not an invalid value ...
    assert got["null_amounts"] == (1, 0, False)  # ... it is counted here
    assert got["null_required"] == (1, 0, False)
    with pytest.raises(QualityGateError) as e:
        enforce(_report(spark, bad, 100))
    assert len(e.value.failures) == 5


def test_expected_from_a_dataframe(spark):
    exp = spark.createDataFrame([(3,)], "expected long")
    got = {r.check: r.passed for r in _report(spark, [invoice(id_nfe="a")], exp).collect()}
    assert got["row_count"] is False


def test_empty_source_fails(spark):
    with pytest.raises(QualityGateError):
        require_not_empty(spark.createDataFrame([], "x int"), "topic")
    require_not_empty(spark.range(1), "topic")
