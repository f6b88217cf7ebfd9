"""Work on the raw layer that stays the size of its files, however many there are."""

import json
import os

import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from ledgerlake import schemas as S
from ledgerlake import workloads
from ledgerlake.plans import layers
from ledgerlake.plans.silver import REASON, SilverResult, clean
from ledgerlake.sources.layers import raw_reading, read_bronze


def _payload(i: int, **changes) -> str:
    row = dict.fromkeys(S.INVOICE_FIELDS, "x") | {"id_nfe": f"NFe{i}", "data_emissao": "2021-01-29T10:00:00-03:00", "valor_produtos": "10.00", "valor_desconto": "0.00", "valor_total_nf": "10.00"}
    return json.dumps(row | changes)


def _raw(spark, folder: str, files: int) -> None:
    os.makedirs(folder)
    for k in range(files):
        with open(f"{folder}/part-{k:05d}.json", "w") as f:
            f.write(json.dumps({"payload": _payload(k), "partition": 0, "offset": k, "timestamp": "2024-01-01T00:00:00.000Z"}) + "\n")


@pytest.mark.parametrize("files, cores, want", [(3, 12, 4), (17, 8, 8), (20, 12, 10), (60, 12, 12), (60, 2, 4)])
def test_a_batch_has_a_file_for_each_core(spark, tmp_dir, monkeypatch, files, cores, want):
    _raw(spark, f"{tmp_dir}/raw", files)
    monkeypatch.setattr(SparkContext, "defaultParallelism", property(lambda self: cores))
    assert workloads.files_per_batch(spark, f"{tmp_dir}/raw") == want


def test_a_task_reads_few_raw_files(spark, tmp_dir, monkeypatch):
    _raw(spark, f"{tmp_dir}/raw", 64)
    count = lambda: read_bronze(spark, f"{tmp_dir}/raw").rdd.getNumPartitions()
    usual = count()
    with raw_reading(spark):
        assert count() >= 4 * usual  # a file counts as 4 MB at least
    assert count() == usual
    seen, write = [], layers.write_silver

    def noted(silver, path):
        seen.append(silver.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
        return write(silver, path)

    monkeypatch.setattr(layers, "write_silver", noted)
    assert layers.load_silver(spark, f"{tmp_dir}/raw", f"{tmp_dir}/silver", f"{tmp_dir}/quarantine")["output"] == 64
    assert seen == ["16MB"]


def test_quarantine_needs_positions_alone(spark):
    """Copies that tie in their position, one with no position, rejects that share id and position with a survivor."""
    rows = [
        (_payload(1), 0, 1, "2024-01-01 00:00:00"), (_payload(1, serie="9"), 0, 1, "2024-01-01 00:00:00"), (_payload(1), 0, 0, "2024-01-01 00:00:00"),
        (_payload(1, valor_total_nf="-1"), 0, 1, "2024-01-01 00:00:00"), (_payload(2), None, None, None), (_payload(2, valor_total_nf="abc"), 0, 7, None),
        (_payload(3, id_nfe=None), 0, 8, None), (None, 0, 9, None),
    ]
    raw = spark.createDataFrame(rows, "payload string, partition int, offset long, timestamp string").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    res = clean(raw)
    assert res.winners.columns == ["id_nfe", *res.rules.order]
    whole = SilverResult(res.tagged, res.survivors, res.silver, res.rules)
    rows_of = lambda r: sorted(map(str, r.quarantine().select("id_nfe", "offset", REASON).collect()))
    assert rows_of(res) == rows_of(whole) and len(rows_of(res)) == 4
