import os

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlake.sources.tables import TABLE_NAMES
from ledgerlake.workloads import QUERIES
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["uf", "regiao", "quantidade_nfe", "faturamento_total", "ticket_medio"]
    assert len(rows) > 0


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # every query of the engine is checked against SQL; those of the training-data package where SQL can say it
    assert set(QUERIES) <= set(o)


_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def _norm(v):
    return repr(v) if isinstance(v, float) else v  # floats compared bit for bit


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    types = {f.name: _DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [df.columns.index(c) for c in sorted(ocols)]
    oidx = [ocols.index(c) for c in sorted(ocols)]
    got = sorted((tuple(_norm(r[i]) for i in idx) for r in df.collect()), key=repr)
    exp = sorted((tuple(_norm(r[i]) for i in oidx) for r in res.fetchall()), key=repr)
    assert got == exp


def test_bench_prints_one_json_line():
    import json
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py"), "json_roundtrip"], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout.strip().splitlines()
    line = json.loads(out[-1])
    assert set(line) >= {"metric", "value", "unit", "queries", "sf"}
    assert line["unit"] == "sec" and line["sf"] == 0.001 and "json_roundtrip" in line["queries"]
