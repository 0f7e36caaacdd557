"""Every registered query against its DuckDB oracle on the smallest data set."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from vaultline.plans import catalog

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
QUERIES = dict(catalog.QUERIES)
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(v)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    o_names = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_names)
    assert len(s_rows) == len(o_rows)
    assert canon(df.columns, s_rows) == canon(o_names, o_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["installation_id", "account_meter_id", "asset_meter_id"]


def test_no_python_in_any_plan(spark):
    for name in ("stage_readings", "bv_asset_measurements", "sat_compact", "check_not_null"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan, name
