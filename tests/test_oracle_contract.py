"""Every registered query vs its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from chainstar.plans import catalog

from fixtures import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver tables missing")


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.10g}"
    if isinstance(v, Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "date_id" in df.columns


def test_every_query_has_an_oracle():
    # The training-data operators have their own tests, some without SQL.
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows, scols = df.collect(), df.columns
    cur = duck.execute(E.oracle_sql()[name])
    orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(scols) == sorted(ocols)
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    oidx = {c: i for i, c in enumerate(ocols)}
    srep = sorted("|".join(_norm(r[i]) for i in order) for r in srows)
    orep = sorted("|".join(_norm(r[oidx[scols[i]]]) for i in order) for r in orows)
    assert len(srep) == len(orep)
    assert srep == orep
