"""Strict loads (S1-S4, S8), materialisation (K1-K6) and the bucketed block join."""

import io
import contextlib
import os

import pytest
from pyspark.errors import PySparkException

from chainstar.operators.sinks import create_namespaces
from chainstar.plans.marts import DAG, Marts, build, descendants
from chainstar.sources import schemas
from chainstar.sources.files import load_csv

from fixtures import RUN_TS, sources


def _write(tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_pool_csv_semantics(spark, tmp_dir):
    # CRLF lines, an empty URL (NULL), TRUE/FALSE flags, a name with a leading blank.
    p = _write(tmp_dir, "pool.csv",
               "pool_key,pool_name,pool_url,is_antpool_friend_custodian,is_antpool_friend_template\r\n"
               "northpool,North Pool,https://north.example/,TRUE,TRUE\r\n"
               "x,  Spaced,,FALSE,\r\n")
    rows = load_csv(spark, p, schemas.POOL).orderBy("pool_key").collect()
    assert rows[0].is_antpool_friend_custodian is True
    assert rows[1].pool_url is None and rows[1].is_antpool_friend_template is None
    assert rows[1].pool_name == "  Spaced"                     # trimmed later, in staging


def test_price_and_hashrate_types(spark, tmp_dir):
    p = _write(tmp_dir, "price.csv", "date,ticker,price_open,price_close,price_low,price_high\n"
                                     "2031-05-06,BTC-USD,10101.01,20202.02,9090.90,30303.03\n")
    r = load_csv(spark, p, schemas.PRICE).collect()[0]
    assert str(r.price_close) == "20202.02" and str(r.date) == "2031-05-06"
    h = _write(tmp_dir, "hashrate.csv", "date,pool_key,hashrate\n"
                                        "2031-05-06,northpool,123456789012345678901\n")
    assert str(load_csv(spark, h, schemas.HASHRATE).collect()[0].hashrate) == "123456789012345678901"


def test_block_csv_timestamp_and_failfast(spark, tmp_dir):
    good = _write(tmp_dir, "block.csv",
                  "blockheight,block_hash,prev_block_hash,timestamp,pool_key,difficulty,"
                  "reward_subsidy,reward_tx_fee_sum,tx_count\n"
                  "840000,h1,h0,2024-04-20 00:09:27,,88104191118793.0165,312500000,37626516,3050\n")
    r = load_csv(spark, good, schemas.BLOCK).collect()[0]
    assert r.pool_key is None and str(r.timestamp) == "2024-04-20 00:09:27"
    bad = _write(tmp_dir, "bad.csv", open(good).read() + "x,h2,h1,2024-04-20 00:10:00,,1,1,1,1\n")
    with pytest.raises(Exception):
        load_csv(spark, bad, schemas.BLOCK).collect()          # malformed row aborts the load


def test_not_null_contract(spark, tmp_dir):
    p = _write(tmp_dir, "nn.csv", "date,pool_key,hashrate\n2023-12-01,,5\n")
    with pytest.raises(PySparkException):
        load_csv(spark, p, schemas.HASHRATE).collect()


def test_descendants_rebuild_order():
    assert descendants(["dim.pool"]) == ["dim.pool", "fact.block", "fact.pool_stats_1d",
                                         "obt.block", "obt.pool_stats_1d"]
    assert descendants(["src.price"])[0] == "fact.price_1d"
    assert set(descendants(["src.block"])) >= {"dim.block", "fact.network_stats_1d", "obt.block"}
    assert list(DAG)[0] == "dim.date"


def test_build_tables_and_views(spark, tmp_dir):
    m = Marts(spark, sources(spark), run_ts=RUN_TS)
    expected = {n: sorted(map(tuple, m[n].collect())) for n in ("fact.network_stats_1d", "obt.block")}
    built = build(Marts(spark, sources(spark), run_ts=RUN_TS), tmp_dir)
    assert os.path.isdir(os.path.join(tmp_dir, "fact", "network_stats_1d"))
    for n, rows in expected.items():
        assert sorted(map(tuple, built[n].collect())) == rows
    assert spark.catalog.tableExists("obt__pool_stats_1d")      # OBTs as views (K2)


def test_bucketed_block_tables_join_without_shuffle(spark, tmp_dir):
    create_namespaces(spark)
    m = Marts(spark, sources(spark), run_ts=RUN_TS)
    built = build(m, tmp_dir, names=["dim.date", "dim.pool", "dim.block", "fact.block"],
                  block_buckets=4, use_catalog=True)
    fb, db = spark.table("fact.block"), spark.table("dim.block")
    with spark_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                            "spark.sql.adaptive.enabled": "false"}):
        j = fb.join(db, "block_id")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == fb.count()
    assert set(built) == {"dim.date", "dim.pool", "dim.block", "fact.block"}


@contextlib.contextmanager
def spark_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_obts_as_tables(spark, tmp_dir):
    built = build(Marts(spark, sources(spark), run_ts=RUN_TS), tmp_dir, obt_as_view=False)
    assert os.path.isdir(os.path.join(tmp_dir, "obt", "pool_stats_1d"))
    assert built["obt.pool_stats_1d"].count() == 4
