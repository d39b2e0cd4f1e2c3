"""Model invariants on the smallest driver tables."""

import pytest
from pyspark.sql import functions as F

from chainstar.operators.quality import duplicate_keys, orphan_keys
from chainstar.plans.catalog import RUN_TS
from chainstar.plans.marts import GRAIN, Marts
from chainstar.sources.standins import load_sources

from fixtures import SF_SMALL


@pytest.fixture(scope="module")
def marts(spark):
    return Marts(spark, load_sources(spark, SF_SMALL), run_ts=RUN_TS, strict=False)


@pytest.mark.parametrize("name", [n for n in GRAIN if n != "fact.pool_stats_1d" and n != "obt.pool_stats_1d"])
def test_grain_unique(marts, name):
    assert duplicate_keys(marts[name], GRAIN[name]).count() == 0


def test_pool_grain_only_broken_by_unknown(marts):
    dups = duplicate_keys(marts["fact.pool_stats_1d"], ["date_id", "pool_id"]).collect()
    assert dups and {r.pool_id for r in dups} == {"0"}                     # G10


def test_foreign_keys_complete(marts):
    fb = marts["fact.block"]
    assert orphan_keys(fb, marts["dim.block"], "block_id").count() == 0
    assert orphan_keys(fb, marts["dim.pool"], "pool_id").count() == 0
    assert orphan_keys(fb, marts["dim.date"], "date_id").count() == 0
    assert orphan_keys(marts["fact.pool_stats_1d"], marts["dim.pool"], "pool_id").count() == 0


def test_pool_sums_equal_network(marts):
    p = marts["fact.pool_stats_1d"].groupBy("date_id").agg(
        F.sum("block_count").alias("n"), F.sum("reward_mining_sum").alias("r"),
        F.sum("tx_count").alias("t"))
    n = marts["fact.network_stats_1d"].select("date_id", F.col("block_count").alias("n2"),
                                              F.col("reward_mining_sum").alias("r2"),
                                              F.col("tx_count").alias("t2"))
    j = p.join(n, "date_id", "full")
    assert j.filter((F.col("n") != F.col("n2")) | (F.col("r") != F.col("r2"))
                    | (F.col("t") != F.col("t2")) | F.col("n").isNull() | F.col("n2").isNull()).count() == 0
    assert marts["fact.block"].count() == marts["fact.network_stats_1d"].agg(F.sum("block_count")).collect()[0][0]


def test_luck_minus_pct_is_one(marts):
    o = marts["obt.pool_stats_1d"].filter(F.col("mining_luck").isNotNull()
                                          & F.col("block_count_diff_pct").isNotNull())
    assert o.count() > 0
    assert o.filter(F.col("mining_luck") - F.col("block_count_diff_pct") != 1).count() == 0


def test_partitioning_does_not_change_results(spark, marts):
    src = load_sources(spark, SF_SMALL)
    src["block"] = src["block"].repartition(7).sortWithinPartitions(F.rand(1))
    other = Marts(spark, src, run_ts=RUN_TS, strict=False, persist_shared=False)
    a = marts["fact.network_stats_1d"].drop("audit_created_timestamp")
    b = other["fact.network_stats_1d"].drop("audit_created_timestamp")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
