"""FIXTURES.md §3.3: edge cases of the models."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chainstar.operators.quality import broken_links, duplicate_keys, stale_heights
from chainstar.plans import dims
from chainstar.plans.marts import Marts

from fixtures import (
    ADJ_DAY_HASHRATE, ADJ_DAY_POOLS, ADJ_DAY_PRICE, RUN_TS, blocks_df, sources,
)

D = Decimal


def build(spark, blocks, price=ADJ_DAY_PRICE, hashrate=ADJ_DAY_HASHRATE, pools=ADJ_DAY_POOLS,
          **kw):
    return Marts(spark, sources(spark, blocks=blocks, pools=pools, price=price, hashrate=hashrate),
                 run_ts=RUN_TS, **kw)


def test_halving_flags_epochs_levels(spark):
    m = build(spark, [
        (0, "2009-01-03 18:15:05", "alpha", "1", 5000000000, 0, 1, "h0", "none"),
        (839999, "2024-04-19 23:59:00", "alpha", "1", 625000000, 0, 1),
        (840000, "2024-04-20 00:09:27", "alpha", "1", 312500000, 0, 1, "h840000", "h839999"),
    ])
    fb = {r.blockheight: r for r in m["fact.block"].collect()}
    assert [fb[h].subsidy_epoch for h in (0, 839999, 840000)] == [1, 4, 5]
    assert [fb[h].subsidy_level for h in (0, 839999, 840000)] == [5000000000, 625000000, 312500000]
    db = {r.block_key: r for r in m["dim.block"].collect()}
    assert [db[k].is_subsidy_halving for k in ("h0", "h839999", "h840000")] == [True, False, True]
    assert db["h0"].is_difficulty_adjustment is True          # height 0 is a multiple


def test_halving_day_fee_share(spark):
    m = build(spark, [
        (840000, "2024-04-20 00:09:27", "alpha", "1", 312500000, 37500000, 1),
        (840001, "2024-04-20 00:30:00", "alpha", "1", 312500000, 12500000, 1),
    ])
    r = m["fact.network_stats_1d"].collect()[0]
    assert r.reward_tx_fee_pct == D("7.407407407")
    assert r.has_subsidy_halving is True


def test_no_adjustment_weighted_is_first(spark):
    m = build(spark, [(100, "2024-04-24 01:00:00", "alpha", "123.5", 1, 1, 1),
                      (101, "2024-04-24 02:00:00", "alpha", "123.5", 1, 1, 1)])
    r = m["fact.network_stats_1d"].collect()[0]
    assert r.difficulty_weighted_avg == r.difficulty_first == D("123.500000000")


def test_adjustment_block_first_of_day(spark):
    m = build(spark, [(840672, "2024-04-24 00:10:00", "alpha", "88", 1, 1, 1),
                      (840673, "2024-04-24 05:00:00", "alpha", "88", 1, 1, 1)])
    r = m["fact.network_stats_1d"].collect()[0]
    assert r.difficulty_weighted_avg == D("88.000000000")


def test_two_adjustments_in_a_day_segment_weighted(spark):
    # Levels 100 until 06:00, 200 until 12:00, 300 until midnight -> 225.
    m = build(spark, [
        (4031, "2024-04-24 00:00:10", "alpha", "100", 1, 1, 1),
        (4032, "2024-04-24 06:00:00", "alpha", "200", 1, 1, 1),
        (6047, "2024-04-24 10:00:00", "alpha", "200", 1, 1, 1),
        (6048, "2024-04-24 12:00:00", "alpha", "300", 1, 1, 1),
    ])
    rows = m["fact.network_stats_1d"].collect()
    assert len(rows) == 1                                      # no fan-out (G11)
    assert rows[0].difficulty_weighted_avg == D("225.000000000")


def test_competing_blocks_at_an_adjustment_height(spark):
    # Two pools find height 4032: the earlier one's time counts, once -> 175.
    m = build(spark, [
        (4031, "2024-04-24 00:00:10", "alpha", "100", 1, 1, 1, "h4031", "h4030"),
        (4032, "2024-04-24 06:00:00", "alpha", "200", 1, 1, 1, "hA", "h4031"),
        (4032, "2024-04-24 06:00:01", "beta", "200", 1, 1, 1, "hB", "h4031"),
    ])
    rows = m["fact.network_stats_1d"].collect()
    assert [r.difficulty_weighted_avg for r in rows] == [D("175.000000000")]


def test_a_missing_adjustment_height(spark):
    # 6048 is missing: the level of 4032 holds until 8064 -> 225.
    m = build(spark, [
        (4031, "2024-04-24 00:00:10", "alpha", "100", 1, 1, 1),
        (4032, "2024-04-24 06:00:00", "alpha", "200", 1, 1, 1),
        (8064, "2024-04-24 12:00:00", "alpha", "300", 1, 1, 1),
    ])
    assert [r.difficulty_weighted_avg for r in m["fact.network_stats_1d"].collect()] == [D("225.000000000")]


def test_exact_and_conflicting_duplicates_are_stable(spark):
    base = [(1, "2024-04-24 01:00:00", "alpha", "5", 10, 1, 3),
            (1, "2024-04-24 01:00:00", "alpha", "5", 10, 1, 3),     # exact copy
            (2, "2024-04-24 02:00:00", "alpha", "5", 10, 1, 4),
            (2, "2024-04-24 02:00:00", "alpha", "5", 10, 1, 9)]     # conflicting copy
    results = set()
    for order in (base, list(reversed(base))):
        src = blocks_df(spark, order).repartition(3)
        blocks = dims.staged_blocks(src, RUN_TS)
        rows = sorted((r.block_key, r.tx_count) for r in blocks.collect())
        results.add(tuple(rows))
    assert len(results) == 1
    rows = list(results)[0]
    assert [k for k, _ in rows] == ["h1", "h2"]
    assert dict(rows)["h2"] == 9                               # total order: larger value wins


def test_latest_version_wins(spark):
    src = blocks_df(spark, [(7, "2024-04-24 01:00:00", "alpha", "5", 10, 1, 3)]).withColumn(
        "loaded_at", F.lit("2024-04-24 01:00:00").cast("timestamp_ntz"))
    newer = src.withColumn("tx_count", F.lit(1)).withColumn(
        "loaded_at", F.lit("2024-04-24 03:00:00").cast("timestamp_ntz"))
    rows = dims.staged_blocks(src.unionByName(newer), RUN_TS).collect()
    assert [(r.tx_count, str(r.audit_created_timestamp)) for r in rows] == [(1, "2024-04-24 03:00:00")]


def test_stale_block_reported_one_daily_row(spark):
    m = build(spark, [(10, "2024-04-24 01:00:00", "alpha", "5", 10, 1, 1, "hA", "h9"),
                      (10, "2024-04-24 01:00:01", "beta", "5", 10, 1, 1, "hB", "h9"),
                      (11, "2024-04-24 02:00:00", "alpha", "5", 10, 1, 1, "h11", "hA")])
    stale = stale_heights(m.blocks).collect()
    assert [(r.blockheight, r.block_count) for r in stale] == [(10, 2)]
    assert broken_links(m.blocks).count() == 0
    assert len(m["fact.network_stats_1d"].collect()) == 1


def test_zero_divide(spark):
    m = build(spark, [(1, "2024-04-24 01:00:00", "alpha", "5", 10, 1, 0)],
              price=[("2024-04-24", "BTC-USD", "0", "5", "0", "5")])
    with pytest.raises(PySparkException):
        m["fact.block"].collect()                              # tx_count = 0: strict raises
    assert m["fact.price_1d"].collect()[0].price_change_pct is None


def test_luck_past_the_declared_type_strict_and_lenient(spark):
    # Expected 0.05 blocks (hashrate tiny), one block found: 2000 %.
    blocks = [(5, "2024-04-24 01:00:00", "alpha", "1000000", 1, 1, 1)]
    rate = 1000000 * 4294967296 * 5 // 100 // 86400
    strict = build(spark, blocks, hashrate=[("2024-04-24", "alpha", str(rate))])
    with pytest.raises(PySparkException):
        strict["obt.pool_stats_1d"].collect()
    lenient = build(spark, blocks, hashrate=[("2024-04-24", "alpha", str(rate))], strict=False)
    r = lenient["obt.pool_stats_1d"].collect()[0]
    assert 1999 < r.mining_luck < 2001 and r.mining_luck - r.block_count_diff_pct == 1


def test_out_of_range_date_dropped(spark):
    m = build(spark, [(1, "2050-01-01 01:00:00", "alpha", "5", 10, 1, 1),
                      (2, "2049-12-31 23:00:00", "alpha", "5", 10, 1, 1)])
    assert [r.blockheight for r in m["fact.block"].collect()] == [2]
    assert [r.date_id for r in m["fact.network_stats_1d"].collect()] == ["20491231"]


def test_day_without_price_missing_in_obt(spark):
    m = build(spark, [(1, "2024-04-23 01:00:00", "alpha", "5", 10, 1, 1),
                      (2, "2024-04-24 01:00:00", "alpha", "5", 10, 1, 1)])
    assert m["fact.network_stats_1d"].count() == 2
    assert [r.date_id for r in m["obt.network_stats_1d"].collect()] == ["20240424"]


def test_long_key_cut_to_256_id_from_full_key(spark):
    key = "k" * 300
    m = build(spark, [(1, "2024-04-24 01:00:00", key, "5", 10, 1, 1)],
              pools=[(key, "Long", None, None, None)])
    p = [r for r in m["dim.pool"].collect() if r.pool_id != "0"][0]
    assert len(p.pool_key) == 256
    import hashlib
    assert p.pool_id == hashlib.md5(("surrogate" + key).encode()).hexdigest()
    # The fact's 300-char key equals no 256-char dimension key: default member.
    assert m["fact.block"].collect()[0].pool_id == "0"


def test_unknown_member_apart_from_source_unknown(spark):
    m = build(spark, [(1, "2024-04-24 01:00:00", "unknown", "5", 10, 1, 1)],
              pools=[("unknown", "Unknown", None, None, None)])
    rows = m["dim.pool"].collect()
    assert sorted(r.pool_key for r in rows) == ["[Unknown]", "unknown"]
    assert len([r for r in rows if r.pool_id == "0"]) == 1
    assert m["fact.block"].collect()[0].pool_id != "0"


def test_collapse_unknown_restores_grain(spark):
    m = build(spark, [(1, "2024-04-24 01:00:00", "x1", "5", 10, 1, 1),
                      (2, "2024-04-24 02:00:00", "x2", "5", 10, 1, 1)], collapse_unknown=False)
    assert duplicate_keys(m["fact.pool_stats_1d"], ["date_id", "pool_id"]).count() == 1
    c = build(spark, [(1, "2024-04-24 01:00:00", "x1", "5", 10, 1, 1),
                      (2, "2024-04-24 02:00:00", "x2", "5", 10, 1, 1)], collapse_unknown=True)
    rows = c["fact.pool_stats_1d"].collect()
    assert len(rows) == 1 and rows[0].block_count == 2
