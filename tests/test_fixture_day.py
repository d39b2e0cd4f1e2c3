"""FIXTURES.md §3.2: the hand-computed adjustment day, end to end through all models."""

from decimal import Decimal

import pytest

from chainstar.plans.marts import Marts

from fixtures import RUN_TS, sources

D = Decimal


@pytest.fixture(scope="module")
def marts(spark):
    return Marts(spark, sources(spark), run_ts=RUN_TS)


def test_network_row(marts):
    rows = marts["fact.network_stats_1d"].collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.date_id == "20240424"
    assert r.has_difficulty_adjustment is True and r.has_subsidy_halving is False
    assert (r.block_count, r.pool_count) == (4, 3)           # NULL pool not counted
    assert (r.blockheight_first, r.blockheight_last) == (840671, 840674)
    assert r.difficulty_first == D("80000000000000.500000000")
    assert r.difficulty_last == D("88000000000000.000000000")
    assert r.difficulty_weighted_avg == D("82000000000000.375000000")
    assert r.estimated_hashrate == D("16304968438518593084")
    assert r.estimated_hashrate_th == D("16304968.438518593084")
    assert r.estimated_hashrate_ph == D("16304.968438518593084")
    assert abs(r.estimated_hashrate_eh - D("16.304968438518593084")) < D("1e-15")
    assert (r.reward_subsidy_sum, r.reward_tx_fee_sum, r.reward_mining_sum) == (
        1250000000, 10000000, 1260000000)
    assert r.reward_tx_fee_pct == D("0.793650794")
    assert r.reward_mining_sum_btc == D("12.60000000")
    assert (r.tx_count, r.tx_fee_avg, r.tx_fee_avg_btc) == (100, D("100000.000"), D("0.00100000000"))


def test_network_obt_row(marts):
    r = marts["obt.network_stats_1d"].collect()[0]
    assert r.reward_mining_sum_usd == D("806406.300000")
    assert r.tx_fee_avg_usd == D("64.000500")
    assert r.hashvalue_sat_th == D("77.277058508")
    assert r.hashvalue_sat_ph == D("77277.058508338")
    assert r.hashprice_usd_th == D("0.049457704")
    assert r.hashprice_usd_ph == D("49.457703831")
    assert (r.day_of_week, r.day_of_month, r.day_of_year) == (3, 24, 115)


def test_price_row(marts):
    r = marts["fact.price_1d"].collect()[0]
    assert r.price_change == D("-99.75")
    assert r.price_change_pct == D("-0.155615618")
    assert r.price_spread == D("2000.00")


def test_pool_rows(marts):
    rows = marts["obt.pool_stats_1d"].collect()
    assert len(rows) == 4                                     # alpha, beta, two at '0' (G10)
    by_key = {}
    for r in rows:
        by_key.setdefault(r.pool_key, []).append(r)
    assert sorted(by_key) == ["[Unknown]", "alpha", "beta"]
    assert len(by_key["[Unknown]"]) == 2
    for r in rows:
        assert r.block_count == 1
        assert r.estimated_hashrate == D("4076242109629648271")
    a = by_key["alpha"][0]
    assert a.expected_block_count == D("1.962591962")
    assert a.block_count_diff == D("-0.962591962")
    assert a.block_count_diff_pct == D("49.953026373")       # reference formula (G5)
    assert a.mining_luck == D("50.953026373")
    assert a.mining_luck - a.block_count_diff_pct == 1
    for r in by_key["beta"] + by_key["[Unknown]"]:
        assert r.expected_block_count is None and r.mining_luck is None


def test_block_facts(marts):
    fb = {r.blockheight: r for r in marts["fact.block"].collect()}
    assert fb[840672].pool_id != "0"                          # ' beta ' trimmed, matched
    assert fb[840673].pool_id == "0" and fb[840674].pool_id == "0"
    assert fb[840671].difficulty_epoch == 417 and fb[840672].difficulty_epoch == 418
    assert fb[840671].subsidy_epoch == 5 and fb[840671].subsidy_level == 312500000
    ob = {r.blockheight: r for r in marts["obt.block"].collect()}
    assert ob[840672].is_difficulty_adjustment is True
    assert ob[840671].is_difficulty_adjustment is False
    assert ob[840673].pool_name == "[Unknown]"


def test_dim_pool_default_member(marts):
    rows = {r.pool_id: r for r in marts["dim.pool"].collect()}
    assert len(rows) == 3
    unknown = rows["0"]
    assert (unknown.pool_key, unknown.pool_name, unknown.pool_url) == ("[Unknown]",) * 3
    assert unknown.is_antpool_friend is None and unknown.audit_created_timestamp is None
    beta = [r for r in rows.values() if r.pool_key == "beta"][0]
    assert beta.pool_url == "[Unknown]"
    assert beta.is_antpool_friend is False                    # NULL or FALSE -> false
