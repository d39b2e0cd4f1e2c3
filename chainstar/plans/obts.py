"""Wide BI tables (OBTs): block, network_stats_1d, pool_stats_1d."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainstar.functions import measures as M
from chainstar.functions.numeric import to_units
from chainstar.operators.star import Arm, drill_across
from chainstar.plans.dims import POOL_DEFAULT
from chainstar.plans.facts import fact_block as fact_block_model

DATE_ATTRS = ["day_of_week", "day_of_month", "day_of_year"]


def _pool_arm(dim_pool: DataFrame, spread: list[str]) -> Arm:
    return Arm(dim_pool.drop("audit_created_timestamp"), on=["pool_id"], default=POOL_DEFAULT, spread=spread)


def _date_arm(dim_date: DataFrame) -> Arm:
    # The calendar has a fixed size: broadcast without a check.
    return Arm(dim_date.select("date_id", F.col("date").alias("event_date"), *DATE_ATTRS),
               on=["date_id"], broadcast=True)


BLOCK_COLUMNS = [
    "block_id", "block_key", "block_hash", "blockheight", "is_subsidy_halving",
    "subsidy_epoch", "subsidy_level", "subsidy_level_btc", "is_difficulty_adjustment",
    "difficulty_epoch", "difficulty", "date_id", "event_date", "event_timestamp",
    *DATE_ATTRS, "pool_id", "pool_key", "pool_name", "pool_url", "is_antpool_friend",
    "is_antpool_friend_custodian", "is_antpool_friend_template", "reward_mining",
    "reward_subsidy", "reward_tx_fee_sum", "reward_tx_fee_pct", "reward_mining_btc",
    "reward_subsidy_btc", "reward_tx_fee_sum_btc", "tx_count", "tx_fee_avg", "tx_fee_avg_btc",
]


def obt_block(fact_block: DataFrame, dim_block: DataFrame, dim_date: DataFrame,
              dim_pool: DataFrame, dim_block_broadcast: bool = False) -> DataFrame:
    """One row per block: fact ⋈ dim.block ⋈ dim.date ⋈ dim.pool (J3), 34 columns.

    dim.block has a row per block, so it is never broadcast; the calendar is.
    Materialised tables bucketed by ``block_id`` (see ``marts``) make the block join
    shuffle-free.  Blocks of unknown pools, many of them, take the default
    member's values without a join.
    """
    return drill_across(fact_block, [
        Arm(dim_block.drop("audit_created_timestamp"), on=["block_id"],
            broadcast=dim_block_broadcast),
        _date_arm(dim_date),
        _pool_arm(dim_pool, ["block_id"]),
    ], BLOCK_COLUMNS)


def obt_block_of(blocks: DataFrame, dim_date: DataFrame, dim_pool: DataFrame, strict: bool = True) -> DataFrame:
    """The same rows from the deduped blocks themselves: the fact and the block
    dimension are two projections of one row, so nothing is shuffled to bring them
    together again, and pool attributes come with the pool's natural key."""
    wide = fact_block_model(blocks, dim_date, dim_pool, strict=strict, wide=True)
    return drill_across(wide, [_date_arm(dim_date)], BLOCK_COLUMNS)


NETWORK_COLUMNS = [
    "has_subsidy_halving", "has_difficulty_adjustment", "difficulty_first", "difficulty_last",
    "difficulty_weighted_avg", "block_count", "blockheight_first", "blockheight_last",
    "pool_count", "estimated_hashrate", "estimated_hashrate_th", "estimated_hashrate_ph",
    "estimated_hashrate_eh", "reward_mining_sum", "reward_subsidy_sum", "reward_tx_fee_sum",
    "tx_count", "reward_tx_fee_pct", "reward_mining_sum_btc", "reward_subsidy_sum_btc",
    "reward_tx_fee_sum_btc",
]


def obt_network_stats_1d(fact_network: DataFrame, fact_price: DataFrame,
                         dim_date: DataFrame) -> DataFrame:
    """One row per day with a price: USD amounts, hashvalue, hashprice.

    Day-grain inputs are bounded by the calendar; the price side is joined
    as an inner join (days without a price drop out, as in the reference).
    """
    combined = drill_across(fact_network, [
        Arm(fact_price.select("date_id", "ticker", "price_close"), on=["date_id"], broadcast=True),
        _date_arm(dim_date),
    ], [
        "date_id", "event_date", *DATE_ATTRS, "ticker", "price_close", *NETWORK_COLUMNS,
        M.usd("price_close", "reward_mining_sum_btc").alias("reward_mining_sum_usd"),
        M.usd("price_close", "reward_subsidy_sum_btc").alias("reward_subsidy_sum_usd"),
        M.usd("price_close", "reward_tx_fee_sum_btc").alias("reward_tx_fee_sum_usd"),
        "tx_fee_avg", "tx_fee_avg_btc",
        M.usd("price_close", "tx_fee_avg_btc", 11).alias("tx_fee_avg_usd"),
        M.hashvalue("reward_mining_sum", to_units("estimated_hashrate_th", 12), 12)
        .alias("hashvalue_sat_th"),
        M.hashvalue("reward_mining_sum", to_units("estimated_hashrate_ph", 15), 15)
        .alias("hashvalue_sat_ph"),
    ])
    # Second stage on first-stage results (P9): hashprice from the rounded hashvalue.
    return combined.select(
        "*",
        M.hashprice("price_close", "hashvalue_sat_th").alias("hashprice_usd_th"),
        M.hashprice("price_close", "hashvalue_sat_ph").alias("hashprice_usd_ph"),
    )


POOL_REWARD_COLUMNS = [
    "reward_mining_sum", "reward_subsidy_sum", "reward_tx_fee_sum", "tx_count",
    "reward_tx_fee_pct", "reward_mining_sum_btc", "reward_subsidy_sum_btc", "reward_tx_fee_sum_btc",
]


def obt_pool_stats_1d(fact_pool: DataFrame, fact_network: DataFrame, fact_price: DataFrame,
                      dim_date: DataFrame, dim_pool: DataFrame, strict: bool = True) -> DataFrame:
    """One row per (day, pool) with a price: USD amounts, expected blocks, luck.

    ``strict=False`` widens the luck columns where the reference would abort on
    an overflow of ``decimal(12,9)`` (a small pool's luck of 1000 % or more).
    """
    combined = drill_across(fact_pool, [
        Arm(fact_network.select("date_id", F.col("difficulty_weighted_avg").alias("__net_difficulty")),
            on=["date_id"], broadcast=True),
        Arm(fact_price.select("date_id", "price_close"), on=["date_id"], broadcast=True),
        _date_arm(dim_date),
        _pool_arm(dim_pool, ["date_id", "blockheight_first"]),
    ], [
        "date_id", "event_date", *DATE_ATTRS, "pool_id", "pool_key", "pool_name", "pool_url",
        "is_antpool_friend", "is_antpool_friend_custodian", "is_antpool_friend_template",
        "reported_hashrate", "reported_hashrate_th", "reported_hashrate_ph", "reported_hashrate_eh",
        "estimated_hashrate", "estimated_hashrate_th", "estimated_hashrate_ph",
        "estimated_hashrate_eh",
        M.expected_block_count("reported_hashrate", "__net_difficulty", strict)
        .alias("expected_block_count"),
        "block_count", "blockheight_first", "blockheight_last", *POOL_REWARD_COLUMNS,
        M.usd("price_close", "reward_mining_sum_btc").alias("reward_mining_sum_usd"),
        M.usd("price_close", "reward_subsidy_sum_btc").alias("reward_subsidy_sum_usd"),
        M.usd("price_close", "reward_tx_fee_sum_btc").alias("reward_tx_fee_sum_usd"),
        "tx_fee_avg", "tx_fee_avg_btc",
        M.usd("price_close", "tx_fee_avg_btc", 11).alias("tx_fee_avg_usd"),
    ])
    n, e = "block_count", "expected_block_count"
    return combined.select(
        *[c for c in combined.columns[:combined.columns.index("blockheight_first")]],
        M.block_count_diff(n, e, strict).alias("block_count_diff"),
        M.block_count_diff_pct(n, e, strict).alias("block_count_diff_pct"),
        M.mining_luck(n, e, strict).alias("mining_luck"),
        *[c for c in combined.columns[combined.columns.index("blockheight_first"):]],
    )
