"""Fact models: price_1d, block, network_stats_1d, pool_stats_1d."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from chainstar.functions import measures as M
from chainstar.functions.epochs import (
    ADJUSTMENT_INTERVAL, HALVING_INTERVAL, epoch, halving_level,
)
from chainstar.functions.measures import btc as sats_to_btc
from chainstar.functions.strings import UNKNOWN_ID, bounded, clean, surrogate_key
from chainstar.operators.keys import broadcast_if_small, resolve_fk
from chainstar.operators.snapshot import periodic_snapshot, regime_weighted_avg
from chainstar.operators.staging import dedupe_latest, stage
from chainstar.plans.dims import POOL_DEFAULT, adjustment_flag, audit_column, block_attributes, halving_flag

DEFAULT_TICKER = "BTC-USD"
POOL_ATTRIBUTES = ["pool_key", "pool_name", "pool_url", "is_antpool_friend", "is_antpool_friend_custodian",
                   "is_antpool_friend_template"]


def with_date_id(df: DataFrame, dim_date: DataFrame, on: str = "event_date") -> DataFrame:
    """Inner join to the calendar on the natural date; drops dates outside it.

    The calendar's size is fixed (29,220 rows), so it is broadcast unchecked;
    only its two key columns travel.
    """
    dd = broadcast_if_small(dim_date.select(F.col("date").alias("__dd_date"), "date_id"),
                            known_small=True)
    return df.join(dd, df[on] == dd["__dd_date"], "inner").drop("__dd_date")


# -- fact.price_1d --------------------------------------------------------------

def fact_price_1d(src_price: DataFrame, dim_date: DataFrame, ticker: str = DEFAULT_TICKER,
                  run_ts=None) -> DataFrame:
    staged = stage(src_price, {
        "event_date": F.col("date").cast("date"),
        "ticker": clean("ticker"),
        "price_open": F.col("price_open").cast(DecimalType(21, 2)),
        "price_close": F.col("price_close").cast(DecimalType(21, 2)),
        "price_low": F.col("price_low").cast(DecimalType(21, 2)),
        "price_high": F.col("price_high").cast(DecimalType(21, 2)),
        "audit_created_timestamp": audit_column(src_price, run_ts),
    }, where=clean("ticker") == F.lit(ticker))                     # F2
    latest = dedupe_latest(staged, ["event_date"], ["audit_created_timestamp"])
    rel = with_date_id(latest, dim_date)
    return rel.select(
        bounded("date_id", 512).alias("date_id"),
        bounded("ticker", 10).alias("ticker"),
        F.col("price_open"),
        F.col("price_close"),
        M.price_change("price_close", "price_open").alias("price_change"),
        M.price_change_pct("price_close", "price_open").alias("price_change_pct"),
        F.col("price_low"),
        F.col("price_high"),
        M.price_spread("price_high", "price_low").alias("price_spread"),
    )


# -- fact.block -------------------------------------------------------------------

def fact_block(blocks: DataFrame, dim_date: DataFrame, dim_pool: DataFrame,
               dim_block: DataFrame | None = None, strict: bool = True, wide: bool = False) -> DataFrame:
    """One row per block with epochs, rewards in sats and BTC, fee averages.

    ``wide`` adds what the block and pool dimensions say of the block (for
    ``obt.block``): the one is a function of the row, the other comes with the
    pool's key.

    ``block_id``: the block dimension is built from the same deduped blocks,
    so every block has its dimension row and the id is ``md5`` of the key;
    it is computed in place (J11 folded).  Pass ``dim_block`` to resolve it
    by a join instead (e.g. against a dimension from an older load).
    """
    b = blocks.withColumn("subsidy_epoch", epoch("blockheight", HALVING_INTERVAL)) \
        .withColumn("difficulty_epoch", epoch("blockheight", ADJUSTMENT_INTERVAL)) \
        .withColumn("subsidy_level", halving_level("subsidy_epoch"))
    b = with_date_id(b, dim_date)
    if dim_block is None:
        b = b.withColumn("block_id", F.coalesce(bounded(surrogate_key("block_key"), 512),
                                                F.lit(UNKNOWN_ID)))
    else:
        b = resolve_fk(b, dim_block, "block_key", "block_id", broadcast=False)
    carry = {f"__{c}": (c, POOL_DEFAULT.get(c)) for c in POOL_ATTRIBUTES} if wide else None
    b = resolve_fk(b, dim_pool, "pool_key", "pool_id", carry=carry)
    attributes = [*block_attributes(), *[F.col(f"__{c}").alias(c) for c in POOL_ATTRIBUTES]] if wide else []
    return b.select(
        *attributes,
        bounded("date_id", 8).alias("date_id"),
        bounded("block_id", 512).alias("block_id"),
        bounded("pool_id", 512).alias("pool_id"),
        F.col("blockheight"),
        F.col("event_timestamp"),
        F.col("subsidy_epoch"),
        F.col("subsidy_level").cast("long").alias("subsidy_level"),
        sats_to_btc("subsidy_level").alias("subsidy_level_btc"),
        F.col("difficulty_epoch"),
        F.col("difficulty"),
        M.reward_mining("reward_subsidy", "reward_tx_fee_sum").alias("reward_mining"),
        F.col("reward_subsidy"),
        F.col("reward_tx_fee_sum"),
        M.fee_pct("reward_tx_fee_sum", "reward_subsidy", strict).alias("reward_tx_fee_pct"),
        sats_to_btc(M.reward_mining("reward_subsidy", "reward_tx_fee_sum")).alias("reward_mining_btc"),
        sats_to_btc("reward_subsidy").alias("reward_subsidy_btc"),
        sats_to_btc("reward_tx_fee_sum").alias("reward_tx_fee_sum_btc"),
        F.col("tx_count"),
        M.fee_avg("reward_tx_fee_sum", "tx_count", strict).alias("tx_fee_avg"),
        M.fee_avg_btc("reward_tx_fee_sum", "tx_count", strict).alias("tx_fee_avg_btc"),
        F.col("audit_created_timestamp"),
    )


# -- daily snapshots -------------------------------------------------------------
#
# Both daily facts roll up one pre-aggregate of the deduped blocks at the
# finest grain they need: (day, pool, adjustment height).  Ordinary blocks
# of a pool-day collapse into one row (adjustment height NULL); each
# adjustment block keeps a row of its own with its time and new level.  The
# pool-day, the day and the day's adjustments are all re-aggregations of it
# (A4), so the block table is read and shuffled once, as partial aggregates.

def block_cube(blocks: DataFrame) -> DataFrame:
    """R7 at grain (event_date, pool_key, change_height)."""
    change_height = F.when(adjustment_flag(), F.col("blockheight"))
    return periodic_snapshot(blocks, [F.col("event_date"), F.col("pool_key"),
                                      change_height.alias("change_height")], [
        F.count("block_key").alias("block_count"),                        # unique after dedupe
        F.min("blockheight").alias("blockheight_first"),
        F.max("blockheight").alias("blockheight_last"),
        F.min_by("difficulty", "blockheight").alias("difficulty_first"),  # J7 folded
        F.max_by("difficulty", "blockheight").alias("difficulty_last"),
        F.bool_or(halving_flag()).alias("has_subsidy_halving"),           # A5
        F.sum("reward_subsidy").alias("reward_subsidy_sum"),
        F.sum("reward_tx_fee_sum").alias("reward_tx_fee_sum"),
        F.sum("tx_count").alias("tx_count"),
        F.max("audit_created_timestamp").alias("audit_created_timestamp"),
        F.min("event_timestamp").alias("change_timestamp"),
    ])


def _rollup(df: DataFrame, grain: list[str], extra: list | None = None) -> DataFrame:
    return periodic_snapshot(df, grain, [
        F.sum("block_count").alias("block_count"),
        F.min("blockheight_first").alias("blockheight_first"),
        F.max("blockheight_last").alias("blockheight_last"),
        F.min_by("difficulty_first", "blockheight_first").alias("difficulty_first"),
        F.max_by("difficulty_last", "blockheight_last").alias("difficulty_last"),
        F.bool_or("has_subsidy_halving").alias("has_subsidy_halving"),
        F.sum("reward_subsidy_sum").alias("reward_subsidy_sum"),
        F.sum("reward_tx_fee_sum").alias("reward_tx_fee_sum"),
        F.sum("tx_count").alias("tx_count"),
        F.max("audit_created_timestamp").alias("audit_created_timestamp"),
        *(extra or []),
    ])


def pool_day(cube: DataFrame) -> DataFrame:
    """A3: one row per (day, pool); a NULL pool forms its own group."""
    return _rollup(cube, ["event_date", "pool_key"],
                   [F.bool_or(F.col("change_height").isNotNull()).alias("has_difficulty_adjustment")])


def network_day(pools: DataFrame) -> DataFrame:
    """A4: the day from its (day, pool) rows; ``count(pool_key)`` over pool
    groups is ``count(distinct pool_key)`` over blocks (A6)."""
    return _rollup(pools, ["event_date"], [
        F.bool_or("has_difficulty_adjustment").alias("has_difficulty_adjustment"),
        F.count("pool_key").alias("pool_count"),
    ])


def adjustments(cube: DataFrame) -> DataFrame:
    """The adjustment blocks: day, height, time and new difficulty."""
    return cube.filter(F.col("change_height").isNotNull()).select(
        "event_date", F.col("change_height").alias("blockheight"),
        F.col("change_timestamp").alias("event_timestamp"),
        F.col("difficulty_first").alias("difficulty"))


def daily_pool_aggregate(blocks: DataFrame) -> DataFrame:
    """A3 as in the reference's pool aggregate (columns it names)."""
    return pool_day(block_cube(blocks)).select(
        "event_date", "pool_key", "has_difficulty_adjustment", "block_count", "blockheight_first",
        "blockheight_last", "reward_subsidy_sum", "reward_tx_fee_sum", "tx_count",
        "audit_created_timestamp", "difficulty_first")


def network_from_pools(pool_daily: DataFrame) -> DataFrame:
    """A4 as in the reference's network-from-pool aggregate."""
    return periodic_snapshot(pool_daily, ["event_date"], [
        F.bool_or("has_difficulty_adjustment").alias("has_difficulty_adjustment"),
        F.min("blockheight_first").alias("blockheight_first"),
        F.max("blockheight_last").alias("blockheight_last"),
        F.min_by("difficulty_first", "blockheight_first").alias("difficulty_first"),
    ])


def with_weighted_difficulty(changes: DataFrame, daily: DataFrame) -> DataFrame:
    """D9 via R8 over the day's difficulty adjustments."""
    return regime_weighted_avg(changes, daily, change_every=ADJUSTMENT_INTERVAL)


def _reward_columns(strict: bool = True) -> list:
    s, f, t = "reward_subsidy_sum", "reward_tx_fee_sum", "tx_count"
    return [
        M.reward_mining(s, f).alias("reward_mining_sum"),
        F.col(s).cast("long").alias(s),
        F.col(f).cast("long").alias(f),
        F.col(t).cast("int").alias(t),
        M.fee_pct(f, s, strict).alias("reward_tx_fee_pct"),
        sats_to_btc(M.reward_mining(s, f)).alias("reward_mining_sum_btc"),
        sats_to_btc(s).alias("reward_subsidy_sum_btc"),
        sats_to_btc(f).alias("reward_tx_fee_sum_btc"),
        M.fee_avg(f, t, strict).alias("tx_fee_avg"),
        M.fee_avg_btc(f, t, strict).alias("tx_fee_avg_btc"),
    ]


def network_daily(cube: DataFrame) -> DataFrame:
    """The day with its time-weighted difficulty (shared by both daily facts)."""
    return with_weighted_difficulty(adjustments(cube), network_day(pool_day(cube)))


def fact_network_stats_1d(blocks: DataFrame, dim_date: DataFrame,
                          cube: DataFrame | None = None,
                          daily: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """One row per day: counts, rewards, first/last/weighted difficulty, hashrate."""
    if daily is None:
        daily = network_daily(block_cube(blocks) if cube is None else cube)
    rel = with_date_id(daily, dim_date)
    # Materialised once, read by four scale columns.
    rel = rel.withColumn("__est", M.estimated_hashrate_units("block_count", "difficulty_weighted_avg"))
    est = "__est"
    return rel.select(
        bounded("date_id", 512).alias("date_id"),
        F.col("has_subsidy_halving"),
        F.col("has_difficulty_adjustment"),
        F.col("difficulty_first").cast(DecimalType(30, 9)).alias("difficulty_first"),
        F.col("difficulty_last").cast(DecimalType(30, 9)).alias("difficulty_last"),
        F.col("difficulty_weighted_avg").cast(DecimalType(30, 9)).alias("difficulty_weighted_avg"),
        F.col("block_count").cast("int").alias("block_count"),
        F.col("blockheight_first").cast("int").alias("blockheight_first"),
        F.col("blockheight_last").cast("int").alias("blockheight_last"),
        F.col("pool_count").cast("int").alias("pool_count"),
        *M.hashrate_columns(est, "estimated_hashrate"),
        *_reward_columns(strict),
        F.col("audit_created_timestamp"),
    )


def staged_hashrate(src_hashrate: DataFrame, run_ts=None) -> DataFrame:
    staged = stage(src_hashrate, {
        "event_date": F.col("date").cast("date"),
        "pool_key": clean("pool_key"),
        "reported_hashrate": F.col("hashrate").cast(DecimalType(30, 0)),
        "audit_created_timestamp": audit_column(src_hashrate, run_ts),
    }, not_null=["pool_key"])
    return dedupe_latest(staged, ["event_date", "pool_key"], ["audit_created_timestamp"])   # W2


def fact_pool_stats_1d(blocks: DataFrame, src_hashrate: DataFrame, dim_date: DataFrame,
                       dim_pool: DataFrame, collapse_unknown: bool = False,
                       cube: DataFrame | None = None,
                       daily: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """One row per (day, raw pool): blocks, rewards, reported and estimated hashrate.

    Unmatched pools get id ``'0'`` after grouping, so several raw pools can
    share ``(date_id, '0')`` as in the reference (G10);
    ``collapse_unknown=True`` re-aggregates them to the stated grain.
    """
    cube = block_cube(blocks) if cube is None else cube
    pools = pool_day(cube)
    network = (network_daily(cube) if daily is None else daily) \
        .select("event_date", "difficulty_weighted_avg")
    # One row per calendar day at most (inner join to the fixed-size
    # calendar), so the day table is broadcast; the date key comes with it.
    network = with_date_id(network, dim_date)
    rel = pools.join(F.broadcast(network), "event_date", "inner")
    hr = staged_hashrate(src_hashrate).select("event_date", "pool_key", "reported_hashrate")
    rel = rel.join(hr, ["event_date", "pool_key"], "left")          # J10
    rel = resolve_fk(rel, dim_pool, "pool_key", "pool_id")
    if collapse_unknown:
        rel = rel.groupBy("date_id", "pool_id", "difficulty_weighted_avg").agg(
            F.sum("reported_hashrate").alias("reported_hashrate"),
            F.sum("block_count").alias("block_count"),
            F.min("blockheight_first").alias("blockheight_first"),
            F.max("blockheight_last").alias("blockheight_last"),
            F.sum("reward_subsidy_sum").alias("reward_subsidy_sum"),
            F.sum("reward_tx_fee_sum").alias("reward_tx_fee_sum"),
            F.sum("tx_count").alias("tx_count"),
            F.max("audit_created_timestamp").alias("audit_created_timestamp"))
    rel = rel.withColumn("__est", M.estimated_hashrate_units("block_count", "difficulty_weighted_avg"))
    est = "__est"
    return rel.select(
        bounded("date_id", 512).alias("date_id"),
        bounded("pool_id", 512).alias("pool_id"),
        F.col("reported_hashrate").cast(DecimalType(30, 9)).alias("reported_hashrate"),
        *M.scaled_columns(F.col("reported_hashrate").cast(DecimalType(30, 9)), "reported_hashrate"),
        *M.hashrate_columns(est, "estimated_hashrate"),
        F.col("block_count").cast("int").alias("block_count"),
        F.col("blockheight_first").cast("int").alias("blockheight_first"),
        F.col("blockheight_last").cast("int").alias("blockheight_last"),
        *_reward_columns(strict),
        F.col("audit_created_timestamp"),
    )
