"""Models the reference names but does not build.

* E3  one row per difficulty (or subsidy) epoch, from ``obt.block``;
* E4  one row per pool over all time, from ``obt.block``;
* E5  trailing-window luck per pool (Poisson mean, z-score and tail), from
      ``obt.pool_stats_1d``;
* E1  incremental rebuild of the days touched by new source rows, for the daily
      facts and ``fact.block``, written with dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from chainstar.functions import measures as M
from chainstar.functions.numeric import exact_ratio, poisson_at_least, sats_to_btc, to_units
from chainstar.functions.strings import clean
from chainstar.operators.key_days import BUCKETS, KeyDays
from chainstar.operators.sinks import drop_partitions, write_table
from chainstar.operators.snapshot import periodic_snapshot
from chainstar.operators.staging import dedupe_latest
from chainstar.plans import dims, facts

TRAILING_DAYS = 7
EVENT_DAY = "to_date(`timestamp`)"   # a source row's day; a partition column where the table has one


def _reward_rollup() -> list:
    return [
        F.sum("reward_mining").alias("reward_mining_sum"),
        F.sum("reward_subsidy").alias("reward_subsidy_sum"),
        F.sum("reward_tx_fee_sum").alias("reward_tx_fee_sum"),
        F.sum("tx_count").alias("tx_count"),
    ]


def _reward_measures() -> list:
    # Lenient: an epoch or pool may have no reward at all.
    return [
        M.fee_pct("reward_tx_fee_sum", "reward_subsidy_sum", False).alias("reward_tx_fee_pct"),
        sats_to_btc("reward_mining_sum").alias("reward_mining_sum_btc"),
        M.fee_avg("reward_tx_fee_sum", "tx_count", False).alias("tx_fee_avg"),
    ]


def epoch_summary(obt_block: DataFrame, epoch: str = "difficulty_epoch") -> DataFrame:
    """One row per epoch (``difficulty_epoch`` or ``subsidy_epoch``).

    A grouped aggregate with partial aggregation: an epoch holding many
    blocks costs one partial row per task before the shuffle.
    """
    g = periodic_snapshot(obt_block, [epoch], [
        F.count("block_id").alias("block_count"),
        F.min("blockheight").alias("blockheight_first"),
        F.max("blockheight").alias("blockheight_last"),
        F.min("event_timestamp").alias("first_block_timestamp"),
        F.max("event_timestamp").alias("last_block_timestamp"),
        F.min("difficulty").alias("difficulty_min"),
        F.max("difficulty").alias("difficulty_max"),
        F.count_distinct("pool_id").alias("pool_count"),
        *_reward_rollup(),
    ])
    return g.select(
        epoch, "block_count", "blockheight_first", "blockheight_last",
        "first_block_timestamp", "last_block_timestamp",
        F.timestamp_diff("MICROSECOND", "first_block_timestamp", "last_block_timestamp")
        .alias("epoch_span_us"),
        "difficulty_min", "difficulty_max", "pool_count",
        F.col("reward_mining_sum").cast("long").alias("reward_mining_sum"),
        F.col("reward_subsidy_sum").cast("long").alias("reward_subsidy_sum"),
        F.col("reward_tx_fee_sum").cast("long").alias("reward_tx_fee_sum"),
        F.col("tx_count").cast("long").alias("tx_count"),
        *_reward_measures(),
    )


def pool_summary(obt_block: DataFrame) -> DataFrame:
    """One row per pool over all time (the default member included)."""
    g = periodic_snapshot(obt_block, ["pool_id", "pool_key", "pool_name"], [
        F.count("block_id").alias("block_count"),
        F.min("blockheight").alias("blockheight_first"),
        F.max("blockheight").alias("blockheight_last"),
        F.min("event_timestamp").alias("first_block_timestamp"),
        F.max("event_timestamp").alias("last_block_timestamp"),
        F.count_distinct("date_id").alias("active_days"),
        *_reward_rollup(),
    ])
    return g.select(
        "pool_id", "pool_key", "pool_name", "block_count", "blockheight_first",
        "blockheight_last", "first_block_timestamp", "last_block_timestamp", "active_days",
        F.col("reward_mining_sum").cast("long").alias("reward_mining_sum"),
        F.col("reward_subsidy_sum").cast("long").alias("reward_subsidy_sum"),
        F.col("reward_tx_fee_sum").cast("long").alias("reward_tx_fee_sum"),
        F.col("tx_count").cast("long").alias("tx_count"),
        *_reward_measures(),
    )


def luck_model(obt_pool: DataFrame, days: int = TRAILING_DAYS) -> DataFrame:
    """E5: trailing ``days``-row luck per pool.

    Blocks found in a day are Poisson with mean ``expected_block_count``;
    over a trailing window the sum of means is the expected count and its
    variance.  Output: trailing found and expected blocks, trailing luck
    (exact), the z-score ``(found - expected) / sqrt(expected)`` and the Poisson
    probability of finding at least as many, exact for small means too.  Trailing
    found blocks are those of rows with an expected count, as luck compares the two.

    The (day, pool) rows are first summed per pool and day (the default
    member can hold several raw pools a day), so a window partition holds
    one row per day of one pool: its size is bounded by the calendar, not by
    the data volume, even for a pool with a third of all blocks.
    """
    daily = obt_pool.groupBy("pool_id", "date_id").agg(
        F.sum("block_count").alias("block_count"),
        F.sum(F.when(F.col("expected_block_count").isNotNull(), F.col("block_count"))).alias("counted"),
        F.sum("expected_block_count").alias("expected_block_count"))
    w = Window.partitionBy("pool_id").orderBy("date_id").rowsBetween(-(days - 1), 0)
    t = daily.select(
        "pool_id", "date_id", "block_count", "expected_block_count",
        F.coalesce(F.sum("counted").over(w), F.lit(0)).alias("trailing_block_count"),
        F.sum("expected_block_count").over(w).cast(DecimalType(22, 9)).alias("trailing_expected"),
        F.count("date_id").over(w).alias("trailing_days"))
    e = F.col("trailing_expected")
    return t.select(
        "pool_id", "date_id", F.col("block_count").cast("long").alias("block_count"),
        F.col("expected_block_count").cast(DecimalType(22, 9)).alias("expected_block_count"),
        F.col("trailing_days"), F.col("trailing_block_count").cast("long").alias("trailing_block_count"),
        e.alias("trailing_expected"),
        F.when(e > 0, exact_ratio(F.col("trailing_block_count") * 100, to_units(e, 9), 30, 9,
                                  den_scale=9)).alias("trailing_luck"),
        F.when(e > 0, F.round((F.col("trailing_block_count").cast("double") - e.cast("double"))
                              / F.sqrt(e.cast("double")), 6)).alias("luck_z_score"),
        F.round(poisson_at_least(F.col("trailing_block_count"), e), 9).alias("luck_p_value"),
    )


def _days_listed(marts, days: DataFrame) -> list:
    """The calendar's days among ``days.event_date``: 29,220 at most, so the driver may hold them."""
    cal = marts["dim.date"].select(F.col("date").alias("event_date"))
    days = days.select("event_date").distinct().join(F.broadcast(cal), "event_date", "left_semi")
    return sorted(r[0] for r in days.collect())


def _among(day: str, days: list) -> Column:
    """``day`` (SQL) is one of ``days``: literals, so that a partition column prunes files."""
    return F.expr(f"coalesce({day} IN ({', '.join(f"DATE'{d}'" for d in days)}), false)") if days else F.lit(False)


def _held_on(src: DataFrame, day: str) -> DataFrame:
    """(block_key, event_date) of every copy in the source table."""
    return src.select(clean("block_hash").alias("block_key"), F.expr(day).alias("event_date"))


def touched_days(marts, delivered: DataFrame, day: str = EVENT_DAY) -> DataFrame:
    """The days that newly delivered blocks change: their own, and those which
    earlier copies of the same blocks were held on (a block that moves leaves its old day).

    Without an index this reads two columns of the whole source table; ``BlockFeed``
    keeps a key-to-day index instead.
    """
    new = _held_on(delivered, day)
    held = _held_on(marts.sources["block"], day)
    return (held.join(new.select("block_key").distinct(), "block_key", "left_semi")
            .unionByName(new).select("event_date").distinct())


def rebuild_days(marts, touched: DataFrame, paths: str | Mapping[str, str], day: str = EVENT_DAY,
                 index: KeyDays | None = None) -> None:
    """Recompute the touched days (see ``touched_days``) of the daily models and ``fact.block``.

    ``paths`` maps models to their folders (a single path: ``fact.network_stats_1d``).
    Exact for blocks whose copies lie on several days: keep-latest sees all
    copies of every block that has one on a touched day, and only then days are
    picked.  The files read are those of the touched days and of the (usually
    few) other days with copies of their blocks, where ``day``, the source's day
    as SQL, is a partition column; which days these are comes from ``index`` if given, else
    from two columns of the whole source.  Touched days are replaced by dynamic partition
    overwrite; those left without rows lose their partition.
    """
    paths = {"fact.network_stats_1d": paths} if isinstance(paths, str) else dict(paths)
    days = _days_listed(marts, touched)
    if not days:
        return
    spark, src, cal = marts.spark, marts.sources["block"], marts["dim.date"]
    inside = _among("event_date", days)
    if index is not None:
        near = _days_listed(marts, index.near(touched))
    else:
        held = _held_on(src, day)
        keys = held.filter(inside).select("block_key").distinct()
        near = _days_listed(marts, held.filter(~inside).join(keys, "block_key", "left_semi"))
    near = sorted(set(near).difference(days))
    # Copies without a day of the calendar may be a block's latest, too.
    off = F.expr(f"{day} IS NULL OR {day} < DATE'{dims.CALENDAR_START}' "
                 f"OR {day} >= date_add(DATE'{dims.CALENDAR_START}', {dims.CALENDAR_DAYS})")
    staged = dims.stage_blocks(src.filter(_among(day, [*days, *near]) | off), marts.run_ts)
    blocks = dedupe_latest(staged, ["block_key"], ["audit_created_timestamp"]).filter(inside)
    # The touched days' cube feeds several branches (adjustments, day roll-up):
    # keep it for this rebuild only (recomputed from lineage if lost).
    cube = facts.block_cube(blocks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, path in paths.items():
            if name == "fact.price_1d":
                price = marts.sources["price"].filter(_among("CAST(`date` AS DATE)", days))
                fact = facts.fact_price_1d(price, cal, run_ts=marts.run_ts)
            elif name == "fact.block":
                fact = facts.fact_block(blocks, cal, marts["dim.pool"], strict=marts.strict)
            elif name == "fact.pool_stats_1d":
                rates = marts.sources["hashrate"].filter(_among("CAST(`date` AS DATE)", days))
                fact = facts.fact_pool_stats_1d(blocks, rates, cal, marts["dim.pool"], marts.collapse_unknown,
                                                cube=cube, strict=marts.strict)
            elif name == "fact.network_stats_1d":
                fact = facts.fact_network_stats_1d(blocks, cal, cube=cube, strict=marts.strict)
            else:
                raise KeyError(name)
            write_table(fact.withColumn("day", F.col("date_id")), path=path, partition_by=["day"],
                        dynamic_partitions=True)
            if name == "fact.price_1d":
                left = price.filter(clean("ticker") == facts.DEFAULT_TICKER).select(
                    F.col("date").cast("date").alias("event_date"))
            else:
                left = cube
            gone = set(days).difference(_days_listed(marts, left))
            drop_partitions(spark, path, "day", [f"{d:%Y%m%d}" for d in sorted(gone)])
    finally:
        cube.unpersist()


# A stored feed is partitioned by its rows' day and the delivery that brought them.
STORED = {"day": "date", "delivery": "long"}


@dataclass
class BlockFeed:
    """A block feed stored by day and delivery at ``path`` (its index beside
    it), and the models in ``targets`` (name -> folder) kept equal to a full build over it.

    ``deliver`` stores the rows, records their keys in the index, and rebuilds
    the days that changed.  It reads the index's buckets of the delivered keys, and the feed's
    files of the touched days and of days that share a block with them: its cost
    follows the delivery, not the history.  The same id again replaces the delivery,
    so a failed one is simply repeated.
    """

    spark: SparkSession
    path: str
    targets: Mapping[str, str]
    sources: Mapping[str, DataFrame] = field(default_factory=dict)   # pool, hashrate, price
    run_ts: object = None
    strict: bool = True
    buckets: int = BUCKETS

    @property
    def index(self) -> KeyDays:
        return KeyDays(self.spark, f"{self.path.rstrip('/')}_index", self.buckets)

    def stored(self, schema: StructType) -> DataFrame:
        whole = StructType(list(schema.fields))
        for name, kind in STORED.items():
            whole = whole.add(name, kind)
        return self.spark.read.schema(whole).parquet(self.path)

    def deliver(self, rows: DataFrame, delivery: int) -> None:
        from chainstar.plans.marts import Marts

        tagged = rows.withColumns({"day": F.expr(EVENT_DAY), "delivery": F.lit(delivery).cast("long")})
        write_table(tagged.hint("rebalance", "day"), path=self.path, partition_by=list(STORED), dynamic_partitions=True)
        feed = self.stored(rows.schema)
        held = _held_on(feed.filter(F.col("delivery") == delivery), "`day`")
        index = self.index
        touched = index.add(held.withColumnRenamed("block_key", "key"), delivery)
        marts = Marts(self.spark, dict(self.sources) | {"block": feed}, run_ts=self.run_ts, strict=self.strict,
                      persist_shared=False)
        rebuild_days(marts, touched, self.targets, "`day`", index)
