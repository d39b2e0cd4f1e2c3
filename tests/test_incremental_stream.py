"""E1 incremental rebuild and E7 streaming feed: late blocks fold in exactly."""

import os

import pytest
from pyspark.sql import functions as F

from chainstar.plans.extensions import rebuild_days, touched_days
from chainstar.plans.marts import Marts
from chainstar.streaming.block_feed import FEED_SCHEMA, run_block_feed

from fixtures import ADJ_DAY_POOLS, RUN_TS, blocks_df, pools_df

DAY1 = [(100, "2024-04-23 01:00:00", "alpha", "5", 10, 1, 1),
        (101, "2024-04-23 02:00:00", "alpha", "5", 10, 2, 1)]
DAY2 = [(102, "2024-04-24 01:00:00", "beta", "5", 10, 4, 1)]
LATE = [(103, "2024-04-23 23:00:00", "beta", "5", 10, 8, 1)]      # belongs to day 1


def _feed_rows(spark, rows, loaded):
    return blocks_df(spark, rows).withColumn("loaded_at", F.lit(loaded).cast("timestamp_ntz"))


def _fees(spark, path):
    return {r.date_id: (r.block_count, r.reward_tx_fee_sum)
            for r in spark.read.parquet(path).collect()}


def test_rebuild_touches_only_given_days(spark, tmp_dir):
    out = os.path.join(tmp_dir, "fact")
    first = blocks_df(spark, DAY1 + DAY2)
    rebuild_days(Marts(spark, {"block": first}, run_ts=RUN_TS, persist_shared=False),
                 first.select(F.to_date("timestamp").alias("event_date")), out)
    assert _fees(spark, out) == {"20240423": (2, 3), "20240424": (1, 4)}
    day2_files = sorted(os.listdir(os.path.join(out, "day=20240424")))
    both = blocks_df(spark, DAY1 + DAY2 + LATE)
    late = blocks_df(spark, LATE)
    rebuild_days(Marts(spark, {"block": both}, run_ts=RUN_TS, persist_shared=False),
                 late.select(F.to_date("timestamp").alias("event_date")), out)
    assert _fees(spark, out) == {"20240423": (3, 11), "20240424": (1, 4)}
    assert sorted(os.listdir(os.path.join(out, "day=20240424"))) == day2_files   # untouched


def _rebuild(spark, stored, delivered, paths):
    m = Marts(spark, {"block": stored, "pool": pools_df(spark, ADJ_DAY_POOLS)}, run_ts=RUN_TS, persist_shared=False)
    rebuild_days(m, touched_days(m, delivered), paths)


def test_moved_block_leaves_its_old_day(spark, tmp_dir):
    """A re-delivery that moves a block over midnight equals the full build; an emptied day goes."""
    out = os.path.join(tmp_dir, "moved")
    first = _feed_rows(spark, [*DAY1, (102, "2024-04-24 23:59:59", "beta", "5", 10, 4, 1)], "2024-04-25 00:30:00")
    paths = {"fact.network_stats_1d": f"{out}/network", "fact.block": f"{out}/block"}
    _rebuild(spark, first, first, paths)
    assert _fees(spark, f"{out}/network") == {"20240423": (2, 3), "20240424": (1, 4)}
    late = _feed_rows(spark, [(102, "2024-04-25 00:00:00", "beta", "5", 10, 4, 1)], "2024-04-25 01:00:00")
    stored = first.unionByName(late)
    _rebuild(spark, stored, late, paths)
    assert _fees(spark, f"{out}/network") == {"20240423": (2, 3), "20240425": (1, 4)}
    assert sorted((r.date_id, r.blockheight) for r in spark.read.parquet(f"{out}/block").collect()) == [
        ("20240423", 100), ("20240423", 101), ("20240425", 102)]
    # A later delivery on the day that the block left does not bring it back.
    more = _feed_rows(spark, [(103, "2024-04-24 05:00:00", "beta", "5", 10, 8, 1)], "2024-04-25 02:00:00")
    _rebuild(spark, stored.unionByName(more), more, paths)
    assert _fees(spark, f"{out}/network") == {"20240423": (2, 3), "20240424": (1, 8), "20240425": (1, 4)}


def test_block_moved_out_of_the_calendar(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out_of_calendar")
    first = _feed_rows(spark, DAY1 + DAY2, "2024-04-24 12:00:00")
    _rebuild(spark, first, first, out)
    late = _feed_rows(spark, [(102, "2050-01-01 00:00:00", "beta", "5", 10, 4, 1)], "2050-01-01 01:00:00")
    _rebuild(spark, first.unionByName(late), late, out)
    assert _fees(spark, out) == {"20240423": (2, 3)}


def test_zero_reward_is_null_in_lenient_builds(spark):
    blocks = blocks_df(spark, [(100, "2024-04-23 01:00:00", "alpha", "5", 0, 0, 1)])
    src = {"block": blocks, "pool": pools_df(spark, ADJ_DAY_POOLS)}
    fact = Marts(spark, src, run_ts=RUN_TS, strict=False, persist_shared=False)["fact.block"]
    assert fact.first().reward_tx_fee_pct is None
    with pytest.raises(Exception, match="REMAINDER_BY_ZERO|DIVIDE_BY_ZERO"):
        Marts(spark, src, run_ts=RUN_TS, persist_shared=False)["fact.block"].collect()


def test_stream_folds_late_file(spark, tmp_dir):
    feed = os.path.join(tmp_dir, "feed")
    _feed_rows(spark, DAY1 + DAY2, "2024-04-24 12:00:00").coalesce(1).write.parquet(f"{feed}/1")
    _feed_rows(spark, LATE, "2024-04-25 00:00:00").coalesce(1).write.parquet(f"{feed}/2")
    run_block_feed(spark, f"{feed}/*", os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "fact"),
                   os.path.join(tmp_dir, "ckpt"), run_ts=RUN_TS)
    assert _fees(spark, os.path.join(tmp_dir, "fact")) == {"20240423": (3, 11), "20240424": (1, 4)}
    assert spark.read.schema(FEED_SCHEMA).parquet(os.path.join(tmp_dir, "src")).count() == 4


def test_watermarked_daily_counts_drop_redelivered_copies(spark, tmp_dir):
    from chainstar.streaming.block_feed import block_stream, daily_counts_stream
    feed = os.path.join(tmp_dir, "feed2")
    rows = DAY1 + DAY2
    _feed_rows(spark, rows, "2024-04-24 12:00:00").coalesce(1).write.parquet(f"{feed}/1")
    _feed_rows(spark, DAY1[:1], "2024-04-24 13:00:00").coalesce(1).write.parquet(f"{feed}/2")  # copy
    q = (daily_counts_stream(block_stream(spark, f"{feed}/*", files_per_batch=10))
         .writeStream.format("memory").queryName("daily_counts_test").outputMode("update")
         .option("checkpointLocation", os.path.join(tmp_dir, "ckpt2"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {str(r.day.start)[:10]: r.block_count
           for r in spark.sql("SELECT * FROM daily_counts_test").collect()}
    assert got == {"2024-04-23": 2, "2024-04-24": 1}
