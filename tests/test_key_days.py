"""The key-to-day index and the feed that uses it: exact, and reads no more than it says."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from chainstar.operators.key_days import KeyDays
from chainstar.plans.extensions import BlockFeed

from fixtures import ADJ_DAY_POOLS, RUN_TS, blocks_df, d, pools_df


def _held(spark, rows):
    return spark.createDataFrame([(k, d(day) if day else None) for k, day in rows], "key string, event_date date")


def _days(df):
    return sorted(str(r[0]) for r in df.collect())


def test_index_finds_former_and_shared_days(spark, tmp_dir):
    index = KeyDays(spark, f"{tmp_dir}/index", buckets=4)
    assert _days(index.add(_held(spark, [("a", "2024-01-01"), ("b", "2024-01-02"), ("a", "2024-01-01"), (None, "2024-01-09")]),
                           0)) == ["2024-01-01", "2024-01-02"]
    assert _days(index.add(_held(spark, [("a", "2024-01-05"), ("c", "2024-01-06")]), 1)) == [
        "2024-01-01", "2024-01-05", "2024-01-06"]
    # The same delivery again: the same answer, nothing twice.
    assert _days(index.add(_held(spark, [("a", "2024-01-05"), ("c", "2024-01-06")]), 1)) == [
        "2024-01-01", "2024-01-05", "2024-01-06"]
    assert index._keys().count() == 4
    day = spark.createDataFrame([(d("2024-01-05"),)], "event_date date")
    assert _days(index.near(day)) == ["2024-01-01", "2024-01-05"]
    # A key on three days, and one without a day.
    assert _days(index.add(_held(spark, [("a", "2024-01-08"), ("b", None)]), 2)) == [
        "2024-01-01", "2024-01-02", "2024-01-05", "2024-01-08", "None"]
    assert _days(index.near(day)) == ["2024-01-01", "2024-01-05", "2024-01-08"]
    small = index.compacted(f"{tmp_dir}/compacted")
    assert _days(small.near(day)) == ["2024-01-01", "2024-01-05", "2024-01-08"]
    assert _days(small.add(_held(spark, [("c", "2024-01-09")]), 3)) == ["2024-01-06", "2024-01-09"]


def _rows(spark, rows, loaded):
    return blocks_df(spark, rows).withColumn("loaded_at", F.lit(loaded).cast("timestamp_ntz"))


FIRST = [(100 + k, f"2024-04-{20 + k} 01:00:00", "alpha", "5", 10, k + 1, 1) for k in range(8)]


def _feed(spark, tmp_dir):
    return BlockFeed(spark, f"{tmp_dir}/src", {"fact.network_stats_1d": f"{tmp_dir}/network", "fact.block": f"{tmp_dir}/block"},
                     {"pool": pools_df(spark, ADJ_DAY_POOLS)}, run_ts=RUN_TS)


def _spoil(files):
    for f in files:
        with open(f, "wb") as out:
            out.write(b"not parquet")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_delivery_reads_no_other_day_and_no_other_bucket(spark, tmp_dir):
    """Files that a delivery must not read are made unreadable."""
    feed = _feed(spark, tmp_dir)
    feed.deliver(_rows(spark, FIRST, "2024-05-01 00:00:00"), 0)
    late = _rows(spark, [(103, "2024-04-26 09:00:00", "beta", "5", 10, 50, 1)], "2024-05-02 00:00:00")   # was on the 23rd
    key = spark.createDataFrame([("h103", d("2024-04-26"))], "key string, event_date date")
    bucket = feed.index._numbered(key).first().bucket
    needed = [f"/day=2024-04-{n}/" for n in (23, 26)]
    others = [f for f in glob.glob(f"{tmp_dir}/src/**/*.parquet", recursive=True) if not any(n in f for n in needed)]
    buckets = [f for f in glob.glob(f"{tmp_dir}/src_index/keys/**/*.parquet", recursive=True) if f"/bucket={bucket}/" not in f]
    assert len(others) == 6 and buckets
    _spoil(others + buckets)
    feed.deliver(late, 1)
    got = {r.date_id: (r.block_count, r.reward_tx_fee_sum) for r in spark.read.parquet(f"{tmp_dir}/network").collect()}
    assert got["20240426"] == (2, 57) and "20240423" not in got and len(got) == 7
    assert sorted((r.date_id, r.blockheight) for r in spark.read.parquet(f"{tmp_dir}/block").collect())[5:7] == [
        ("20240426", 103), ("20240426", 106)]
    with pytest.raises(Exception):      # the guard works: a full read meets a spoiled file
        spark.read.schema("blockheight int").parquet(f"{tmp_dir}/src").agg(F.sum("blockheight")).collect()


def test_repeated_delivery_changes_nothing(spark, tmp_dir):
    feed = _feed(spark, tmp_dir)
    late = [(103, "2024-04-26 09:00:00", "beta", "5", 10, 50, 1), (103, "2024-04-27 09:00:00", "beta", "5", 10, 60, 1)]
    feed.deliver(_rows(spark, FIRST, "2024-05-01 00:00:00"), 0)
    results = []
    for _ in range(2):
        feed.deliver(_rows(spark, late, "2024-05-02 00:00:00"), 1)
        results.append(sorted((r.date_id, r.block_count, r.reward_tx_fee_sum)
                              for r in spark.read.parquet(f"{tmp_dir}/network").collect()))
    assert results[0] == results[1] and len(results[0]) == 7
