"""K2 and K6 lasting views, E6 counts of a write, E7 final days, S3 quoted empty fields."""

import os

import pytest
from pyspark.sql import functions as F

from chainstar.operators.sinks import write_checked
from chainstar.plans.marts import Marts, build, checked_build
from chainstar.plans.views import READS, create_functions, create_lasting_view, drop_model, recorded_reads
from chainstar.sources import schemas
from chainstar.sources.files import load_csv
from chainstar.sources.schemas import with_loaded_at
from chainstar.streaming.block_feed import FEED_SCHEMA, deliver_final_days, final_days

from fixtures import ADJ_DAY_HASHRATE, RUN_TS, block_rows, sources, ts


def _built(spark, tmp_dir, strict=True, **src):
    m = Marts(spark, sources(spark, **src), run_ts=RUN_TS, strict=strict, persist_shared=False)
    return m, build(m, tmp_dir, use_catalog=True)


def test_views_outlive_the_session(spark, tmp_dir):
    """Strict views equal the models' plans, and a second session of the catalog reads them."""
    _built(spark, tmp_dir)
    m = Marts(spark, sources(spark), run_ts=RUN_TS, persist_shared=False)
    other = spark.newSession()
    for name, n in (("obt.block", 4), ("obt.network_stats_1d", 1), ("obt.pool_stats_1d", 4)):
        want, got = m[name], spark.table(name)
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert other.table(name).count() == n
    assert {v: set(r) for v, r in recorded_reads(spark).items() if v in READS} == {v: set(r) for v, r in READS.items()}


def test_view_is_computed_on_each_read(spark, tmp_dir):
    _built(spark, tmp_dir)
    before = spark.table("obt.network_stats_1d").first().reward_mining_sum_usd
    price = [("2024-04-24", "BTC-USD", "64100.25", "128001.00", "63000.00", "130000.00")]
    build(Marts(spark, sources(spark, price=price), run_ts=RUN_TS, persist_shared=False), f"{tmp_dir}/again",
          ["fact.price_1d"], use_catalog=True)
    assert spark.table("obt.network_stats_1d").first().reward_mining_sum_usd == 2 * before


def test_drop_goes_from_the_readers_down(spark, tmp_dir):
    _built(spark, tmp_dir)
    with pytest.raises(ValueError, match="is read by"):
        drop_model(spark, "fact.price_1d")
    dropped = drop_model(spark, "fact.price_1d", cascade=True)
    assert dropped[-1] == "fact.price_1d" and set(dropped[:-1]) == {"obt.network_stats_1d", "obt.pool_stats_1d"}
    assert spark.catalog.tableExists("obt.block") and not spark.catalog.tableExists("obt.pool_stats_1d")


def test_views_without_an_expected_count(spark, tmp_dir):
    """No reported hashrate: luck is NULL; a reported zero: lenient NULL, strict raises."""
    zero = [("2024-04-24", "alpha", "0"), *ADJ_DAY_HASHRATE[1:]]
    _built(spark, tmp_dir, strict=False, hashrate=zero)
    lenient = {r.pool_key: (r.expected_block_count, r.mining_luck) for r in spark.table("obt.pool_stats_1d").collect()}
    assert lenient["alpha"] == (0, None) and lenient["beta"] == (None, None)
    create_lasting_view(spark, "obt.pool_stats_1d", strict=True)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        spark.table("obt.pool_stats_1d").collect()


@pytest.mark.parametrize("n,d,want", [(5, 2, 3), (-5, 2, -3), (5, -2, -3), (4, 3, 1), (0, 7, 0), (1, 0, None), (10 ** 32, 3, 10 ** 32 // 3)])
def test_round_div(spark, n, d, want):
    create_functions(spark)
    got = spark.sql(f"SELECT obt.round_div(CAST('{n}' AS DECIMAL(38,0)), CAST('{d}' AS DECIMAL(38,0))) AS q").first().q
    assert got == want


def test_checked_write_counts(spark, tmp_dir):
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, None), (None, -1), (None, 5)], "k int, v int")
    got = write_checked(rows, ["k"], ["k", "v"], {"v_positive": F.col("v") > 0}, path=f"{tmp_dir}/t")
    assert got == {"rows": 5, "grain": 2, "null:k": 2, "null:v": 1, "v_positive": 1}
    assert spark.read.parquet(f"{tmp_dir}/t").columns == ["k", "v"] and spark.read.parquet(f"{tmp_dir}/t").count() == 5
    assert write_checked(rows.limit(0), ["k"], ["v"], path=f"{tmp_dir}/empty") == {"rows": 0, "grain": 0, "null:v": 0}


def test_checked_build_finds_the_default_pools_repeats(spark, tmp_dir):
    got = checked_build(Marts(spark, sources(spark), run_ts=RUN_TS, persist_shared=False), tmp_dir)
    assert got["obt.block"]["rows"] == 4 and got["fact.block"] == {
        "rows": 4, "grain": 0, "null:block_id": 0, "reward_is_sum": 0, "tx_count_positive": 0}
    # Two unmatched pools of one day.
    assert got["fact.pool_stats_1d"]["grain"] == 1 and got["dim.pool"]["grain"] == 0


def _delivery(spark, path, rows):
    """Rows of (height, time)."""
    full = [(*r, ts("2024-05-01 00:00:00")) for r in block_rows([(h, at, "p", "5", 10, 1, 1) for h, at in rows])]
    spark.createDataFrame(full, with_loaded_at(schemas.BLOCK)).write.parquet(path)


def test_final_days(spark, tmp_dir):
    feed, base = f"{tmp_dir}/feed", f"{tmp_dir}/out"

    def deliver(name, rows):
        _delivery(spark, f"{feed}/{name}", rows)
        deliver_final_days(spark, f"{feed}/*", base)
        return {str(r.event_date): (r.block_count, r.late_rows) for r in final_days(spark, base).collect()}

    # The mark is 04-23 12:00 afterwards: one day is over, the next two are not.
    first = [(1, "2024-04-22 01:00:00"), (1, "2024-04-22 01:00:00"), (2, "2024-04-23 13:00:00"), (3, "2024-04-24 12:00:00")]
    assert deliver("1", first) == {"2024-04-22": (1, 0)}
    # In time (after the mark, though of an older day), too late (on the mark and before it), and a copy.
    second = [(4, "2024-04-23 12:00:00.001"), (5, "2024-04-23 12:00:00"), (6, "2024-04-22 02:00:00"), (3, "2024-04-24 12:00:00")]
    assert deliver("2", second) == {"2024-04-22": (1, 1), "2024-04-23": (None, 1)}
    aside = spark.read.schema(FEED_SCHEMA).parquet(f"{base}/late")
    assert sorted(r.blockheight for r in aside.collect()) == [5, 6]
    # A later mark makes both days final; nothing new, nothing changes.
    third = [(7, "2024-04-26 00:00:00")]
    assert deliver("3", third) == {"2024-04-22": (1, 1), "2024-04-23": (2, 1), "2024-04-24": (1, 0)}
    deliver_final_days(spark, f"{feed}/*", base)
    assert final_days(spark, base).count() == 3


def test_quoted_empty_field_is_an_empty_text(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pool.csv")
    names = schemas.POOL.names
    with open(path, "w") as f:
        f.write(",".join(names) + "\n")
        f.write('a,"",,true,false\n')
        f.write('b,x,"",,\n')
    got = {r[0]: tuple(r)[1:] for r in load_csv(spark, path, schemas.POOL).collect()}
    assert got == {"a": ("", None, True, False), "b": ("x", "", None, None)}
