"""Registered queries: one per inventory ID, over the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` builds the Spark plan;
``ORACLE[name]`` is the DuckDB SQL that computes the same rows from the same
parquet views.  Models run over whole tables; the only limits are the two
top-k previews (O1, O2), whose order is made total.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainstar import oracle_sql as O
from chainstar.operators.chain import canonical_chain
from chainstar.operators.preview import preview
from chainstar.operators.quality import broken_links, duplicate_keys, orphan_keys, stale_heights
from chainstar.operators.sinks import insert_declared, write_table
from chainstar.plans import dims, extensions, facts, orders_star
from chainstar.plans.marts import GRAIN, RULES, Marts, build, checked_build, descendants
from chainstar.plans.views import READS, create_lasting_view, drop_model
from chainstar.session import checkpoint_dir
from chainstar.sources import schemas
from chainstar.sources.files import load_csv
from chainstar.sources.standins import forked_block_from_events, load_sources, read_table
from chainstar.streaming.block_feed import deliver_final_days, final_days, run_block_feed

# The run timestamp of registered builds (audit column of rows whose source
# has no load time); a literal keeps reruns repeatable.
RUN_TS = "2024-02-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    """Registered builds are lenient: luck past decimal(12,9) is kept in a wider type.
    Nothing stays cached after a query."""
    return Marts(spark, load_sources(spark, sf_dir), run_ts=RUN_TS, strict=False, persist_shared=False)


# -- sources (S1-S4 stand-ins) ---------------------------------------------------------

@register("s1_block_source", O.select_from("src_block"))
def s1_block_source(spark, sf_dir):
    return load_sources(spark, sf_dir)["block"]


@register("s2_hashrate_source", O.select_from("src_hashrate"))
def s2_hashrate_source(spark, sf_dir):
    return load_sources(spark, sf_dir)["hashrate"]


@register("s3_pool_source", O.select_from("src_pool"))
def s3_pool_source(spark, sf_dir):
    return load_sources(spark, sf_dir)["pool"]


@register("s4_price_source", O.select_from("src_price"))
def s4_price_source(spark, sf_dir):
    return load_sources(spark, sf_dir)["price"]


# -- calendar (R6, C1-C28) ---------------------------------------------------------------

@register("c_calendar", f"""SELECT {O.calendar_select('d')}
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)""")
def c_calendar(spark, sf_dir):
    """Calendar attributes of every ship date in ``lineitem``."""
    return dims.calendar_of(read_table(spark, sf_dir, "lineitem"), "l_shipdate")


# -- staging and dedupe (R1, A1, R2 / W1, W2) ----------------------------------------------

@register("r1_stage", O.select_from("staged_block"))
def r1_stage(spark, sf_dir):
    return dims.stage_blocks(load_sources(spark, sf_dir)["block"], RUN_TS)


@register("a1_select_distinct", O.with_ctes("staged_block") + "SELECT DISTINCT * FROM staged_block")
def a1_select_distinct(spark, sf_dir):
    return dims.stage_blocks(load_sources(spark, sf_dir)["block"], RUN_TS, distinct=True)


@register("w1_dedupe_latest", O.select_from("blocks"))
def w1_dedupe_latest(spark, sf_dir):
    return dims.staged_blocks(load_sources(spark, sf_dir)["block"], RUN_TS)


@register("w2_dedupe_two_keys", O.with_ctes("hashrate") + "SELECT * FROM hr_latest")
def w2_dedupe_two_keys(spark, sf_dir):
    return facts.staged_hashrate(load_sources(spark, sf_dir)["hashrate"])


# -- the ten models (R13) ----------------------------------------------------------------------

@register("m_dim_pool", O.select_from("dim_pool"))
def m_dim_pool(spark, sf_dir):
    return marts(spark, sf_dir)["dim.pool"]


@register("m_dim_block", O.select_from("dim_block"))
def m_dim_block(spark, sf_dir):
    return marts(spark, sf_dir)["dim.block"]


@register("m_fact_price_1d", O.select_from("fact_price"))
def m_fact_price_1d(spark, sf_dir):
    return marts(spark, sf_dir)["fact.price_1d"]


@register("m_fact_block", O.select_from("fact_block"))
def m_fact_block(spark, sf_dir):
    return marts(spark, sf_dir)["fact.block"]


@register("m_fact_network_stats_1d", O.select_from("fact_network"))
def m_fact_network_stats_1d(spark, sf_dir):
    return marts(spark, sf_dir)["fact.network_stats_1d"]


@register("m_fact_pool_stats_1d", O.select_from("fact_pool"))
def m_fact_pool_stats_1d(spark, sf_dir):
    return marts(spark, sf_dir)["fact.pool_stats_1d"]


@register("m_obt_block", O.select_from("obt_block"))
def m_obt_block(spark, sf_dir):
    return marts(spark, sf_dir)["obt.block"]


@register("m_obt_network_stats_1d", O.select_from("obt_network"))
def m_obt_network_stats_1d(spark, sf_dir):
    return marts(spark, sf_dir)["obt.network_stats_1d"]


@register("m_obt_pool_stats_1d", O.select_from("obt_pool"))
def m_obt_pool_stats_1d(spark, sf_dir):
    return marts(spark, sf_dir)["obt.pool_stats_1d"]


# -- operators shown on their own ------------------------------------------------------------

@register("a3_pool_day", O.with_ctes("pool_agg") + "SELECT * FROM pool_agg")
def a3_pool_day(spark, sf_dir):
    return facts.daily_pool_aggregate(marts(spark, sf_dir).blocks)


@register("a4_reaggregate", O.with_ctes("pool_net") + "SELECT * FROM pool_net")
def a4_reaggregate(spark, sf_dir):
    return facts.network_from_pools(facts.daily_pool_aggregate(marts(spark, sf_dir).blocks))


@register("j9_regime_weighted_avg", O.with_ctes("net_agg", "changes").rstrip("\n") + f""",
weighted_days AS (
  SELECT a.event_date, CAST(a.difficulty_first AS DECIMAL(30,9)) AS difficulty_first,
         CAST(a.difficulty_last AS DECIMAL(30,9)) AS difficulty_last,
         {O.weighted('a.difficulty_first', 'c.area', 'c.t_first')} AS difficulty_weighted_avg
  FROM net_agg a LEFT JOIN chg_day c USING (event_date))
SELECT * FROM weighted_days""")
def j9_regime_weighted_avg(spark, sf_dir):
    cube = facts.block_cube(marts(spark, sf_dir).blocks)
    daily = facts.with_weighted_difficulty(facts.adjustments(cube),
                                           facts.network_day(facts.pool_day(cube)))
    return daily.select("event_date", "difficulty_first", "difficulty_last",
                        "difficulty_weighted_avg")


@register("o1_topk_preview", O.select_from("fact_block", body=(
    "SELECT * FROM fact_block ORDER BY blockheight ASC NULLS LAST LIMIT 1000")))
def o1_topk_preview(spark, sf_dir):
    return preview(marts(spark, sf_dir)["fact.block"], ["blockheight"])


@register("o2_topk_mixed", O.select_from("obt_pool", body=(
    "SELECT * FROM obt_pool ORDER BY event_date ASC NULLS LAST, block_count DESC NULLS FIRST, "
    "pool_name ASC NULLS LAST, blockheight_first ASC NULLS LAST LIMIT 1000")))
def o2_topk_mixed(spark, sf_dir):
    """The pool OBT preview; ``blockheight_first`` makes the order total."""
    return preview(marts(spark, sf_dir)["obt.pool_stats_1d"],
                   ["event_date", "-block_count", "pool_name", "blockheight_first"])


@register("e6_grain_duplicates", O.select_from("fact_pool", body=(
    "SELECT date_id, pool_id, count(*) AS row_count FROM fact_pool "
    "GROUP BY date_id, pool_id HAVING count(*) > 1")))
def e6_grain_duplicates(spark, sf_dir):
    """Rows sharing (date_id, pool_id): the unmatched pools of a day."""
    return duplicate_keys(marts(spark, sf_dir)["fact.pool_stats_1d"], ["date_id", "pool_id"])


def _forked(spark, sf_dir, on_chain=False):
    """Models over blocks with forks and gaps; ``on_chain`` leaves stale blocks out of them."""
    src = load_sources(spark, sf_dir) | {"block": forked_block_from_events(read_table(spark, sf_dir, "events"))}
    return Marts(spark, src, run_ts=RUN_TS, strict=False, persist_shared=False,
                 chain_path=_scratch(spark, "chain") if on_chain else None)


@register("e2_broken_links", O.forked(O.select_from("blocks", body=(
    "SELECT * FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM blocks p WHERE p.block_key = b.prev_block_hash) "
    "AND b.blockheight > (SELECT min(blockheight) FROM blocks)"))))
def e2_broken_links(spark, sf_dir):
    """Blocks whose parent is missing."""
    return broken_links(_forked(spark, sf_dir).blocks)


@register("e2_stale_heights", O.forked(O.select_from("blocks", body=(
    "SELECT blockheight, count(*) AS block_count, min(block_key) AS first_key, "
    "max(block_key) AS last_key FROM blocks GROUP BY blockheight HAVING count(*) > 1"))))
def e2_stale_heights(spark, sf_dir):
    """Heights with competing blocks."""
    return stale_heights(_forked(spark, sf_dir).blocks)


@register("e2_canonical_chain", O.on_chain(O.select_from("blocks", body=(
    "SELECT block_key, prev_block_hash, blockheight, block_key IN (SELECT block_key FROM chain) AS is_canonical "
    "FROM all_blocks"))))
def e2_canonical_chain(spark, sf_dir):
    """Every block, and whether it is on the longest branch of its fork."""
    path = _scratch(spark, "chain")
    blocks = _forked(spark, sf_dir).blocks
    write_table(blocks, path=f"{path}/blocks")
    got = canonical_chain(spark.read.schema(blocks.schema).parquet(f"{path}/blocks"), path)
    return got.select("block_key", "prev_block_hash", "blockheight", "is_canonical")


@register("e2_network_on_chain", O.on_chain(O.select_from("fact_network")))
def e2_network_on_chain(spark, sf_dir):
    """The daily network fact without stale blocks."""
    return _forked(spark, sf_dir, on_chain=True)["fact.network_stats_1d"]


@register("e2_network_with_forks", O.forked(O.select_from("fact_network")))
def e2_network_with_forks(spark, sf_dir):
    """R7, R8 over competing heights: nothing fans out, adjustments of one height count once."""
    return _forked(spark, sf_dir)["fact.network_stats_1d"]


def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/chainstar/{name}/{uuid.uuid4().hex}"


# -- extensions (E1, E3, E4, E5, E7) ----------------------------------------------------------

@register("e3_difficulty_epochs", O.epoch_summary("difficulty_epoch"))
def e3_difficulty_epochs(spark, sf_dir):
    return extensions.epoch_summary(marts(spark, sf_dir)["obt.block"], "difficulty_epoch")


@register("e3_subsidy_epochs", O.epoch_summary("subsidy_epoch"))
def e3_subsidy_epochs(spark, sf_dir):
    return extensions.epoch_summary(marts(spark, sf_dir)["obt.block"], "subsidy_epoch")


@register("e4_pool_alltime", O.POOL_SUMMARY)
def e4_pool_alltime(spark, sf_dir):
    return extensions.pool_summary(marts(spark, sf_dir)["obt.block"])


@register("e5_luck_model", O.luck_model(extensions.TRAILING_DAYS))
def e5_luck_model(spark, sf_dir):
    return extensions.luck_model(marts(spark, sf_dir)["obt.pool_stats_1d"])


def _deliveries(block):
    """The blocks as two deliveries: what the second brings again was dated a day too early in the first."""
    late = block.filter(F.col("loaded_at") != F.col("timestamp"))
    again = late.select("block_hash").distinct().withColumn("again", F.lit(True))
    early = F.col("timestamp") - F.when(F.col("again"), F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    first = (block.filter(F.col("loaded_at") == F.col("timestamp")).join(again, "block_hash", "left")
             .withColumn("timestamp", early).select(*block.columns))
    return first, late


def _incremental(spark, sf_dir, model):
    """Build ``model`` from the first delivery of each block, then fold in
    the re-deliveries, which move blocks to other days, by rebuilding only the
    days they touch (key-to-day index, dynamic partition overwrite, emptied days
    removed); read the table back.  It equals the full build."""
    base = _scratch(spark, "k7")
    src = load_sources(spark, sf_dir)
    feed = extensions.BlockFeed(spark, f"{base}/src_block", {model: f"{base}/fact"},
                                {k: v for k, v in src.items() if k != "block"}, run_ts=RUN_TS, strict=False)
    for number, rows in enumerate(_deliveries(src["block"])):
        feed.deliver(rows, number)
    return spark.read.parquet(f"{base}/fact").drop("day")


@register("k7_incremental_network", O.select_from("fact_network"))
def k7_incremental_network(spark, sf_dir):
    return _incremental(spark, sf_dir, "fact.network_stats_1d")


@register("k7_incremental_pool", O.select_from("fact_pool"))
def k7_incremental_pool(spark, sf_dir):
    return _incremental(spark, sf_dir, "fact.pool_stats_1d")


@register("k7_incremental_block", O.select_from("fact_block"))
def k7_incremental_block(spark, sf_dir):
    return _incremental(spark, sf_dir, "fact.block")


@register("k7_incremental_price", O.select_from("fact_price"))
def k7_incremental_price(spark, sf_dir):
    """Daily prices first come without their close, an hour early; the whole rows then replace them."""
    out = _scratch(spark, "k7")
    src = load_sources(spark, sf_dir)
    first = src["price"].withColumns({"price_close": F.col("price_open"),
                                      "loaded_at": F.col("loaded_at") - F.expr("INTERVAL 1 HOUR")})
    days = src["price"].select(F.col("date").alias("event_date"))
    for price in (first, first.unionByName(src["price"])):
        m = Marts(spark, src | {"price": price}, run_ts=RUN_TS, strict=False, persist_shared=False)
        extensions.rebuild_days(m, days, {"fact.price_1d": out})
    return spark.read.parquet(out).drop("day")


@register("e7_stream_network_1d", O.select_from("fact_network"))
def e7_stream_network_1d(spark, sf_dir):
    """The blocks arrive as a feed of files, first deliveries then the late
    re-deliveries; a Structured Streaming query folds each file into the daily
    network fact (late rows rebuild the days they touch, those they leave included)."""
    base = _scratch(spark, "e7")
    for folder, rows in zip(("1-first", "2-late"), _deliveries(load_sources(spark, sf_dir)["block"])):
        rows.write.parquet(f"{base}/feed/{folder}")
        # The second run goes on from the first one's checkpoint: the late rows come in batches of their own.
        run_block_feed(spark, f"{base}/feed/*", f"{base}/src_block", f"{base}/fact",
                       f"{base}/checkpoint", run_ts=RUN_TS, files_per_batch=256)
    return spark.read.parquet(f"{base}/fact").drop("day")


@register("e7_final_days", O.FINAL_DAYS)
def e7_final_days(spark, sf_dir):
    """Two deliveries; days past the watermark are final, written once in append mode, and rows too late
    for them are kept aside.  (Re-deliveries in time are copies of blocks already counted.)"""
    base = _scratch(spark, "e7f")
    for folder, rows in zip(("1-first", "2-late"), _deliveries(load_sources(spark, sf_dir)["block"])):
        rows.write.parquet(f"{base}/feed/{folder}")
        deliver_final_days(spark, f"{base}/feed/*", base)
    return final_days(spark, base)


# -- written and read back (K1, K3, S1-S4 and S8 as CSV, E6) -----------------------------------

@register("k1_built_network", O.select_from("fact_network"))
def k1_built_network(spark, sf_dir):
    """K1, K5: the daily network fact as a table of the DAG build."""
    name = "fact.network_stats_1d"
    return build(marts(spark, sf_dir), _scratch(spark, "k1"), [name])[name]


@register("k4_declared_calendar", f"""SELECT {O.calendar_select('d')}
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)""")
def k4_declared_calendar(spark, sf_dir):
    """K4, K5: the ship dates' calendar inserted into a declared table of the ``dim`` schema and read back."""
    columns = [(c, kind, True) for c, kind in dims.CALENDAR_TYPES.items()]
    return insert_declared(c_calendar(spark, sf_dir), f"dim.ship_date_{uuid.uuid4().hex}", columns, _scratch(spark, "k4"))


@register("j3_obt_block_bucketed", O.select_from("obt_block"))
def j3_obt_block_bucketed(spark, sf_dir):
    """``obt.block`` over both block tables written bucketed by ``block_id``: their join shuffles nothing."""
    m = marts(spark, sf_dir)
    build(m, _scratch(spark, "j3"), ["dim.pool", "dim.block", "fact.block"], block_buckets=16, use_catalog=True)
    return m["obt.block"]


@register("k7_pruned_weekends", O.select_from("fact_block", body=(
    "SELECT f.* FROM fact_block f JOIN calendar d USING (date_id) WHERE d.is_weekend")))
def k7_pruned_weekends(spark, sf_dir):
    """K7: ``fact.block`` by day; the weekends' files alone are read, chosen at run time from ``dim.date``."""
    path = _scratch(spark, "k7")
    m = marts(spark, sf_dir)
    write_table(m["fact.block"].withColumn("day", F.col("date_id")), path=path, partition_by=["day"],
                sort_within=["day", "blockheight"])
    days = m["dim.date"].filter("is_weekend").select(F.col("date_id").alias("day"))
    fact = spark.read.schema(m["fact.block"].schema.add("day", "string")).parquet(path)
    return fact.join(F.broadcast(days), "day").drop("day")


@register("k3_built_obt_pool", O.select_from("obt_pool"))
def k3_built_obt_pool(spark, sf_dir):
    """The pool OBT written after the facts it reads, each read back."""
    names = ["dim.pool", "fact.price_1d", "fact.network_stats_1d", "fact.pool_stats_1d", "obt.pool_stats_1d"]
    return build(marts(spark, sf_dir), _scratch(spark, "k3"), names, obt_as_view=False)[names[-1]]


def _lasting(spark, sf_dir, *names):
    """K1, K2: the tables that the views ``names`` read, written to the catalog, and the views."""
    tables = {t for name in names for t in READS[name]}
    build(marts(spark, sf_dir), _scratch(spark, "k2"), tables, use_catalog=True)
    for name in names:
        create_lasting_view(spark, name, strict=False)


@register("k2_view_obt_block", O.select_from("obt_block"))
def k2_view_obt_block(spark, sf_dir):
    """K2, K5: ``obt.block`` as a lasting view of the catalog."""
    _lasting(spark, sf_dir, "obt.block")
    return spark.table("obt.block")


@register("k2_view_obt_network", O.select_from("obt_network"))
def k2_view_obt_network(spark, sf_dir):
    """K2: ``obt.network_stats_1d`` as a lasting view, its measures computed on each read."""
    _lasting(spark, sf_dir, "obt.network_stats_1d")
    return spark.table("obt.network_stats_1d")


@register("k6_view_obt_pool", O.select_from("obt_pool"))
def k6_view_obt_pool(spark, sf_dir):
    """K2, K6: ``fact.price_1d`` is dropped with the views that read it, written again, and they are
    made anew; ``obt.pool_stats_1d`` is read."""
    _lasting(spark, sf_dir, "obt.network_stats_1d", "obt.pool_stats_1d")
    dropped = drop_model(spark, "fact.price_1d", cascade=True)
    build(marts(spark, sf_dir), _scratch(spark, "k6"), ["fact.price_1d"], use_catalog=True)
    for view in dropped[:-1]:
        create_lasting_view(spark, view, strict=False)
    return spark.table("obt.pool_stats_1d")


@register("e6_checked_writes", O.checked_writes(GRAIN, RULES))
def e6_checked_writes(spark, sf_dir):
    """Rows written of every model and how many break each of its rules, observed during the writes
    (G10: the default pool's rows repeat the stated grain of the pool tables)."""
    counts = checked_build(marts(spark, sf_dir), _scratch(spark, "e6"))
    rows = [(model, rule, n) for model, found in counts.items() for rule, n in found.items()]
    return spark.createDataFrame(rows, "model string, rule string, row_count long")


@register("k6_rebuild_after_price", O.select_from("obt_network"))
def k6_rebuild_after_price(spark, sf_dir):
    """K6: what a new price source makes stale is rebuilt, in DAG order, and read back."""
    return build(marts(spark, sf_dir), _scratch(spark, "k6"), descendants(["src.price"]),
                 obt_as_view=False)["obt.network_stats_1d"]


def _csv(spark, sf_dir, name):
    """The stand-in source as CSV in the shared folder, loaded strictly (typed, not-null columns checked)."""
    path, schema = _scratch(spark, "csv"), schemas.SOURCES[name]
    (load_sources(spark, sf_dir)[name].select(*schema.names).write.option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return load_csv(spark, path, schema)


def _register_csv(name: str, query: str) -> None:
    rel = f"src_{name}"
    register(query, O.select_from(rel, body=f"SELECT * EXCLUDE (loaded_at) FROM {rel}"))(
        lambda spark, sf_dir: _csv(spark, sf_dir, name))


for _i, _name in enumerate(("block", "hashrate", "pool", "price"), 1):
    _register_csv(_name, f"s{_i}_csv_{_name}")


@register("e6_orphan_pools", O.with_ctes("blocks", "dim_pool") + (
    "SELECT * FROM blocks b WHERE NOT EXISTS (SELECT 1 FROM dim_pool p WHERE p.pool_key = b.pool_key)"))
def e6_orphan_pools(spark, sf_dir):
    """Blocks whose pool has no row in the pool dimension."""
    m = marts(spark, sf_dir)
    return orphan_keys(m.blocks, m["dim.pool"], "pool_key")


# -- second star (order lines) ----------------------------------------------------------------

def _orders(spark, sf_dir):
    lines = orders_star.lineitem_latest(read_table(spark, sf_dir, "lineitem"))
    parts = orders_star.dim_part(read_table(spark, sf_dir, "part"))
    sups = orders_star.dim_supplier(read_table(spark, sf_dir, "supplier"))
    return lines, parts, sups


@register("g_lineitem_latest", O.with_ctes("orders_star") + "SELECT * FROM li_latest")
def g_lineitem_latest(spark, sf_dir):
    return _orders(spark, sf_dir)[0]


@register("g_dim_part", O.with_ctes("orders_star") + "SELECT * FROM dim_part")
def g_dim_part(spark, sf_dir):
    return _orders(spark, sf_dir)[1]


@register("g_fact_lineitem", O.with_ctes("orders_star") + "SELECT * FROM fact_li")
def g_fact_lineitem(spark, sf_dir):
    lines, parts, sups = _orders(spark, sf_dir)
    return orders_star.fact_lineitem(lines, dims.calendar(spark), parts, sups)


@register("g_sales_daily", O.SALES_DAILY)
def g_sales_daily(spark, sf_dir):
    lines, parts, sups = _orders(spark, sf_dir)
    return orders_star.sales_daily(orders_star.fact_lineitem(lines, dims.calendar(spark), parts, sups))


# -- single operators, as named in the build plan (projections of the models) ----------------

def _proj(rel: str, cols: str, where: str = "") -> str:
    return O.select_from(rel, body=f"SELECT {cols} FROM {rel} {where}")


@register("x1_surrogate_key", _proj("dim_block", "block_key, block_id", "WHERE block_id <> '0'"))
def x1_surrogate_key(spark, sf_dir):
    """md5 surrogate ids of every block key."""
    return marts(spark, sf_dir)["dim.block"].filter(F.col("block_id") != "0") \
        .select("block_key", "block_id")


@register("j2_resolve_fk", _proj("fact_block", "blockheight, pool_id"))
def j2_resolve_fk(spark, sf_dir):
    """Pool id of every block; unmatched pools resolve to '0'."""
    return marts(spark, sf_dir)["fact.block"].select("blockheight", "pool_id")


@register("j10_two_key_left", _proj("fact_pool", "date_id, pool_id, blockheight_first, reported_hashrate"))
def j10_two_key_left(spark, sf_dir):
    """Reported hashrate joined on (day, pool), NULL where none is reported."""
    return marts(spark, sf_dir)["fact.pool_stats_1d"].select(
        "date_id", "pool_id", "blockheight_first", "reported_hashrate")


@register("d10_estimated_hashrate", _proj(
    "fact_network", "date_id, estimated_hashrate, estimated_hashrate_th, estimated_hashrate_ph, "
    "estimated_hashrate_eh"))
def d10_estimated_hashrate(spark, sf_dir):
    return marts(spark, sf_dir)["fact.network_stats_1d"].select(
        "date_id", "estimated_hashrate", "estimated_hashrate_th", "estimated_hashrate_ph",
        "estimated_hashrate_eh")


@register("d14_hashvalue", _proj("obt_network", "date_id, hashvalue_sat_th, hashvalue_sat_ph"))
def d14_hashvalue(spark, sf_dir):
    return marts(spark, sf_dir)["obt.network_stats_1d"].select(
        "date_id", "hashvalue_sat_th", "hashvalue_sat_ph")


@register("d15_hashprice", _proj("obt_network", "date_id, hashprice_usd_th, hashprice_usd_ph"))
def d15_hashprice(spark, sf_dir):
    return marts(spark, sf_dir)["obt.network_stats_1d"].select(
        "date_id", "hashprice_usd_th", "hashprice_usd_ph")


@register("d19_mining_luck", _proj(
    "obt_pool", "date_id, pool_id, blockheight_first, expected_block_count, block_count_diff, "
    "block_count_diff_pct, mining_luck"))
def d19_mining_luck(spark, sf_dir):
    return marts(spark, sf_dir)["obt.pool_stats_1d"].select(
        "date_id", "pool_id", "blockheight_first", "expected_block_count", "block_count_diff",
        "block_count_diff_pct", "mining_luck")
