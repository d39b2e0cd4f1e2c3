"""Source tables derived from the driver's tables.

The driver's data has no blocks, pools, prices or pool hashrates, so the
four sources are derived from it with Spark; their size grows with the
driver's tables:

* ``block``    <- ``events``: one block per event (height = event id, as far as an int goes, pool
  = the event's user), plus re-delivered and duplicated rows for keep-latest
  dedupe;
* ``pool``     <- ``supplier`` x ``nation`` x ``region``: one pool per
  supplier.  There are 1.5 users per supplier, so a third of the block pools
  have no pool row and resolve to the default member (G10), one hot key;
* ``price``    <- ``events``: daily open/close/low/high per event type,
  ``purchase`` is the ``BTC-USD`` ticker;
* ``hashrate`` <- ``events`` x ``supplier``: a reported daily hashrate per
  matched pool.

Every column has the type of the reference's source schema plus an audit
column ``loaded_at`` (the models order keep-latest by it).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from chainstar.functions.epochs import halving_level
from chainstar.session import session_key

# Fixed parameters of the stand-in mapping (shared with the oracle SQL).
BLOCK_PREFIX = "blk"         # block_hash = 'blk' || event_id, its parent the event before
RIVAL_PREFIX = "riv"         # block_hash of a competing block
POOL_PREFIX = "pool-"        # pool_key = 'pool-' || user_id (blocks), || s_suppkey (pools)
DIFFICULTY_BASE = 1000       # difficulty = (1000 + 37 * (event_id div 2016)) * 10^9
DIFFICULTY_STEP = 37
DIFFICULTY_EPOCH = 2016
DIFFICULTY_UNIT = 10 ** 9
HEIGHTS = 2147483647         # blockheight = event_id modulo this: a height is an int
SUBSIDY_EPOCH = 4000         # subsidy halves every 4000 events
REDELIVERED_TYPE = "error"   # re-sent an hour later with tx_count + 1
DUPLICATED_TYPE = "signup"   # sent twice, identical
PRICE_TICKER = "BTC-USD"     # ticker of event_type 'purchase'
PRICE_EVENT_TYPE = "purchase"
HASHRATE_UNIT = 10 ** 13     # hashrate = 10^13 * sum of the pool-day's value cents
POOL_LOADED_AT = "2024-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def block_from_events(events: DataFrame, block_hash: Column | None = None, prev: Column | None = None) -> DataFrame:
    """``src.block`` stand-in with ``loaded_at``.

    One scan of ``events``: each event yields its first delivery, plus a
    re-delivery an hour later (``error`` events, tx_count + 1) or an exact
    second copy (``signup`` events), generated with ``explode``.  ``block_hash`` and
    ``prev`` replace the hashes of the plain chain.
    """
    if block_hash is None:
        block_hash, prev = _named(BLOCK_PREFIX), _named(BLOCK_PREFIX, -1)
    copies = (F.when(F.col("event_type") == REDELIVERED_TYPE, F.array(F.lit(0), F.lit(1)))
              .when(F.col("event_type") == DUPLICATED_TYPE, F.array(F.lit(0), F.lit(2)))
              .otherwise(F.array(F.lit(0))))
    e = events.select("event_id", "ts", "user_id", "value", block_hash.alias("__hash"), prev.alias("__prev"),
                      F.explode(copies).alias("__copy"))
    redelivered = F.col("__copy") == 1
    tx_count = F.pmod(F.col("user_id"), F.lit(7)) + 1
    return e.select(
        F.pmod(F.col("event_id"), F.lit(HEIGHTS)).cast("int").alias("blockheight"),
        F.col("__hash").alias("block_hash"),
        F.col("__prev").alias("prev_block_hash"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit(POOL_PREFIX), F.col("user_id").cast("string")).alias("pool_key"),
        ((F.lit(DIFFICULTY_BASE) + F.lit(DIFFICULTY_STEP)
          * F.floor(F.col("event_id") / F.lit(DIFFICULTY_EPOCH))).cast(DecimalType(20, 0))
         * F.lit(Decimal(DIFFICULTY_UNIT))).cast(DecimalType(30, 7)).alias("difficulty"),
        halving_level(F.floor(F.col("event_id") / F.lit(SUBSIDY_EPOCH)).cast("int") + 1)
        .alias("reward_subsidy"),
        F.round(F.col("value") * 100).cast("long").alias("reward_tx_fee_sum"),
        F.when(redelivered, tx_count + 1).otherwise(tx_count).cast("int").alias("tx_count"),
        F.when(redelivered, F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))
        .alias("loaded_at"),
    )


def _named(prefix: str, step: int = 0) -> Column:
    return F.concat(F.lit(prefix), (F.col("event_id") + step).cast("string"))


def forked_block_from_events(events: DataFrame) -> DataFrame:
    """``src.block`` with competing and missing blocks.

    * every ``error`` event also has a rival block a minute later, on the rival of
      the event before if that is an ``error`` event too, else on the same parent;
    * the first other event after two or more such events builds on the rivals, so
      their branch is the longer one; after a single one the rival is stale;
    * the third of three ``signup`` events in a row, and any further, is missing.
    """
    kind = events.select("event_id", "event_type")
    e = events
    for k in (1, 2):
        before = kind.select((F.col("event_id") + k).alias("event_id"), F.col("event_type").alias(f"type_{k}"))
        e = e.join(before, "event_id", "left")

    def fork(c: str) -> Column:
        return F.coalesce(F.col(c) == REDELIVERED_TYPE, F.lit(False))

    lost = F.lit(True)
    for c in ("event_type", "type_1", "type_2"):
        lost = lost & F.coalesce(F.col(c) == DUPLICATED_TYPE, F.lit(False))
    own, rival = _named(BLOCK_PREFIX, -1), _named(RIVAL_PREFIX, -1)
    main = block_from_events(e.filter(~lost), _named(BLOCK_PREFIX), F.when(
        fork("type_1") & fork("type_2") & ~fork("event_type"), rival).otherwise(own))
    late = e.filter(fork("event_type")).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
    return main.unionByName(block_from_events(late, _named(RIVAL_PREFIX), F.when(fork("type_1"), rival).otherwise(own)))


def pool_from_suppliers(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """``src.pool`` stand-in: a pool per supplier, flags from its region.

    Suppliers with a negative balance arrive with a blank-padded name (the
    staging trims it); African pools have no URL; Middle-Eastern pools leave
    the template flag unknown.  The nation and region tables are tiny and
    fixed, so they are broadcast.
    """
    geo = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"], "left") \
        .select("n_nationkey", "n_name", "r_name")
    s = supplier.join(F.broadcast(geo), supplier["s_nationkey"] == geo["n_nationkey"], "left")
    return s.select(
        F.concat(F.lit(POOL_PREFIX), F.col("s_suppkey").cast("string")).alias("pool_key"),
        F.when(F.col("s_acctbal") < 0, F.concat(F.lit(" "), F.col("s_name")))
        .otherwise(F.col("s_name")).alias("pool_name"),
        F.when(F.col("r_name") == "AFRICA", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("https://"), F.lower(F.col("n_name")), F.lit(".pool/"),
                            F.col("s_suppkey").cast("string"))).alias("pool_url"),
        (F.col("r_name") == "AMERICA").alias("is_antpool_friend_custodian"),
        F.when(F.col("r_name") == "MIDDLE EAST", F.lit(None).cast("boolean"))
        .otherwise(F.col("s_acctbal") > 5000).alias("is_antpool_friend_template"),
        F.lit(POOL_LOADED_AT).cast("timestamp_ntz").alias("loaded_at"),
    )


def price_from_events(events: DataFrame) -> DataFrame:
    """``src.price`` stand-in: daily OHLC of ``value`` per event type."""
    ticker = F.when(F.col("event_type") == PRICE_EVENT_TYPE, F.lit(PRICE_TICKER)) \
        .otherwise(F.concat(F.upper(F.col("event_type")), F.lit("-USD")))
    px = F.col("value").cast(DecimalType(21, 2))
    return (events
            .select(F.to_date("ts").alias("date"), ticker.alias("ticker"), px.alias("px"),
                    F.col("ts"), F.col("event_id"))
            .groupBy("date", "ticker")
            .agg(F.min_by("px", "event_id").alias("price_open"),
                 F.max_by("px", "event_id").alias("price_close"),
                 F.min("px").alias("price_low"),
                 F.max("px").alias("price_high"),
                 F.max("ts").alias("loaded_at")))


def hashrate_from_events(events: DataFrame, supplier: DataFrame) -> DataFrame:
    """``src.hashrate`` stand-in: reported hashrate of the matched pools per day.

    ``left_semi`` against the supplier keys: shuffle or broadcast is up to
    the planner (the supplier table grows with the data).
    """
    pools = supplier.select(
        F.concat(F.lit(POOL_PREFIX), F.col("s_suppkey").cast("string")).alias("pool_key"))
    e = events.select(
        F.to_date("ts").alias("date"),
        F.concat(F.lit(POOL_PREFIX), F.col("user_id").cast("string")).alias("pool_key"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.col("ts"))
    return (e.groupBy("date", "pool_key")
            .agg((F.sum("cents").cast(DecimalType(20, 0)) * F.lit(Decimal(HASHRATE_UNIT)))
                 .cast(DecimalType(30, 0)).alias("hashrate"),
                 F.max("ts").alias("loaded_at"))
            .join(pools, "pool_key", "left_semi")
            .select("date", "pool_key", "hashrate", "loaded_at"))


_SOURCES: dict = {}


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four stand-in sources for the driver's tables in ``sf_dir``.

    The plans are pure functions of read-only files, so one set per session
    and folder is built and handed out again (a copy of the dict).
    """
    key = (*session_key(spark), sf_dir)
    if key not in _SOURCES:
        _SOURCES[key] = _build_sources(spark, sf_dir)
    return dict(_SOURCES[key])


def _build_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = read_table(spark, sf_dir, "events")
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return {
        "block": block_from_events(events),
        "pool": pool_from_suppliers(supplier, nation, region),
        "price": price_from_events(events),
        "hashrate": hashrate_from_events(events, supplier),
    }
