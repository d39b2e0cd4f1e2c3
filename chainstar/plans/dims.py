"""Dimension models: calendar (R6), pool, block."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from chainstar.functions.calendar import calendar_columns
from chainstar.functions.epochs import ADJUSTMENT_INTERVAL, HALVING_INTERVAL, is_multiple
from chainstar.functions.strings import (
    UNKNOWN_ID, UNKNOWN_TEXT, any_true, bounded, clean, default_text, surrogate_key,
)
from chainstar.operators.keys import with_default_member
from chainstar.operators.staging import dedupe_latest, stage
from chainstar.session import session_key

# Fixed values of the reference's calendar: 29,220 days from 1970-01-01
# (through 2049-12-31).
CALENDAR_START = "1970-01-01"
CALENDAR_DAYS = 29220


def audit_column(df: DataFrame, run_ts: str | _dt.datetime | None) -> Column:
    """P5: the load time of a row: the source's ``loaded_at`` when it has one,
    else the run's timestamp (a literal, so reruns are repeatable), else now."""
    if "loaded_at" in df.columns:
        return F.col("loaded_at").cast("timestamp_ntz")
    if run_ts is not None:
        return F.lit(run_ts).cast("timestamp_ntz")
    return F.current_timestamp().cast("timestamp_ntz")


# The declared schema of dim.date (fixed: names and types must match); every column is not null.
CALENDAR_TYPES = {
    "date_id": "VARCHAR(8)", "date": "DATE", "epoch_timestamp": "BIGINT", "day_of_week": "INT",
    "day_of_week_name": "VARCHAR(9)", "day_of_week_name_abbr": "VARCHAR(3)", "day_of_month": "INT",
    "day_of_month_suffix": "VARCHAR(4)", "day_of_quarter": "INT", "day_of_year": "INT", "week_of_month": "INT",
    "week_of_year": "INT", "week_of_year_iso": "CHAR(10)", "month": "INT", "month_name": "VARCHAR(9)",
    "month_name_abbr": "CHAR(3)", "quarter": "INT", "quarter_name": "VARCHAR(9)", "year": "INT",
    "first_day_of_week": "DATE", "last_day_of_week": "DATE", "first_day_of_month": "DATE", "last_day_of_month": "DATE",
    "first_day_of_quarter": "DATE", "last_day_of_quarter": "DATE", "first_day_of_year": "DATE",
    "last_day_of_year": "DATE", "is_weekend": "BOOLEAN",
}

_CALENDARS: dict = {}


def calendar(spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS) -> DataFrame:
    """The date dimension, one row per day from ``start``.

    Generated by ``spark.range``: its size is fixed by ``days`` (29,220
    rows by default), which is why joins may broadcast it unchecked.  The
    plan is built once per session and reused.
    """
    key = (*session_key(spark), start, days)
    if key not in _CALENDARS:
        d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
        _CALENDARS[key] = spark.range(days).select(d.alias("d")).select(*calendar_columns(F.col("d")))
    return _CALENDARS[key]


def calendar_of(dates: DataFrame, date_col: str) -> DataFrame:
    """Calendar attributes for the distinct dates of a table's date column."""
    d = dates.select(F.to_date(F.col(date_col)).alias("d")).distinct()
    return d.select(*calendar_columns(F.col("d")))


# The default member's values; its other columns are NULL.
POOL_DEFAULT = {"pool_id": UNKNOWN_ID, "pool_key": UNKNOWN_TEXT, "pool_name": UNKNOWN_TEXT, "pool_url": UNKNOWN_TEXT}


def dim_pool(src_pool: DataFrame, run_ts=None) -> DataFrame:
    """Pool dimension: cleaned, keep-latest per pool_key, md5 id, default member."""
    staged = stage(src_pool, {
        "pool_key": clean("pool_key"),
        "pool_name": clean("pool_name"),
        "pool_url": clean("pool_url"),
        "is_antpool_friend_custodian": F.col("is_antpool_friend_custodian").cast("boolean"),
        "is_antpool_friend_template": F.col("is_antpool_friend_template").cast("boolean"),
        "audit_created_timestamp": audit_column(src_pool, run_ts),
    }, not_null=["pool_key"])
    latest = dedupe_latest(staged, ["pool_key"], ["audit_created_timestamp"])
    dim = latest.select(
        bounded(surrogate_key("pool_key"), 512).alias("pool_id"),
        bounded("pool_key", 256).alias("pool_key"),
        bounded(default_text("pool_name"), 256).alias("pool_name"),
        bounded(default_text("pool_url"), 512).alias("pool_url"),
        any_true("is_antpool_friend_custodian", "is_antpool_friend_template")
        .alias("is_antpool_friend"),
        F.col("is_antpool_friend_custodian"),
        F.col("is_antpool_friend_template"),
        F.col("audit_created_timestamp"),
    )
    return with_default_member(dim, POOL_DEFAULT)


def block_attributes() -> list[Column]:
    """What the block dimension says of a staged block."""
    return [
        bounded("block_key", 256).alias("block_key"),
        bounded("block_key", 256).alias("block_hash"),
        bounded("prev_block_hash", 256).alias("prev_block_hash"),
        halving_flag().alias("is_subsidy_halving"),
        adjustment_flag().alias("is_difficulty_adjustment"),
    ]


def stage_blocks(src_block: DataFrame, run_ts=None, distinct: bool = False) -> DataFrame:
    """R1 on ``src.block``: cleaned and typed rows with a non-NULL key."""
    return stage(src_block, {
        "block_key": clean("block_hash"),
        "prev_block_hash": clean("prev_block_hash"),
        "blockheight": F.col("blockheight").cast("int"),
        "event_date": F.to_date(F.col("timestamp")),
        "event_timestamp": F.col("timestamp").cast("timestamp_ntz"),
        "pool_key": clean("pool_key"),
        "difficulty": F.col("difficulty").cast(DecimalType(30, 9)),
        "reward_subsidy": F.col("reward_subsidy").cast("long"),
        "reward_tx_fee_sum": F.col("reward_tx_fee_sum").cast("long"),
        "tx_count": F.col("tx_count").cast("int"),
        "audit_created_timestamp": audit_column(src_block, run_ts),
    }, not_null=["block_key"], distinct=distinct)


def staged_blocks(src_block: DataFrame, run_ts=None) -> DataFrame:
    """Cleaned, typed, keep-latest blocks: the shared input of every block model.

    The reference restages ``src.block`` in four models and dedupes each
    copy with an arbitrary order; one total order here makes all models see
    the same surviving row (G8).  Dedupe subsumes ``select distinct``.
    """
    return dedupe_latest(stage_blocks(src_block, run_ts), ["block_key"], ["audit_created_timestamp"])


def halving_flag(height: str = "blockheight") -> Column:
    return is_multiple(height, HALVING_INTERVAL)


def adjustment_flag(height: str = "blockheight") -> Column:
    return is_multiple(height, ADJUSTMENT_INTERVAL)


def dim_block(blocks: DataFrame) -> DataFrame:
    """Block dimension from ``staged_blocks``: hashes, halving / adjustment flags."""
    dim = blocks.select(
        bounded(surrogate_key("block_key"), 512).alias("block_id"),
        *block_attributes(),
        F.col("audit_created_timestamp"),
    )
    return with_default_member(dim, {"block_id": UNKNOWN_ID, "block_key": UNKNOWN_TEXT,
                                     "block_hash": UNKNOWN_TEXT, "prev_block_hash": UNKNOWN_TEXT})
