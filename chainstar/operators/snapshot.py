"""Periodic snapshots and time-weighted levels (R7: A2-A9; R8: J7-J9, X9, D9).

The reference finds the first and last block of a day and the adjustment
block with self-joins on height (J7, J8).  Here the same values come out of
the one daily aggregate (``min_by`` / ``max_by``) and out of a small join
among the level-change rows only, so the full block table is read once and
shuffled only as partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainstar.functions.numeric import exact_ratio, int_mul, to_units

DAY_MICROS = 86_400_000_000


def periodic_snapshot(df: DataFrame, grain: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """One row per period (and entity) of ``grain`` with the given aggregates.

    A plain ``groupBy().agg()``: Spark aggregates partially before the
    shuffle, so a day or a pool holding a large share of the rows costs one
    partial row per task, not a hot partition.
    """
    return df.groupBy(*grain).agg(*aggs)


def micros_since_midnight(ts: Column | str, day: Column | str) -> Column:
    """Microseconds from the start of ``day`` to ``ts`` (exact, integer)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.col(day) if isinstance(day, str) else day
    return F.timestamp_diff("MICROSECOND", day.cast("timestamp_ntz"), ts)


def regime_weighted_avg(changes: DataFrame, daily: DataFrame, *, change_every: int,
                        day: str = "event_date", ts: str = "event_timestamp",
                        height: str = "blockheight", level: str = "difficulty",
                        first: str = "difficulty_first", out: str = "difficulty_weighted_avg",
                        level_scale: int = 9, precision: int = 30) -> DataFrame:
    """Add the day's time-weighted mean level to ``daily``.

    The level is a step function that changes at the rows of ``changes``
    (day, height, time, new level; heights are multiples of
    ``change_every``).  The day starts at ``first`` (level of the day's
    lowest height); each change holds from its own time until the next
    change of the same day, whatever its height, or the end of the day.  Of
    several rows at one height of a day the earliest counts (then the lower level).
    With one change this is the reference's blend ``first * t / 86400 + new *
    (86400 - t) / 86400``; without a change it is ``first``; with several
    (G11) it is the exact segment-weighted mean where the reference would fan
    out.  The result is exact, rounded once to ``decimal(precision, level_scale)``.

    Only change rows (one in ``change_every`` heights) are ordered within their
    day; the day's other rows are not, so a day holding a large share of the
    data is no hot partition.
    """
    c = changes.select(
        F.col(day), F.col(height).cast("long").alias("__h"),
        to_units(level, level_scale).alias("__lvl"),
        micros_since_midnight(ts, day).alias("__t"))
    c = c.groupBy(day, "__h").agg(F.min(F.struct("__t", "__lvl")).alias("__c")) \
        .select(day, "__h", "__c.__t", "__c.__lvl")
    t_next = F.lead("__t").over(Window.partitionBy(day).orderBy("__h"))
    segments = c.withColumn("__t_next", t_next).select(
        F.col(day), F.col("__h"), F.col("__t"),
        int_mul(F.col("__lvl"), F.coalesce(F.col("__t_next"), F.lit(DAY_MICROS)) - F.col("__t"))
        .alias("__area"))
    per_day = segments.groupBy(day).agg(
        F.sum("__area").cast("decimal(38,0)").alias("__area"),
        F.min_by("__t", "__h").alias("__t_first"))
    first_units = to_units(first, level_scale)
    weighted = exact_ratio(
        int_mul(first_units, F.col("__t_first")) + F.col("__area"),
        F.lit(DAY_MICROS), precision, level_scale, num_scale=level_scale)
    return (daily.join(per_day, day, "left")
            .withColumn(out, F.when(F.col("__area").isNull(),
                                    F.col(first).cast(f"decimal({precision},{level_scale})"))
                        .otherwise(weighted))
            .drop("__area", "__t_first"))
