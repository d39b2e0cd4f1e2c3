"""The canonical chain of blocks that name their parent.

Where several blocks follow one parent, the branch that reaches highest is the
chain and the others are stale (of equal heights, the branch whose last block
is earliest, then of the least key).  A block whose parent is not in the table, or
not one height below, starts a chain of its own: nothing says which branch it
belongs to.

Branches are followed by pointer doubling, but only where blocks compete: a
block that is alone at its height is on every branch that gets that far.  So a
branch with such a block is the highest of its fork, and only the blocks of
contested heights (few, whatever the length of the chain) take part.  Each
round squares the distance that pointers span: log2 of the longest contested
branch rounds, each written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainstar.operators.sinks import write_table

KEY, PREV, HEIGHT, TIME = "block_key", "prev_block_hash", "blockheight", "event_timestamp"
FAR = 2 ** 62    # reach of a branch that goes on above the contested heights


def _kept(df: DataFrame, path: str) -> DataFrame:
    write_table(df, path=path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pointers(blocks: DataFrame, path: str) -> DataFrame:
    """(node, up, grp, reach) of the contested blocks: their contested parent or null,
    the fork they belong to, and how far they reach on their own."""
    b = blocks.select(F.col(KEY).alias("node"), F.col(PREV).alias("prev"), F.col(HEIGHT).cast("long").alias("h"),
                      F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), TIME).alias("t"))
    heights = _kept(b.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), f"{path}/heights")
    at = _kept(b.join(heights, "h", "left_semi"), f"{path}/contested")
    # Parents: any block one height below.
    below = b.join(heights.select((F.col("h") - 1).alias("h")), "h", "left_semi").select(
        F.col("node").alias("prev"), (F.col("h") + 1).alias("h"), F.lit(True).alias("linked"))
    up = at.select(F.col("node").alias("prev"), (F.col("h") + 1).alias("h"), F.col("node").alias("up"))
    above = (b.join(heights.select((F.col("h") + 1).alias("h")), "h", "left_semi").join(heights, "h", "left_anti")
             .select(F.col("prev").alias("node"), (F.col("h") - 1).alias("h"), F.lit(True).alias("goes_on")).distinct())
    own = (at.join(below, ["prev", "h"], "left").join(up, ["prev", "h"], "left").join(above, ["node", "h"], "left"))
    fork = F.when(F.col("linked"), F.concat(F.lit("p:"), F.col("prev"))).otherwise(F.concat(F.lit("n:"), F.col("node")))
    reach = F.struct(F.when(F.col("goes_on"), F.lit(-FAR)).otherwise(-F.col("h")).alias("minus_height"),
                     F.col("t").alias("t"), F.col("node").alias("last"))
    return own.select("node", "up", fork.alias("grp"), reach.alias("reach"))


def stale_keys(blocks: DataFrame, path: str) -> DataFrame:
    """(block_key) of the blocks that are not on the chain; ``path`` is a folder for the rounds."""
    first = _kept(_pointers(blocks, path), f"{path}/pointers")
    # Upwards: the best end of each block's branch, over descendants twice as far every round.
    state, n = first.select("node", "up", "reach"), 0
    while state.filter("up IS NOT NULL").limit(1).count():
        passed = state.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.min("reach").alias("got"))
        parent = state.select(F.col("node").alias("up"), F.col("up").alias("up2"))
        state = _kept(state.join(passed, "node", "left").join(parent, "up", "left").select(
            "node", F.col("up2").alias("up"), F.least("reach", "got").alias("reach")), f"{path}/up-{n}")
        n += 1
    best = first.select("node", "up", "grp").join(state.select("node", "reach"), "node")
    wins = best.groupBy("grp").agg(F.min_by("node", "reach").alias("winner"))
    # Downwards: a block is on the chain if it and all blocks below it won their forks.
    state = _kept(best.join(wins, "grp").select("node", "up", (F.col("node") == F.col("winner")).alias("ok")),
                  f"{path}/won")
    n = 0
    while state.filter("up IS NOT NULL").limit(1).count():
        parent = state.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("ok").alias("ok2"))
        state = _kept(state.join(parent, "up", "left").select(
            "node", F.col("up2").alias("up"), (F.col("ok") & F.coalesce("ok2", F.lit(True))).alias("ok")),
            f"{path}/down-{n}")
        n += 1
    return state.filter("NOT ok").select(F.col("node").alias(KEY))


def canonical_chain(blocks: DataFrame, path: str) -> DataFrame:
    """``blocks`` with ``is_canonical``: false for stale blocks."""
    stale = stale_keys(blocks, path).withColumn("__stale", F.lit(True))
    return (blocks.join(stale, KEY, "left")
            .withColumn("is_canonical", F.col("__stale").isNull()).drop("__stale").select(*blocks.columns, "is_canonical"))


def without_stale(blocks: DataFrame, path: str) -> DataFrame:
    """``blocks`` without the stale ones."""
    return blocks.join(stale_keys(blocks, path), KEY, "left_anti").select(*blocks.columns)
