"""Data checks (E2 stale blocks and chain links, E6 grain and foreign keys)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys of ``grain`` held by more than one row, with their row count."""
    return (df.groupBy(*grain).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (``left_anti``)."""
    dim_key = dim_key or fact_key
    d = dim.select(F.col(dim_key).alias("__k")).distinct()
    return fact.join(d, fact[fact_key] == d["__k"], "left_anti")


def stale_heights(blocks: DataFrame, height: str = "blockheight", key: str = "block_key") -> DataFrame:
    """Heights held by more than one block (stale / competing blocks)."""
    return (blocks.groupBy(height)
            .agg(F.count(F.lit(1)).alias("block_count"),
                 F.min(key).alias("first_key"), F.max(key).alias("last_key"))
            .filter(F.col("block_count") > 1))


def broken_links(blocks: DataFrame, key: str = "block_key", prev: str = "prev_block_hash",
                 height: str = "blockheight") -> DataFrame:
    """Blocks whose parent hash names no block of the table.

    The lowest height is exempt (its parent precedes the extract).  A
    ``left_anti`` join: both sides shuffle on the hash, no pairs are formed.
    """
    parents = blocks.select(F.col(key).alias("__parent"))
    lowest = blocks.agg(F.min(height)).scalar()  # scalar subquery
    return (blocks.join(parents, blocks[prev] == parents["__parent"], "left_anti")
            .filter(F.col(height) > lowest))
