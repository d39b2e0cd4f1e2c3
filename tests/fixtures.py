"""Small hand-made source tables (FIXTURES.md §3) as Spark DataFrames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from chainstar.sources import schemas

RUN_TS = "2024-05-01 00:00:00"
# The smallest driver tables.
SF_SMALL = "/root/testdata/sf0.001"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def block_rows(rows):
    """rows: (height, timestamp, pool_key, difficulty, subsidy, fee, tx_count[, hash, prev])."""
    out = []
    for r in rows:
        h = r[0]
        block_hash = r[7] if len(r) > 7 else f"h{h}"
        prev = r[8] if len(r) > 8 else f"h{h - 1}"
        out.append((h, block_hash, prev, ts(r[1]), r[2], Decimal(str(r[3])), r[4], r[5], r[6]))
    return out


def blocks_df(spark, rows):
    return spark.createDataFrame(block_rows(rows), schemas.BLOCK)


def pools_df(spark, rows):
    return spark.createDataFrame(rows, schemas.POOL)


def price_df(spark, rows):
    return spark.createDataFrame(
        [(d(r[0]), r[1], *[Decimal(str(x)) if x is not None else None for x in r[2:]]) for r in rows],
        schemas.PRICE)


def hashrate_df(spark, rows):
    return spark.createDataFrame([(d(r[0]), r[1], Decimal(str(r[2]))) for r in rows], schemas.HASHRATE)


# FIXTURES.md §3.2: adjustment day 2024-04-24, heights 840671-840674.
ADJ_DAY_BLOCKS = [
    (840671, "2024-04-24 06:00:00", "alpha", "80000000000000.5", 312500000, 1000000, 10),
    (840672, "2024-04-24 18:00:00", " beta ", "88000000000000", 312500000, 2000000, 20),
    (840673, "2024-04-24 20:00:00", "zzz", "88000000000000", 312500000, 3000000, 30),
    (840674, "2024-04-24 21:00:00", None, "88000000000000", 312500000, 4000000, 40),
]
ADJ_DAY_POOLS = [
    ("alpha", "Alpha Pool", "https://alpha.example/", True, False),
    ("beta", "Beta Pool", None, False, None),
]
ADJ_DAY_PRICE = [("2024-04-24", "BTC-USD", "64100.25", "64000.50", "63000.00", "65000.00")]
ADJ_DAY_HASHRATE = [("2024-04-24", "alpha", "8000000000000000000")]


def sources(spark, blocks=ADJ_DAY_BLOCKS, pools=ADJ_DAY_POOLS, price=ADJ_DAY_PRICE,
            hashrate=ADJ_DAY_HASHRATE):
    return {
        "block": blocks_df(spark, blocks),
        "pool": pools_df(spark, pools),
        "price": price_df(spark, price),
        "hashrate": hashrate_df(spark, hashrate),
    }
