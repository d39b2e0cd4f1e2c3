"""Source schemas (S1-S4) and the calendar schema; fixed, never inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampNTZType,
)

BLOCK = StructType([
    StructField("blockheight", IntegerType(), False),
    StructField("block_hash", StringType(), False),
    StructField("prev_block_hash", StringType(), False),
    StructField("timestamp", TimestampNTZType(), False),
    StructField("pool_key", StringType(), True),
    StructField("difficulty", DecimalType(30, 7), True),
    StructField("reward_subsidy", LongType(), True),
    StructField("reward_tx_fee_sum", LongType(), True),
    StructField("tx_count", IntegerType(), True),
])

HASHRATE = StructType([
    StructField("date", DateType(), False),
    StructField("pool_key", StringType(), False),
    StructField("hashrate", DecimalType(30, 0), True),
])

POOL = StructType([
    StructField("pool_key", StringType(), False),
    StructField("pool_name", StringType(), False),
    StructField("pool_url", StringType(), True),
    StructField("is_antpool_friend_custodian", BooleanType(), True),
    StructField("is_antpool_friend_template", BooleanType(), True),
])

PRICE = StructType([
    StructField("date", DateType(), False),
    StructField("ticker", StringType(), False),
    StructField("price_open", DecimalType(21, 2), True),
    StructField("price_close", DecimalType(21, 2), True),
    StructField("price_low", DecimalType(21, 2), True),
    StructField("price_high", DecimalType(21, 2), True),
])

SOURCES = {"block": BLOCK, "hashrate": HASHRATE, "pool": POOL, "price": PRICE}

# Optional audit column a source may carry: when the row was loaded.  The
# models order keep-latest dedupes by it when present.
LOADED_AT = StructField("loaded_at", TimestampNTZType(), True)


def with_loaded_at(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [LOADED_AT])


def required_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
