"""A second star on the driver's order tables, built with the same operators.

Shows that the toolkit is not tied to blocks and pools: keep-latest dedupe
of order lines, md5 dimensions with a default member, foreign keys resolved
by joins that AQE sizes at run time (broadcast when small, shuffle beyond),
and a daily periodic snapshot with exact decimal measures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from chainstar.functions.numeric import exact_ratio, to_units
from chainstar.functions.strings import UNKNOWN_ID, UNKNOWN_TEXT, clean, surrogate_key
from chainstar.operators.keys import resolve_fk, with_default_member
from chainstar.operators.snapshot import periodic_snapshot
from chainstar.operators.staging import dedupe_latest, stage
from chainstar.plans.facts import with_date_id


def dim_part(part: DataFrame) -> DataFrame:
    staged = stage(part, {
        "part_key": F.col("p_partkey").cast("string"),
        "part_name": clean("p_name"),
        "brand": clean("p_brand"),
        "part_type": clean("p_type"),
        "size": F.col("p_size").cast("int"),
        "retail_price": F.col("p_retailprice").cast(DecimalType(12, 2)),
    }, not_null=["part_key"])
    latest = dedupe_latest(staged, ["part_key"])
    dim = latest.select(surrogate_key("part_key").alias("part_id"), "*")
    return with_default_member(dim, {"part_id": UNKNOWN_ID, "part_key": UNKNOWN_TEXT,
                                     "part_name": UNKNOWN_TEXT})


def dim_supplier(supplier: DataFrame) -> DataFrame:
    staged = stage(supplier, {
        "supplier_key": F.col("s_suppkey").cast("string"),
        "supplier_name": clean("s_name"),
        "nation_key": F.col("s_nationkey").cast("int"),
        "account_balance": F.col("s_acctbal").cast(DecimalType(12, 2)),
    }, not_null=["supplier_key"])
    latest = dedupe_latest(staged, ["supplier_key"])
    dim = latest.select(surrogate_key("supplier_key").alias("supplier_id"), "*")
    return with_default_member(dim, {"supplier_id": UNKNOWN_ID, "supplier_key": UNKNOWN_TEXT,
                                     "supplier_name": UNKNOWN_TEXT})


def lineitem_latest(lineitem: DataFrame) -> DataFrame:
    """W1 on order lines: the latest ship of each (order, line) pair."""
    staged = stage(lineitem, {
        "order_key": F.col("l_orderkey").cast("long"),
        "line_number": F.col("l_linenumber").cast("int"),
        "ship_date": F.to_date("l_shipdate"),
        "part_key": F.col("l_partkey").cast("string"),
        "supplier_key": F.col("l_suppkey").cast("string"),
        "quantity": F.col("l_quantity").cast(DecimalType(12, 2)),
        "extended_price": F.col("l_extendedprice").cast(DecimalType(18, 2)),
        "discount": F.col("l_discount").cast(DecimalType(4, 2)),
        "tax": F.col("l_tax").cast(DecimalType(4, 2)),
        "return_flag": clean("l_returnflag"),
        "line_status": clean("l_linestatus"),
    }, not_null=["order_key", "line_number"])
    return dedupe_latest(staged, ["order_key", "line_number"], ["ship_date"])


def fact_lineitem(lines: DataFrame, dim_date: DataFrame, parts: DataFrame,
                  suppliers: DataFrame) -> DataFrame:
    """Order-line fact: dimension ids (default ``'0'``) and exact revenue.

    Part and supplier dimensions grow with the data: no hint, so AQE picks a
    broadcast only when the measured dimension side is small and keeps the
    shuffle join beyond that (no extra counting job over the dimension).
    """
    f = with_date_id(lines, dim_date, on="ship_date")
    f = resolve_fk(f, parts, "part_key", "part_id", broadcast=False)
    f = resolve_fk(f, suppliers, "supplier_key", "supplier_id", broadcast=False)
    one = F.lit(1).cast(DecimalType(1, 0))
    return f.select(
        "date_id", "order_key", "line_number", "part_id", "supplier_id", "return_flag",
        "line_status", "quantity", "extended_price", "discount",
        (F.col("extended_price") * (one - F.col("discount"))).cast(DecimalType(24, 4)).alias("revenue"),
        (F.col("extended_price") * (one - F.col("discount")) * (one + F.col("tax")))
        .cast(DecimalType(28, 6)).alias("charge"),
    )


def sales_daily(fact: DataFrame) -> DataFrame:
    """R7 on order lines: one row per (ship day, return flag)."""
    g = periodic_snapshot(fact, ["date_id", "return_flag"], [
        F.count("order_key").alias("line_count"),
        F.count_distinct("part_id").alias("part_count"),
        F.sum("quantity").alias("quantity_sum"),
        F.sum("extended_price").alias("extended_price_sum"),
        F.sum("revenue").alias("revenue_sum"),
    ])
    return g.select(
        "date_id", "return_flag", "line_count", "part_count",
        F.col("quantity_sum").cast(DecimalType(22, 2)).alias("quantity_sum"),
        F.col("extended_price_sum").cast(DecimalType(28, 2)).alias("extended_price_sum"),
        F.col("revenue_sum").cast(DecimalType(34, 4)).alias("revenue_sum"),
        exact_ratio(to_units("extended_price_sum", 2), F.col("line_count"), 18, 4, num_scale=2)
        .alias("avg_extended_price"),
    )
