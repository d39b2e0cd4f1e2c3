"""Staging and keep-latest dedupe (R1: P1 P2 P5 A1 F1; R2: W1 W2 F3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

_RN = "__dedupe_rn"


def stage(df: DataFrame, columns: Mapping[str, Column], not_null: Sequence[str] = (),
          where: Column | None = None, distinct: bool = False) -> DataFrame:
    """Project cleaned / typed columns, keep rows whose key is not NULL.

    ``columns`` maps output names to expressions over ``df`` (``clean``,
    casts, an audit column ...).  The key filter is applied to the *output*
    columns, i.e. to ``trim(key)``; the empty string passes, as in the
    reference.  ``distinct=True`` adds the reference's ``select distinct``;
    it is redundant (and costs a shuffle) when ``dedupe_latest`` with a total
    order follows, which keeps exactly one of any identical rows anyway.
    """
    out = df.select(*[expr.alias(name) for name, expr in columns.items()])
    for k in not_null:
        out = out.filter(F.col(k).isNotNull())
    if where is not None:
        out = out.filter(where)
    return out.distinct() if distinct else out


def total_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> list[Column]:
    """``order_by`` (names sort descending) then every other orderable column descending."""
    order: list[Column] = []
    named = set()
    for o in order_by:
        if isinstance(o, str):
            order.append(F.col(o).desc_nulls_last())
            named.add(o)
        else:
            order.append(o)
    for f in df.schema.fields:
        if f.name in keys or f.name in named or isinstance(f.dataType, MapType):
            continue
        order.append(F.col(f.name).desc_nulls_last())
    return order


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] = (),
                  tie_break: bool = True) -> DataFrame:
    """R2: keep one row per ``keys``: the latest by ``order_by``.

    ``row_number() over (partition by keys order by ...) = 1``.  With
    ``tie_break`` every remaining column is appended to the order, so the
    surviving row does not depend on input order or partitioning (the
    reference orders by a constant and keeps an arbitrary row).

    Plan: Catalyst turns the filter into a partial ``WindowGroupLimit``
    before the shuffle on ``keys`` and a final one after it, so a key with
    millions of copies ships at most one row per input partition.
    """
    order = total_order(df, keys, order_by) if tie_break else [
        F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order_by]
    if not order:
        order = [F.lit(1)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
