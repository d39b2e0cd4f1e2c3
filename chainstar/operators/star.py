"""Drill-across and star joins (R11: J3-J6, P8, P9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainstar.operators.keys import broadcast_if_small


SPREAD = 4096   # join keys that the default member's rows are spread over


@dataclass
class Arm:
    """One table joined to the base of a star: a dimension or another fact.

    ``on`` are the shared key columns; ``prefix`` renames the arm's other
    columns (``None`` keeps names, which must then not collide);
    ``broadcast`` is ``True`` for tables whose size is bounded by
    construction (day-grain facts, the calendar); otherwise the planner and
    AQE decide by size.

    ``default`` gives the values of a dimension's default member (its key
    included; columns not named are NULL).  Rows resolved to it, often the
    largest key by far, then take these as literals instead of meeting in
    one join task: their join key is replaced by a number spread over
    ``SPREAD`` values by a hash of the row's ``spread`` columns, which match nothing.
    """
    df: DataFrame
    on: Sequence[str]
    how: str = "inner"
    broadcast: bool | None = None
    columns: Sequence[str] | None = None
    default: Mapping[str, object] | None = None
    spread: Sequence[str] = ()


def _join_but_default(base: DataFrame, dim: DataFrame, arm: Arm) -> DataFrame:
    """Inner join on the arm's one key; rows of the default member don't take part."""
    (key,) = arm.on
    is_default = F.col(key) == F.lit(arm.default[key])
    others = [c for c in dim.columns if c != key]
    d = dim.filter(~is_default).select(F.col(key).alias("__arm_key"), *[F.col(c).alias(f"__arm_{c}") for c in others])
    nowhere = F.concat(F.lit("~"), F.pmod(F.xxhash64(*(arm.spread or base.columns)), F.lit(SPREAD)).cast("string"))
    probe = base.withColumn("__probe", F.when(is_default, nowhere).otherwise(F.col(key)))
    out = probe.join(d, F.col("__probe") == F.col("__arm_key"), "left")
    out = out.filter(is_default | F.col("__arm_key").isNotNull())
    return out.select(*base.columns, *[
        F.when(is_default, F.lit(arm.default.get(c)).cast(dim.schema[c].dataType)).otherwise(F.col(f"__arm_{c}")).alias(c)
        for c in others])


def drill_across(base: DataFrame, arms: Sequence[Arm], select: Sequence[Column | str]) -> DataFrame:
    """Join ``base`` to each arm on shared keys, then project ``select``.

    Facts whose unmatched keys were resolved to the default member (R5) can
    be joined with inner joins here, which lets Catalyst reorder and push
    filters through the star.
    """
    out = base
    for arm in arms:
        d = arm.df if arm.columns is None else arm.df.select(*arm.on, *arm.columns)
        if arm.default is not None:
            out = _join_but_default(out, d, arm)
            continue
        d = broadcast_if_small(d, known_small=arm.broadcast)
        out = out.join(d, list(arm.on), arm.how)
    return out.select(*select)
