"""Top-k previews (R12: O1, O2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREVIEW_ROWS = 1000


def sort_key(spec: str | Column) -> Column:
    """``"col"`` ascending, ``"-col"`` descending; PostgreSQL null order.

    PostgreSQL sorts NULL last ascending and first descending; Spark the other
    way round, so the order is spelled out.
    """
    if isinstance(spec, Column):
        return spec
    if spec.startswith("-"):
        return F.col(spec[1:]).desc_nulls_first()
    return F.col(spec).asc_nulls_last()


def preview(df: DataFrame, order: Sequence[str | Column], k: int = PREVIEW_ROWS) -> DataFrame:
    """``order by ... limit k``; planned as ``TakeOrderedAndProject``.

    Each task keeps its own top k, only k rows per task reach the final
    merge, so the cost does not depend on how the input is partitioned.
    The order should be total (append a unique key) for a repeatable result.
    """
    return df.orderBy(*[sort_key(o) for o in order]).limit(k)
