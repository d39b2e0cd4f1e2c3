"""Height-based epochs (R9: X5, X6, X7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed values of the protocol the reference models: blocks per subsidy
# epoch, blocks per difficulty epoch, and the first-epoch subsidy in sats.
HALVING_INTERVAL = 210000
ADJUSTMENT_INTERVAL = 2016
INITIAL_SUBSIDY = 5000000000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_multiple(height: Column | str, length: int) -> Column:
    """True when ``height`` is a multiple of ``length``; NULL -> false.

    Same answer as the reference's ``round(h/N, 9) = floor(h/N)`` for every
    integer height.
    """
    return F.coalesce(F.pmod(_col(height).cast("long"), F.lit(length)) == 0, F.lit(False))


def epoch(height: Column | str, length: int) -> Column:
    """``(1 + floor(h / N))::int``, computed on integers."""
    h = _col(height).cast(DecimalType(20, 0))
    return (F.floor(h / F.lit(length)) + 1).cast("int")


def halving_level(ep: Column | str, base: int = INITIAL_SUBSIDY) -> Column:
    """``floor(base / 2^(epoch-1))`` as bigint.

    A shift is exact for epochs 1..64; from epoch 65 on the level is 0 (a
    shift by 64 would wrap around).
    """
    e = _col(ep).cast("int")
    return (F.when(e - 1 >= 64, F.lit(0).cast("long"))
            .otherwise(F.call_function("shiftright", F.lit(base).cast("long"), e - 1)))
