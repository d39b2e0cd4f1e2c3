"""Exact decimal arithmetic on Spark columns.

Spark types ``a / b`` and ``a * b`` on decimals pessimistically: the result
precision is capped at 38 and the scale is cut (down to 6) whenever the
nominal precision overflows, although the values themselves are small.  The
reference's measures (hashrate in four scales, fee share, hashvalue,
hashprice ...) would silently lose digits that way.

The helpers here keep every measure exact: inputs are brought to integral
"units" (``decimal(38,0)`` holding value * 10^scale), products of integral
decimals stay exact at ``(38,0)``, and a division is carried out as integer
quotient plus remainder with rounding half away from zero, the rounding of a
decimal cast in PostgreSQL and Spark.  All of it is plain column
expressions, so it stays inside whole-stage code generation.

Every result equals the exact rational value rounded once at the target
scale; an input too large for 38 digits raises (ANSI) rather than losing
digits.
"""

from __future__ import annotations

import math

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

INT38 = DecimalType(38, 0)


def _c(col: Column | str | int) -> Column:
    if isinstance(col, Column):
        return col
    if isinstance(col, str):
        return F.col(col)
    return F.lit(Decimal(col)).cast(INT38)


def pow10(k: int) -> Column:
    """10^k as an integral decimal literal."""
    return F.lit(Decimal(10) ** k).cast(DecimalType(k + 1, 0))


def to_units(col: Column | str, scale: int) -> Column:
    """Integral ``decimal(38,0)`` holding ``col * 10^scale``.

    ``col`` must have at most ``scale`` decimals (e.g. a ``decimal(30,9)``
    with ``scale=9``), so the result is exact.
    """
    c = _c(col)
    if scale == 0:
        return c.cast(INT38)
    return (c * pow10(scale)).cast(INT38)


def int_mul(*cols: Column | str | int) -> Column:
    """Exact product of integral values as ``decimal(38,0)``."""
    out = _c(cols[0]).cast(INT38)
    for c in cols[1:]:
        out = (out * _c(c).cast(INT38)).cast(INT38)
    return out


def round_div(num: Column, den: Column) -> Column:
    """``round(num / den)`` half away from zero, for integral num and den.

    ``floor((2|n| + |d|) / 2|d|)`` with the sign of ``n / d``; the floor of a
    non-negative quotient is ``(a - a % b) / b``, an exact division.
    Returns ``decimal(38,0)``.  ``den = 0`` raises under ANSI mode, like the
    reference's unguarded divisions.
    """
    n = _c(num).cast(INT38)
    d = _c(den).cast(INT38)
    a = F.abs(n) * 2 + F.abs(d)        # (38,0) arithmetic stays integral
    b = F.abs(d) * 2
    q = ((a - a % b) / b).cast(INT38)
    return F.when((n < 0) != (d < 0), -q).otherwise(q)


def from_units(units: Column, scale: int, precision: int) -> Column:
    """``units * 10^-scale`` as ``decimal(precision, scale)``, exactly.

    A single multiplication by ``1e-scale`` would be typed with a cut scale
    by Spark once ``precision + scale`` passes 38, so the shift is done in
    steps of at most ``37 - precision`` digits, each product exact and cast
    back to ``(precision, digits so far)``.  Each step reads the previous
    one once: the expression grows linearly.
    """
    if precision > 30:
        raise ValueError("from_units supports precision <= 30")
    step = max(scale, 1) if precision + scale <= 37 else 37 - precision
    out = _c(units).cast(DecimalType(precision, 0))
    done = 0
    while done < scale:
        k = min(step, scale - done)
        done += k
        out = (out * F.lit(Decimal(1).scaleb(-k)).cast(DecimalType(k, k))) \
            .cast(DecimalType(precision, done))
    return out


def shift_round(units: Column, k: int, precision: int, scale: int, digits: int = 30) -> Column:
    """``units * 10^-k`` rounded once at ``scale`` (<= k), as ``decimal(precision, scale)``.

    Dividing by a power of ten needs no division: the exact value is built
    with ``from_units`` (``digits`` bounds the digits of ``units``) and a
    single cast rounds it half away from zero.
    """
    return from_units(units, k, digits).cast(DecimalType(precision, scale))


def exact_ratio(num_units: Column, den_units: Column, precision: int, scale: int,
                num_scale: int = 0, den_scale: int = 0) -> Column:
    """``(num / den)`` rounded once at ``scale`` as ``decimal(precision, scale)``.

    ``num_units`` and ``den_units`` are integral columns holding the numerator
    times ``10^num_scale`` and the denominator times ``10^den_scale``.
    """
    shift = scale - num_scale + den_scale
    n, d = _c(num_units), _c(den_units)
    if shift >= 0:
        n = int_mul(n, 10 ** shift)
    else:
        d = int_mul(d, 10 ** (-shift))
    return from_units(round_div(n, d), scale, precision)


def safe_ratio(num_units: Column, den_units: Column, precision: int, scale: int,
               num_scale: int = 0, den_scale: int = 0) -> Column:
    """``case when den = 0 then null else num/den end``."""
    return F.when(_c(den_units) != 0, exact_ratio(
        num_units, F.when(_c(den_units) != 0, _c(den_units)), precision, scale,
        num_scale, den_scale))


def scale_units(units: Column, unit_scales: dict[str, int], precision: int = 30,
                ) -> dict[str, Column]:
    """One exact column per unit suffix, ``value / 10^k`` at scale k.

    ``units`` is the integral base value, e.g. an estimated hashrate in H/s
    already rounded to ``decimal(30,0)``; ``{"th": 12, "ph": 15, "eh": 18}``
    gives TH/s, PH/s and EH/s with 12, 15 and 18 decimals.
    """
    return {suffix: from_units(units, k, precision) for suffix, k in unit_scales.items()}


def sats_to_btc(col: Column | str, precision: int = 16, scale: int = 8) -> Column:
    """D3: satoshi integer to BTC, exact (``x / 10^8``)."""
    return from_units(_c(col), 8, precision) if scale == 8 else \
        exact_ratio(_c(col), F.lit(10 ** 8), precision, scale)


# ln(n!) for small n; Stirling's series is exact to rounding beyond.
_SMALL = 16


def _ln_factorial(n: Column) -> Column:
    logs, total = [], 0.0
    for k in range(_SMALL):
        total += math.log(max(k, 1))
        logs.append(F.lit(total))
    x = F.greatest(n, F.lit(1.0))
    series = 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5) - 1 / (1680 * x ** 7)
    stirling = x * F.log(x) - x + F.log(2 * math.pi * x) / 2 + series
    return F.when(n < _SMALL, F.element_at(F.array(*logs), F.least(n, F.lit(_SMALL - 1.0)).cast("int") + 1)).otherwise(stirling)


def poisson_at_least(k: Column, mean: Column) -> Column:
    """P(X >= k) for a Poisson variable, exact to about 14 digits; NULL without a positive mean.

    The tail's first term is taken in logarithms, the others follow from it by
    ratios, from the mean outwards, so nothing overflows and small tails keep their digits: the
    upper tail is summed where k is above the mean, else one less the lower one.
    """
    k, mean = k.cast("double"), mean.cast("double")
    upper = k > mean
    first = F.when(upper, k).otherwise(k - 1)
    # Terms fall off like exp(-j^2 / 2 mean): this many are far more than a double resolves.
    steps = F.ceil(9 * F.sqrt(F.greatest(k, mean))).cast("int") + 60
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(a: Column, j: Column) -> Column:
        ratio = F.when(upper, mean / (first + j)).otherwise(F.greatest(first - j + 1, F.lit(0.0)) / mean)
        return F.struct((a["term"] * ratio).alias("term"), (a["sum"] + a["term"] * ratio).alias("sum"))

    tail = F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda a: a["sum"])
    p = F.exp(first * F.log(mean) - mean - _ln_factorial(F.greatest(first, F.lit(0.0)))) * tail
    return F.when((mean > 0) & (k <= 0), F.lit(1.0)).when(mean > 0, F.when(upper, p).otherwise(1 - p))
