"""Derived measures of the mining-economics layer.

Each function maps input columns to one output column with the reference's
declared type.  All divisions are exact rationals rounded once at the
declared scale (see ``numeric``).  The luck measures (D16-D19) are strict as
declared: a value past ``decimal(12,9)`` raises.  ``strict=False`` widens their
types, so that every value is kept, and gives NULL only where the expected
count is zero (T10), or for the fee ratios (D2, D4, D5) where the divisor is.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from chainstar.functions.numeric import (
    exact_ratio, from_units, int_mul, round_div, safe_ratio, sats_to_btc, shift_round, to_units,
)

# Seconds in a day and 2^32 / 86400 reduced to lowest terms
# (4294967296 / 86400 = 33554432 / 675), hashes per unit of difficulty.
SECONDS_PER_DAY = 86400
HASHES_PER_DIFFICULTY_NUM = 33554432
HASHES_PER_DIFFICULTY_DEN = 675
TWO_POW_32 = 4294967296.0

# Hashrate units: suffix -> power of ten (TH/s, PH/s, EH/s).
HASHRATE_UNITS = {"th": 12, "ph": 15, "eh": 18}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _memo(fn):
    """Reuse the built expression when a measure is asked for again with the
    same column names.  Building one exact measure takes hundreds of calls
    into the JVM; the expression itself is session independent."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        key = (args, tuple(sorted(kwargs.items())))
        if not all(isinstance(a, (str, int, bool)) for a in args + tuple(kwargs.values())):
            return fn(*args, **kwargs)
        if key not in cache:
            cache[key] = fn(*args, **kwargs)
        return cache[key]
    return wrapper


def _ratio(strict: bool):
    return exact_ratio if strict else safe_ratio


def _fit(col: Column, wide: int, strict: bool) -> Column:
    """A luck measure in its declared type, or with ``wide`` digits in lenient builds."""
    return col.cast(DecimalType(12 if strict else wide, 9))


# -- rewards and fees (D1-D5) ------------------------------------------------

@_memo
def reward_mining(subsidy: Column | str, fee: Column | str) -> Column:
    """Subsidy + fee in sats (NULL if either is NULL)."""
    return (_col(subsidy).cast("long") + _col(fee).cast("long")).cast("long")


@_memo
def fee_pct(fee: Column | str, subsidy: Column | str, strict: bool = True) -> Column:
    """``100 * fee / (subsidy + fee)`` as decimal(12,9); a reward of zero raises, lenient NULL."""
    total = _col(subsidy).cast("long") + _col(fee).cast("long")
    return _ratio(strict)(int_mul(100, _col(fee)), total, 12, 9)


@_memo
def fee_avg(fee: Column | str, tx_count: Column | str, strict: bool = True) -> Column:
    """``fee / tx_count`` as decimal(16,3)."""
    return _ratio(strict)(_col(fee), _col(tx_count), 16, 3)


@_memo
def fee_avg_btc(fee: Column | str, tx_count: Column | str, strict: bool = True) -> Column:
    """``fee / tx_count / 10^8`` as decimal(19,11), from the unrounded quotient."""
    return _ratio(strict)(_col(fee), _col(tx_count), 19, 11, num_scale=0, den_scale=-8)


@_memo
def btc(col: Column | str) -> Column:
    """D3: sats to BTC, decimal(16,8), exact."""
    return sats_to_btc(col)


# -- prices (D6, D7) -------------------------------------------------------------

@_memo
def price_change(close: Column | str, open_: Column | str) -> Column:
    return (_col(close) - _col(open_)).cast(DecimalType(21, 2))


@_memo
def price_change_pct(close: Column | str, open_: Column | str) -> Column:
    """``100 * (close - open) / open`` as decimal(18,9); NULL when open = 0."""
    c, o = to_units(close, 2), to_units(open_, 2)
    return safe_ratio(int_mul(100, c - o), o, 18, 9)


@_memo
def price_spread(high: Column | str, low: Column | str) -> Column:
    return (_col(high) - _col(low)).cast(DecimalType(21, 2))


# -- hashrate (D10, D11) -------------------------------------------------------

@_memo
def estimated_hashrate_units(block_count: Column | str, difficulty: Column | str) -> Column:
    """``round(n * difficulty * 2^32 / 86400)`` in H/s, integral decimal(38,0).

    ``difficulty`` is a decimal with at most 9 decimals; zero blocks give 0.
    """
    n = _col(block_count)
    num = int_mul(n, to_units(difficulty, 9), HASHES_PER_DIFFICULTY_NUM)
    den = F.lit(HASHES_PER_DIFFICULTY_DEN * 10 ** 9)
    return F.when(n == 0, F.lit(0).cast("decimal(38,0)")).otherwise(round_div(num, den))


@_memo
def hashrate_columns(units: Column | str, prefix: str) -> list[Column]:
    """``prefix`` as decimal(30,0) plus ``_th/_ph/_eh`` scales, all exact."""
    units = _col(units)
    out = [from_units(units, 0, 30).alias(prefix)]
    for suffix, k in HASHRATE_UNITS.items():
        out.append(from_units(units, k, 30).alias(f"{prefix}_{suffix}"))
    return out


@_memo
def scaled_columns(value: Column | str, prefix: str) -> list[Column]:
    """TH/PH/EH scales of a decimal: ``value / 10^k`` rounded at scale k.

    Rounding ``value / 10^k`` at k decimals is rounding ``value`` to a whole
    number and shifting it, so one cast and an exact shift suffice.
    """
    whole = _col(value).cast(DecimalType(38, 0))
    return [from_units(whole, k, 30).alias(f"{prefix}_{suffix}")
            for suffix, k in HASHRATE_UNITS.items()]


# -- value and price of hashrate (D13-D15) ------------------------------------

@_memo
def usd(price: Column | str, btc: Column | str, btc_scale: int = 8) -> Column:
    """``price * btc`` as decimal(21,6), rounded once from the exact product.

    ``btc_scale`` is the number of decimals of ``btc`` (8 for amounts, 11 for
    the average fee).
    """
    num = int_mul(to_units(price, 2), to_units(btc, btc_scale))
    return shift_round(num, 2 + btc_scale, 21, 6)


def hashvalue(reward_sats: Column | str, hashrate_units: Column, unit_power: int) -> Column:
    """Sats per unit of hashrate per day, ``reward / hashrate_in_unit``.

    The divisor is the rounded unit column, i.e. ``hashrate_units * 10^-k``.
    """
    return exact_ratio(_col(reward_sats), hashrate_units, 30, 9,
                       num_scale=0, den_scale=unit_power)


def hashprice(price: Column | str, hashvalue_col: Column | str) -> Column:
    """``price / 10^8 * hashvalue`` in USD, decimal(30,9)."""
    num = int_mul(to_units(price, 2), to_units(hashvalue_col, 9))
    return shift_round(num, 2 + 9 + 8, 30, 9)


# -- luck (D16-D19) --------------------------------------------------------------

@_memo
def expected_block_count(reported: Column | str, difficulty: Column | str,
                         strict: bool = True) -> Column:
    """``reported * 86400 / difficulty / 2^32`` as decimal(12,9), lenient (21,9).

    As in the reference, the decimal quotient is turned into a double before
    the last division.  Spark types the quotient ``decimal(38,6)``: 17 or more
    significant digits for any realistic hashrate, enough for the double.
    """
    q = (_col(reported).cast(DecimalType(30, 9)) * F.lit(SECONDS_PER_DAY).cast(DecimalType(5, 0))) \
        / _col(difficulty).cast(DecimalType(30, 9))
    return _fit(q.cast("double") / F.lit(TWO_POW_32), 21, strict)


@_memo
def block_count_diff(n: Column | str, expected: Column | str, strict: bool = True) -> Column:
    """``n - expected`` as decimal(12,9), lenient (22,9)."""
    return _fit(_col(n).cast(DecimalType(10, 0)) - _col(expected).cast(DecimalType(21, 9)),
                22, strict)


@_memo
def block_count_diff_pct(n: Column | str, expected: Column | str, strict: bool = True) -> Column:
    """``(100 * n - expected) / expected`` as decimal(12,9), lenient (30,9); the reference's formula."""
    e = to_units(expected, 9)
    num = int_mul(100, _col(n), 10 ** 9) - e
    q = exact_ratio(num, e, 30, 9, num_scale=9, den_scale=9) if strict else \
        safe_ratio(num, e, 30, 9, num_scale=9, den_scale=9)
    return _fit(q, 30, strict)


@_memo
def mining_luck(n: Column | str, expected: Column | str, strict: bool = True) -> Column:
    """``100 * n / expected`` as decimal(12,9), lenient (30,9); 100 means as many blocks as expected."""
    e = to_units(expected, 9)
    num = int_mul(100, _col(n))
    q = exact_ratio(num, e, 30, 9, num_scale=0, den_scale=9) if strict else \
        safe_ratio(num, e, 30, 9, num_scale=0, den_scale=9)
    return _fit(q, 30, strict)

