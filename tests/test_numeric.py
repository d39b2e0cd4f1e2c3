"""Exact decimal helpers against Python's decimal module (property tests)."""

from decimal import ROUND_HALF_UP, Decimal, getcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from chainstar.functions import numeric as N

getcontext().prec = 80


def _half_away(x: Decimal, scale: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**17, 10**17), st.integers(1, 10**12) | st.integers(-10**12, -1)),
                min_size=50, max_size=50))
def test_exact_ratio_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", N.exact_ratio(F.col("n"), F.col("d"), 30, 9).alias("q")).collect()
    for r in got:
        assert r.q == _half_away(Decimal(r.n) / Decimal(r.d), 9), (r.n, r.d)


def test_ties_round_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (15, 10), (-15, 10), (1, 3)], "n long, d long")
    got = [r.q for r in df.select(N.exact_ratio(F.col("n"), F.col("d"), 10, 0).alias("q")).collect()]
    assert got == [Decimal(3), Decimal(-3), Decimal(2), Decimal(-2), Decimal(0)]


def test_from_units_every_scale(spark):
    vals = [0, 1, -1, 123456789012345678901234567, -987654321098765432109876543]
    df = spark.createDataFrame([(str(v),) for v in vals], "u string").select(
        F.col("u").cast(DecimalType(38, 0)).alias("u"))
    for s in (0, 3, 8, 9, 12, 15, 18):
        got = [r.v for r in df.select(N.from_units(F.col("u"), s, 30).alias("v")).collect()]
        assert got == [Decimal(v).scaleb(-s) for v in vals]


def test_safe_ratio_null_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "n long, d long")
    got = [r.q for r in df.select(N.safe_ratio(F.col("n"), F.col("d"), 10, 2).alias("q")).collect()]
    assert got == [None, Decimal("0.25")]
