"""Calendar dimension (R6, C1-C28): FIXTURES.md §3.1 and whole-range properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chainstar.functions.calendar import CALENDAR_COLUMNS
from chainstar.plans.dims import calendar


@pytest.fixture(scope="module")
def cal(spark):
    cal = calendar(spark).persist()
    yield cal
    cal.unpersist()      # else later tests' plans would read it from memory


def test_shape(cal):
    assert cal.columns == CALENDAR_COLUMNS
    assert cal.count() == 29220
    r = cal.agg(F.min("date_id"), F.max("date_id"), F.countDistinct("date")).collect()[0]
    assert tuple(r) == ("19700101", "20491231", 29220)
    nulls = cal.select([F.sum(F.col(c).isNull().cast("int")) for c in cal.columns]).collect()[0]
    assert set(nulls) == {0}


def test_iso_year_differs_from_calendar_year_136_times(cal):
    assert cal.filter(F.col("year") != F.year("first_day_of_year")).count() == 136


def test_fixture_rows(cal):
    rows = {r.date_id: r for r in cal.filter(F.col("date_id").isin(
        "20210101", "20240503", "20241230")).collect()}
    a, b, c = rows["20210101"], rows["20240503"], rows["20241230"]
    assert (a.day_of_week_name, a.day_of_month_suffix, a.day_of_quarter, a.week_of_year,
            a.week_of_year_iso, a.year, a.first_day_of_week, a.last_day_of_quarter, a.is_weekend) == (
        "Friday   ", "1st", 1, 53, "2020-w53-5", 2020, dt.date(2020, 12, 28), dt.date(2021, 3, 31), False)
    assert (b.day_of_month_suffix, b.day_of_quarter, b.week_of_year, b.week_of_year_iso, b.year,
            b.first_day_of_week, b.last_day_of_quarter) == (
        "3rd", 33, 18, "2024-w18-5", 2024, dt.date(2024, 4, 29), dt.date(2024, 6, 30))
    assert (c.day_of_week_name, c.day_of_month_suffix, c.day_of_quarter, c.week_of_year,
            c.week_of_year_iso, c.year, c.first_day_of_week) == (
        "Monday   ", "30th", 91, 1, "2025-w01-1", 2025, dt.date(2024, 12, 30))


def test_attributes_agree_with_python(cal):
    sample = cal.filter(F.col("day_of_month").isin(1, 11, 12, 13, 21, 22, 23, 29, 31)).collect()
    suffix = {1: "st", 2: "nd", 3: "rd"}
    for r in sample:
        d = r.date
        iso = d.isocalendar()
        assert r.day_of_week == iso[2] and r.week_of_year == iso[1] and r.year == iso[0]
        assert r.epoch_timestamp == (d - dt.date(1970, 1, 1)).days * 86400
        assert r.day_of_month_suffix == f"{d.day}{'th' if 11 <= d.day <= 13 else suffix.get(d.day % 10, 'th')}"
        assert r.month_name == d.strftime("%B").ljust(9) and r.month_name_abbr == d.strftime("%b")
        assert r.day_of_week_name_abbr == d.strftime("%a")
        assert r.week_of_month == (d.day - 1) // 7 + 1
        assert r.is_weekend == (iso[2] >= 6)
        assert r.last_day_of_week - r.first_day_of_week == dt.timedelta(days=6)
        assert r.quarter_name == f"Q{(d.month - 1) // 3 + 1}"
        assert r.last_day_of_year == dt.date(d.year, 12, 31)
