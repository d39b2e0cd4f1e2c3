"""Calendar attributes of a date column.

The reference's calendar dimension is defined by PostgreSQL date formatting;
each column below reproduces it with Spark built-ins.  Two quirks are kept on
purpose: ``year`` is the ISO year while ``first_day_of_year`` uses the
calendar year, and day and month names are blank padded to 9 characters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column order of the calendar dimension (fixed by the reference's DDL).
CALENDAR_COLUMNS = [
    "date_id", "date", "epoch_timestamp", "day_of_week", "day_of_week_name",
    "day_of_week_name_abbr", "day_of_month", "day_of_month_suffix",
    "day_of_quarter", "day_of_year", "week_of_month", "week_of_year",
    "week_of_year_iso", "month", "month_name", "month_name_abbr", "quarter",
    "quarter_name", "year", "first_day_of_week", "last_day_of_week",
    "first_day_of_month", "last_day_of_month", "first_day_of_quarter",
    "last_day_of_quarter", "first_day_of_year", "last_day_of_year", "is_weekend",
]


def date_id(d: Column) -> Column:
    """``yyyymmdd`` text key."""
    return F.date_format(d, "yyyyMMdd")


def iso_dow(d: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(d) + 1).cast("int")


def iso_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d).cast("int")


def day_suffix(d: Column) -> Column:
    """1st, 2nd, 3rd, 4th ... 11th, 12th, 13th ... 21st ..."""
    day = F.dayofmonth(d)
    suffix = (F.when(day.between(11, 13), "th")
              .when(day % 10 == 1, "st")
              .when(day % 10 == 2, "nd")
              .when(day % 10 == 3, "rd")
              .otherwise("th"))
    return F.concat(day.cast("string"), suffix)


def calendar_columns(d: Column) -> list[Column]:
    """All 28 attributes of date column ``d``, in the dimension's order."""
    dow = iso_dow(d)
    q_start = F.trunc(d, "quarter")
    week_start = F.date_sub(d, dow - 1)
    return [
        date_id(d).alias("date_id"),
        d.alias("date"),
        (F.unix_date(d).cast("long") * F.lit(86400)).alias("epoch_timestamp"),
        dow.alias("day_of_week"),
        F.rpad(F.date_format(d, "EEEE"), 9, " ").alias("day_of_week_name"),
        F.date_format(d, "EEE").alias("day_of_week_name_abbr"),
        F.dayofmonth(d).alias("day_of_month"),
        day_suffix(d).alias("day_of_month_suffix"),
        (F.datediff(d, q_start) + 1).alias("day_of_quarter"),
        F.dayofyear(d).alias("day_of_year"),
        (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("int").alias("week_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.concat(iso_year(d).cast("string"), F.lit("-w"),
                 F.lpad(F.weekofyear(d).cast("string"), 2, "0"), F.lit("-"),
                 dow.cast("string")).alias("week_of_year_iso"),
        F.month(d).alias("month"),
        F.rpad(F.date_format(d, "MMMM"), 9, " ").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_abbr"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        iso_year(d).alias("year"),
        week_start.alias("first_day_of_week"),
        F.date_add(week_start, 6).alias("last_day_of_week"),
        F.trunc(d, "month").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        q_start.alias("first_day_of_quarter"),
        F.date_sub(F.add_months(q_start, 3), 1).alias("last_day_of_quarter"),
        F.trunc(d, "year").alias("first_day_of_year"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("last_day_of_year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    ]
