"""Date and time attributes (F1-F15) and the US federal holiday rule.

The holiday test is a pure expression of the date: no holiday table, no
join, so it runs inside whole-stage codegen on any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Observed US federal holidays.
# Fixed-date holidays (month, day, first year), moved Saturday -> Friday and
# Sunday -> Monday:
FIXED_HOLIDAYS = [(1, 1, None), (6, 19, 2021), (7, 4, None), (11, 11, None), (12, 25, None)]
# n-th weekday of a month (month, weekday, n, first year):
NTH_WEEKDAY_HOLIDAYS = [(1, "MON", 3, 1986), (2, "MON", 3, None), (9, "MON", 1, None),
                        (10, "MON", 2, None), (11, "THU", 4, None)]
# last weekday of a month (month, weekday): Memorial Day.
LAST_WEEKDAY_HOLIDAYS = [(5, "MON")]


def observed(d: Column) -> Column:
    """Saturday moves to Friday, Sunday to Monday."""
    dow = F.dayofweek(d)  # 1 = Sunday ... 7 = Saturday
    return F.when(dow == 7, F.date_sub(d, 1)).when(dow == 1, F.date_add(d, 1)).otherwise(d)


def nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))


def last_weekday(year: Column, month: int, weekday: str) -> Column:
    return F.date_sub(F.next_day(F.last_day(F.make_date(year, F.lit(month), F.lit(1))), weekday), 7)


def holidays_of_year(year: Column) -> list[Column]:
    """Observed holiday dates of ``year`` (NULL where a rule is not in force)."""
    out = []
    for m, d, since in FIXED_HOLIDAYS:
        h = observed(F.make_date(year, F.lit(m), F.lit(d)))
        out.append(h if since is None else F.when(year >= since, h))
    for m, wd, n, since in NTH_WEEKDAY_HOLIDAYS:
        h = nth_weekday(year, m, wd, n)
        out.append(h if since is None else F.when(year >= since, h))
    for m, wd in LAST_WEEKDAY_HOLIDAYS:
        out.append(last_weekday(year, m, wd))
    return out


def is_us_federal_holiday(d: Column) -> Column:
    """the date is an observed federal holiday.

    New Year's Day of the next year can be observed on 31 December.
    """
    y = F.year(d)
    hit = F.lit(False)
    for h in holidays_of_year(y):
        hit = hit | F.coalesce(h == d, F.lit(False))
    nxt = observed(F.make_date(y + 1, F.lit(1), F.lit(1)))
    return hit | (nxt == d)


def us_federal_holidays(dates: DataFrame, col: str) -> DataFrame:
    """Observed holidays between the first and last date of ``col``.

    Only the (tiny) year range is materialized; the bound is one row per
    rule and year.
    """
    d = F.to_date(F.col(col))
    rng = dates.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    years = rng.select("lo", "hi", F.explode(F.sequence(F.year("lo") - 1, F.year("hi") + 1)).alias("y"))
    cand = years.select("lo", "hi", F.explode(F.array(*holidays_of_year(F.col("y")))).alias("holiday_date"))
    return (cand.filter(F.col("holiday_date").between(F.col("lo"), F.col("hi")))
            .select("holiday_date").distinct())


# --- F1-F15 -----------------------------------------------------------------

# Date keys and labels come from the calendar fields of the local
# (timestamp_ntz / date) value, so they never depend on the session time
# zone (no daylight-saving gaps).

def date_id(t: Column) -> Column:
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def full_date(t: Column) -> Column:
    return F.to_date(t).cast("string")


def quarter_label(t: Column) -> Column:
    return F.concat(F.year(t).cast("string"), F.lit("Q"), F.quarter(t).cast("string"))


def weekday_indicator(t: Column) -> Column:
    return F.when(F.weekday(t) > 4, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def holiday_indicator(t: Column) -> Column:
    return F.when(is_us_federal_holiday(F.to_date(t)), F.lit("Holiday")).otherwise(F.lit("Non-Holiday"))


def date_attributes(t: Column, prefix: str = "") -> list[Column]:
    """The 11 date-dimension columns of a date or timestamp."""
    return [
        date_id(t).alias(f"{prefix}date_id"),
        full_date(t).alias(f"{prefix}full_date"),
        F.year(t).alias(f"{prefix}year"),
        F.month(t).alias(f"{prefix}month"),
        F.date_format(t, "MMMM").alias(f"{prefix}month_name"),
        F.dayofmonth(t).alias(f"{prefix}day_of_month"),
        F.weekday(t).alias(f"{prefix}day_of_week"),
        F.date_format(t, "EEEE").alias(f"{prefix}day_name"),
        quarter_label(t).alias(f"{prefix}quarter"),
        holiday_indicator(t).alias(f"{prefix}holiday_indicator"),
        weekday_indicator(t).alias(f"{prefix}weekday_indicator"),
    ]


def full_time(t: Column) -> Column:
    """``HH:mm``."""
    return F.concat(F.lpad(F.hour(t).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(F.minute(t).cast("string"), 2, "0"))


def daytime_indicator(hour: Column) -> Column:
    return F.when(hour.between(6, 18), F.lit("Day")).otherwise(F.lit("Night"))


def time_attributes(t: Column, prefix: str = "") -> list[Column]:
    """The 4 time-dimension columns of a timestamp (minute grain)."""
    return [
        full_time(t).alias(f"{prefix}full_time"),
        F.hour(t).alias(f"{prefix}hour"),
        F.minute(t).alias(f"{prefix}minute"),
        daytime_indicator(F.hour(t)).alias(f"{prefix}daytime_indicator"),
    ]
