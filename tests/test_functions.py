import datetime as dt

import pandas as pd
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from starloom.functions import calendar as cal
from starloom.functions.hashing import fnv1a64, fnv1a64_chain

MASK = (1 << 64) - 1


def py_fnv(s: str, seed: int = 0xCBF29CE484222325) -> int:
    h = seed & MASK
    for b in s.encode("utf-8"):
        h = ((h ^ b) * 0x100000001B3) & MASK
    return h - (1 << 64) if h >= 1 << 63 else h


def test_holidays_match_pandas_calendar(spark):
    days = spark.range(0, (dt.date(2031, 1, 1) - dt.date(1986, 1, 1)).days).select(
        F.date_add(F.lit("1986-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    ours = {r.d for r in days.filter(cal.is_us_federal_holiday(F.col("d"))).collect()}
    ref = {d.date() for d in USFederalHolidayCalendar().holidays(start="1986-01-01", end="2030-12-31")}
    assert ours == ref


def test_holiday_table_over_a_range(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 6, 1, 0, 10),), (dt.datetime(2022, 1, 3, 5, 0),)], "ts timestamp_ntz")
    got = sorted(r.holiday_date for r in cal.us_federal_holidays(df, "ts").collect())
    # 2021-06-18 (Juneteenth observed), 07-05, 09-06, 10-11, 11-11, 11-25, 12-24, 12-31 (New Year 2022 observed)
    assert got == [dt.date(2021, 6, 18), dt.date(2021, 7, 5), dt.date(2021, 9, 6), dt.date(2021, 10, 11),
                   dt.date(2021, 11, 11), dt.date(2021, 11, 25), dt.date(2021, 12, 24), dt.date(2021, 12, 31)]


def test_fnv1a64_plain_utf8_empty_null(spark):
    words = ["", "a", "Brand#7 v2", "Supplier#000000001", "Straße", "東京", "x" * 300]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "s string")
    got = {r.s: r.h for r in df.select("s", fnv1a64("s").alias("h")).collect()}
    for w in words:
        assert got[w] == py_fnv(w), w
    assert got[None] is None


def test_fnv1a64_chain(spark):
    df = spark.createDataFrame([("CAT-1", "Brand#1"), ("CAT-2", "")], "a string, b string")
    for r in df.select("a", "b", fnv1a64_chain(["a", "b"]).alias("h")).collect():
        inner = py_fnv(r.b)
        assert r.h == py_fnv(r.a, inner & MASK)


def test_time_attributes_day_night_edges(spark):
    rows = [(dt.datetime(2022, 1, 1, h, m),) for h, m in [(5, 59), (6, 0), (18, 59), (19, 0)]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(*cal.time_attributes(F.col("ts")))
    got = [(r.full_time, r.daytime_indicator) for r in df.orderBy("full_time").collect()]
    assert got == [("05:59", "Night"), ("06:00", "Day"), ("18:59", "Day"), ("19:00", "Night")]


def test_date_attributes(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 7, 4, 10, 0),), (dt.datetime(2022, 7, 9, 0, 0),)], "ts timestamp_ntz")
    got = {r.date_id: r for r in df.select(*cal.date_attributes(F.col("ts"))).collect()}
    mon, sat = got[20220704], got[20220709]
    assert (mon.full_date, mon.year, mon.month, mon.month_name, mon.day_of_week, mon.day_name, mon.quarter) == \
        ("2022-07-04", 2022, 7, "July", 0, "Monday", "2022Q3")
    assert mon.holiday_indicator == "Holiday" and mon.weekday_indicator == "Weekday"
    assert sat.day_of_week == 5 and sat.weekday_indicator == "Weekend" and sat.holiday_indicator == "Non-Holiday"
