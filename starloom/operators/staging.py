"""Staging projections P1-P7 of the cleansed incidents.

Each takes the cleansed DataFrame and returns one staging dataset.  Dates
and minutes are deduplicated *before* attributes are derived: every
attribute is a function of the key, and the partial (map-side) aggregate
shrinks the data to at most one row per day / minute per task before any
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import calendar as cal

TIMESTAMP_COLUMNS = ("incident_datetime", "report_datetime")


def _all_timestamps(clean: DataFrame) -> DataFrame:
    """Incident and report timestamps stacked in one column."""
    return clean.select(F.explode(F.array(*TIMESTAMP_COLUMNS)).alias("ts"))     # one scan for both


def stage_dim_date(clean: DataFrame) -> DataFrame:
    """One row per calendar date seen in either timestamp."""
    days = _all_timestamps(clean).select(F.to_date("ts").alias("d")).distinct()
    return days.select(*cal.date_attributes(F.col("d"), prefix="stg_"))


def stage_dim_time(clean: DataFrame) -> DataFrame:
    """One row per minute of day seen in either timestamp."""
    minutes = (_all_timestamps(clean)
               .select(F.hour("ts").alias("h"), F.minute("ts").alias("m")).distinct())
    t = F.make_timestamp_ntz(F.lit(2000), F.lit(1), F.lit(1), F.col("h"), F.col("m"), F.lit(0))
    return minutes.select(*cal.time_attributes(t, prefix="stg_"))


def stage_dim_resolution(clean: DataFrame) -> DataFrame:
    """P3."""
    return clean.select(F.col("resolution").alias("stg_resolution")).distinct()


def stage_dim_police_district(clean: DataFrame) -> DataFrame:
    """P4."""
    return clean.select(F.col("police_district").alias("stg_police_district")).distinct()


def stage_dim_intersection(clean: DataFrame) -> DataFrame:
    """P5: distinct rows; a key may repeat with other attributes (Q10)."""
    return clean.select(
        F.col("cnn").alias("stg_cnn"), F.col("intersection").alias("stg_intersection"),
        F.col("latitude").alias("stg_latitude"), F.col("longitude").alias("stg_longitude"),
    ).distinct()


def stage_dim_category(clean: DataFrame) -> DataFrame:
    """P6."""
    return clean.select(
        F.col("incident_code").alias("stg_category_code"),
        F.col("incident_category").alias("stg_category"),
        F.col("incident_subcategory").alias("stg_subcategory"),
        F.col("incident_description").alias("stg_description"),
    ).distinct()


def stage_fact_incident(clean: DataFrame) -> DataFrame:
    """One row per cleansed record, no dedupe."""
    i, r = (F.col(c) for c in TIMESTAMP_COLUMNS)
    return clean.select(
        cal.full_date(i).alias("stg_incident_date"),
        cal.full_time(i).alias("stg_incident_time"),
        cal.full_date(r).alias("stg_report_date"),
        cal.full_time(r).alias("stg_report_time"),
        F.col("incident_id").alias("stg_incident_id"),
        F.col("incident_code").alias("stg_category_code"),
        F.col("resolution").alias("stg_resolution"),
        F.col("police_district").alias("stg_police_district"),
        F.col("cnn").alias("stg_cnn"),
    )


STAGERS = {
    "dim_date": stage_dim_date,
    "dim_time": stage_dim_time,
    "dim_resolution": stage_dim_resolution,
    "dim_police_district": stage_dim_police_district,
    "dim_intersection": stage_dim_intersection,
    "dim_category": stage_dim_category,
    "fact_incident": stage_fact_incident,
}


def stage_all(clean: DataFrame) -> dict[str, DataFrame]:
    return {name: fn(clean) for name, fn in STAGERS.items()}
