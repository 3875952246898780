"""Declared table schemas of the staging (T2) and warehouse (T3) zones.

Types follow SURVEY §1.2 and decisions Q5 (coordinates stay DOUBLE) and
Q6 (surrogate keys BIGINT, date keys INT).
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(),
          "double": T.DoubleType(), "date": T.DateType()}


def _schema(spec: str) -> T.StructType:
    """``"name type, name type"`` -> StructType (no session needed)."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in
                         (f.split() for f in spec.split(","))])


STG_SCHEMAS: dict[str, T.StructType] = {
    "dim_date": _schema(
        "stg_date_id int, stg_full_date string, stg_year int, stg_month int, stg_month_name string, "
        "stg_day_of_month int, stg_day_of_week int, stg_day_name string, stg_quarter string, "
        "stg_holiday_indicator string, stg_weekday_indicator string"),
    "dim_time": _schema("stg_full_time string, stg_hour int, stg_minute int, stg_daytime_indicator string"),
    "dim_resolution": _schema("stg_resolution string"),
    "dim_police_district": _schema("stg_police_district string"),
    "dim_intersection": _schema("stg_cnn int, stg_intersection string, stg_latitude double, stg_longitude double"),
    "dim_category": _schema(
        "stg_category_code int, stg_category string, stg_subcategory string, stg_description string"),
    "fact_incident": _schema(
        "stg_incident_date string, stg_incident_time string, stg_report_date string, stg_report_time string, "
        "stg_incident_id bigint, stg_category_code int, stg_resolution string, stg_police_district string, "
        "stg_cnn int"),
}

PROD_SCHEMAS: dict[str, T.StructType] = {
    "dim_date": _schema(
        "date_id int, full_date string, year int, month int, month_name string, day_of_month int, "
        "day_of_week int, day_name string, quarter string, holiday_indicator string, weekday_indicator string"),
    "dim_time": _schema("time_id bigint, full_time string, hour int, minute int, daytime_indicator string"),
    "dim_resolution": _schema("resolution_id bigint, resolution string"),
    "dim_police_district": _schema("police_district_id bigint, police_district string"),
    "dim_intersection": _schema(
        "intersection_id bigint, cnn int, intersection string, latitude double, longitude double, "
        "track_hash bigint, eff_date date, exp_date date, current_flag int"),
    "dim_category": _schema(
        "category_id bigint, category_code int, category string, subcategory string, description string, "
        "track_hash bigint, eff_date date, exp_date date, current_flag int"),
    "br_category_group": _schema("category_group_id bigint, category_id bigint"),
    "dim_category_group": _schema("category_group_id bigint"),
    "fact_incident": _schema(
        "category_group_id bigint, resolution_id bigint, incident_date int, incident_time bigint, "
        "report_date int, report_time bigint, intersection_id bigint, police_district_id bigint, "
        "incident_id bigint"),
}

# Internal lookup kept next to the warehouse: the category-id signature of
# every group, appended when a group is created, so incremental loads never
# re-aggregate the whole bridge.
INDEX_SCHEMAS: dict[str, T.StructType] = {
    "group_signature": _schema("category_group_id bigint, category_id_group string"),
}

# Partition column inside the attempts of an index table: a hash prefix of the signature.
INDEX_PARTITIONS = {"group_signature": "prefix"}

# Column defaults of the versioned dimensions (K2).
FULL_LOAD_EFF_DATE = "1970-01-01"
OPEN_END_DATE = "2999-12-31"
PROD_DEFAULTS: dict[str, dict[str, str]] = {
    "dim_intersection": {"eff_date": FULL_LOAD_EFF_DATE, "exp_date": OPEN_END_DATE, "current_flag": "1"},
    "dim_category": {"eff_date": FULL_LOAD_EFF_DATE, "exp_date": OPEN_END_DATE, "current_flag": "1"},
}

# How each warehouse table changes between loads.
INSERT_ONLY = ("dim_date", "dim_time", "dim_resolution", "dim_police_district",
               "br_category_group", "dim_category_group", "fact_incident")
VERSIONED = ("dim_intersection", "dim_category")
