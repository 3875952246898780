"""Dimension loads D1-D3 and the SCD specs.

Dimensions that the domain bounds whatever the data's size (minutes of a day,
districts, resolutions; ``DimSpec.bounded``) are numbered by a window; all
others by the distributed path of ``assign_ids``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.hashing import fnv1a64_chain
from starloom.operators.keys import assign_ids, max_id
from starloom.schemas import FULL_LOAD_EFF_DATE, OPEN_END_DATE


@dataclass(frozen=True)
class DimSpec:
    """A natural-key dimension: staging column -> warehouse column."""
    columns: dict[str, str]
    key: str                       # warehouse natural-key column
    id_col: str | None = None      # surrogate id column, None for natural ids
    bounded: bool = False          # a fixed set of members, whatever the data's size


@dataclass(frozen=True)
class ScdSpec:
    """A versioned dimension (SCD2 on ``tracked``, SCD1 on ``overwrite``)."""
    columns: dict[str, str]
    key: str
    tracked: list[str]
    overwrite: list[str]
    id_col: str
    hash_col: str = "track_hash"
    eff_col: str = "eff_date"
    exp_col: str = "exp_date"
    flag_col: str = "current_flag"

    @property
    def attrs(self) -> list[str]:
        return [c for c in self.columns.values()]


DIM_SPECS: dict[str, DimSpec] = {
    "dim_date": DimSpec({f"stg_{c}": c for c in (
        "date_id", "full_date", "year", "month", "month_name", "day_of_month", "day_of_week",
        "day_name", "quarter", "holiday_indicator", "weekday_indicator")}, key="date_id"),
    "dim_time": DimSpec({"stg_full_time": "full_time", "stg_hour": "hour", "stg_minute": "minute",
                         "stg_daytime_indicator": "daytime_indicator"}, key="full_time", id_col="time_id", bounded=True),
    "dim_resolution": DimSpec({"stg_resolution": "resolution"}, key="resolution", id_col="resolution_id",
                              bounded=True),
    "dim_police_district": DimSpec({"stg_police_district": "police_district"}, key="police_district",
                                   id_col="police_district_id", bounded=True),
}

SCD_SPECS: dict[str, ScdSpec] = {
    "dim_intersection": ScdSpec(
        {"stg_cnn": "cnn", "stg_intersection": "intersection", "stg_latitude": "latitude",
         "stg_longitude": "longitude"},
        key="cnn", tracked=["intersection"], overwrite=["latitude", "longitude"], id_col="intersection_id"),
    "dim_category": ScdSpec(
        {"stg_category_code": "category_code", "stg_category": "category", "stg_subcategory": "subcategory",
         "stg_description": "description"},
        key="category_code", tracked=["category", "subcategory"], overwrite=["description"],
        id_col="category_id"),
}


def _rename(stg: DataFrame, columns: dict[str, str]) -> DataFrame:
    return stg.select(*[F.col(s).alias(t) for s, t in columns.items()])


def _with_id_first(df: DataFrame, id_col: str | None, cols: list[str]) -> DataFrame:
    return df.select(*([id_col] if id_col else []), *cols)


def full_load_dim(stg: DataFrame, spec: DimSpec) -> DataFrame:
    """Staging rows into an empty dimension; ids in natural-key order."""
    df = _rename(stg, spec.columns)
    cols = list(spec.columns.values())
    if spec.id_col:
        df = assign_ids(df, spec.id_col, spec.key, bounded=spec.bounded)
    return _with_id_first(df, spec.id_col, cols)


def insert_new(dim: DataFrame, stg: DataFrame, spec: DimSpec) -> DataFrame:
    """D3: the staging members whose natural key is unseen, ids after the max.

    Returns only the rows to insert (J3 anti join, K1 with start = max id).
    """
    df = _rename(stg, spec.columns)
    new = df.join(dim.select(spec.key), spec.key, "left_anti")
    cols = list(spec.columns.values())
    if spec.id_col:
        new = assign_ids(new, spec.id_col, spec.key, start=max_id(dim, spec.id_col), bounded=spec.bounded)
    return _with_id_first(new, spec.id_col, cols)


def collapse_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Q10: one deterministic row per key (smallest remaining attributes, NULL first).

    A minimum over a struct, so it is combined map-side and a hot key is one
    row per task.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    least = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_least"))
    return least.select(*[F.col(c) if c == key else F.col(f"_least.{c}").alias(c) for c in df.columns])


def staged_versions(stg: DataFrame, spec: ScdSpec) -> DataFrame:
    """Staging rows renamed, one per key, with the tracked-columns hash."""
    df = _rename(stg, spec.columns)
    attrs = [c for c in spec.attrs if c != spec.key]
    df = collapse_per_key(df, spec.key, attrs)
    return df.withColumn(spec.hash_col, fnv1a64_chain(spec.tracked))


def scd_init(stg: DataFrame, spec: ScdSpec) -> DataFrame:
    """First load of a versioned dimension (K1 + K2 + F16/F17)."""
    df = staged_versions(stg, spec)
    df = assign_ids(df, spec.id_col, spec.key)
    return df.select(
        spec.id_col, *spec.attrs, spec.hash_col,
        F.lit(FULL_LOAD_EFF_DATE).cast("date").alias(spec.eff_col),
        F.lit(OPEN_END_DATE).cast("date").alias(spec.exp_col),
        F.lit(1).alias(spec.flag_col))
