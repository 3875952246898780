"""Cleaning of raw incident records (C1-C7) and the reject audit.

Casting is done first with ``try_cast`` so a malformed value becomes NULL
and is dropped and counted like a missing one, instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.sources.json_arrays import CORRUPT

# The 14 kept columns, the excluded district and the
# excluded report type text.
RAW_COLUMNS = [
    "incident_datetime", "report_datetime", "incident_id", "report_type_description",
    "incident_code", "incident_category", "incident_subcategory", "incident_description",
    "resolution", "police_district", "intersection", "cnn", "latitude", "longitude",
]
EXCLUDED_DISTRICT = "Out of SF"
EXCLUDED_REPORT_TEXT = "Supplement"

CAST_TYPES = {
    "incident_datetime": "timestamp_ntz",
    "report_datetime": "timestamp_ntz",
    "incident_id": "bigint",
    "incident_code": "int",
    "cnn": "int",
    "latitude": "double",
    "longitude": "double",
}


def project_columns(df: DataFrame, cols: list[str] = RAW_COLUMNS) -> DataFrame:
    """Keep the named columns; a missing one is an analysis error."""
    return df.select(*cols)


def cast_value(c: str, kind: str) -> Column:
    """The value of a raw column in its type; NULL if malformed.

    Whole numbers may come written as decimals (``20065.0``): what does not
    cast directly is taken if it is a whole double that a double holds exactly.
    """
    value = F.col(c).try_cast(kind)
    if kind not in ("int", "bigint"):
        return value
    number = F.col(c).try_cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) <= float(1 << 53))
    return F.coalesce(value, F.when(whole, number.try_cast(kind)))


def cast_types(df: DataFrame, types: dict[str, str] = CAST_TYPES) -> DataFrame:
    """Typed columns; malformed values become NULL."""
    return df.withColumns({c: cast_value(c, t) for c, t in types.items() if c in df.columns})


def drop_any_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop a row when any listed column is NULL.

    One predicate per column: the planner derives facts from each predicate
    for every alias of its columns, which for one predicate over all columns
    grows with the product of their aliases.
    """
    for c in cols or df.columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def filter_not_equal(df: DataFrame, col: str = "police_district", value: str = EXCLUDED_DISTRICT) -> DataFrame:
    """Exact, case-sensitive inequality."""
    return df.filter(F.col(col) != F.lit(value))


def filter_not_contains(df: DataFrame, col: str = "report_type_description",
                        text: str = EXCLUDED_REPORT_TEXT) -> DataFrame:
    """C4: drop rows whose column contains the text (case-sensitive)."""
    return df.filter(~F.col(col).contains(text))


def drop_columns(df: DataFrame, cols: tuple[str, ...] = ("report_type_description",)) -> DataFrame:
    """C5."""
    return df.drop(*cols)


def filter_from_date(df: DataFrame, valid_date: str | None, col: str = "incident_datetime") -> DataFrame:
    """Keep rows at or after ``valid_date``; no-op without a date."""
    if not valid_date:
        return df
    return df.filter(F.col(col) >= F.to_timestamp_ntz(F.lit(valid_date)))


def clean_incidents(raw: DataFrame, valid_date: str | None = None) -> DataFrame:
    """C1-C7 in order: the 13-column cleansed zone."""
    df = cast_types(project_columns(raw))
    df = drop_any_null(df, RAW_COLUMNS)
    df = filter_not_equal(df)
    df = filter_not_contains(df)
    df = drop_columns(df)
    return filter_from_date(df, valid_date)


def reject_reason(raw: DataFrame, valid_date: str | None = None) -> Column:
    """Why a raw row is dropped by ``clean_incidents`` (NULL when kept).

    Checked in cleaning order; ``corrupt`` means input that is no record (where
    the batch was read with damaged rows), ``malformed`` a non-NULL raw value
    that does not cast.
    """
    malformed = F.lit(False)
    for c, t in CAST_TYPES.items():
        malformed = malformed | (F.col(c).isNotNull() & cast_value(c, t).isNull())
    any_null = F.lit(False)
    for c in RAW_COLUMNS:
        any_null = any_null | F.col(c).isNull()
    if CORRUPT in raw.columns:
        first = F.when(F.col(CORRUPT).isNotNull(), "corrupt").when(malformed, "malformed")
    else:
        first = F.when(malformed, "malformed")
    reason = (first
              .when(any_null, "null_value")
              .when(F.col("police_district") == EXCLUDED_DISTRICT, "excluded_district")
              .when(F.col("report_type_description").contains(EXCLUDED_REPORT_TEXT), "supplement"))
    if valid_date:
        reason = reason.when(F.col("incident_datetime").try_cast("timestamp_ntz")
                             < F.to_timestamp_ntz(F.lit(valid_date)), "before_valid_date")
    return reason


REJECT_REASONS = ["corrupt", "malformed", "null_value", "excluded_district", "supplement", "before_valid_date"]


def clean_observed(raw: DataFrame, observation, valid_date: str | None = None, measures: dict[str, Column] | None = None) -> DataFrame:
    """``clean_incidents`` that also counts every outcome (and takes the named ``measures`` of the raw batch) into ``observation``.

    The counts are collected by the job that writes the cleansed rows, so
    the audit costs no second pass over the raw batch.
    """
    tagged = raw.withColumn("_reject", reject_reason(raw, valid_date))
    metrics = [F.count_if(F.col("_reject").isNull()).alias("kept")]
    metrics += [F.count_if(F.col("_reject") == r).alias(r) for r in REJECT_REASONS if r != "corrupt" or CORRUPT in raw.columns]
    metrics += [m.alias(k) for k, m in (measures or {}).items()]
    kept = tagged.observe(observation, *metrics).filter(F.col("_reject").isNull()).drop("_reject")
    return clean_incidents(kept, valid_date)


def load_audit(raw: DataFrame, valid_date: str | None = None) -> DataFrame:
    """Rows per outcome of one ingest (``kept`` or the reject reason)."""
    return (raw.select(F.coalesce(reject_reason(raw, valid_date), F.lit("kept")).alias("outcome"))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows")))
