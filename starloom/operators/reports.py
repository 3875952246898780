"""Report aggregates over the star schema.

A category breakdown crosses the many-to-many bridge, so incidents are
counted with ``count(DISTINCT incident_id)`` to avoid double counting.  The
fact is first reduced to its distinct (incident, group, report keys), so the
bridge multiplies as few rows as possible.

Subtotals merge bitmaps: distinct counts do not add up over levels, but
bitmaps of incident numbers do (by OR), so incidents are read once, for
the finest level, and every level above reads the one below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import assign_ids, checked_broadcast
from starloom.session import scratch_path

# A bitmap holds 32,768 numbers in 4 KB: ids are their own numbers when at least one in so many of their
# span occurs (then a bitmap costs no more than the ids it stands for); sparser ids are numbered densely.
SPARSEST = 64


def _bc(df: DataFrame, sizes: dict[str, int] | None, name: str) -> DataFrame:
    """Size-checked broadcast; ``sizes`` (bytes per table, measured by the
    writes) spares the measuring."""
    return checked_broadcast(df, (sizes or {}).get(name))


def _categories(wh: dict[str, DataFrame], sizes: dict[str, int] | None = None) -> DataFrame:
    """group id -> category name, through the bridge (one row per member).

    It has at most as many rows as the bridge, whose rows are two ids (16 bytes),
    and no name longer than the longest; beyond the bound that follows it is joined by shuffle.
    """
    names = wh["dim_category"].select("category_id", "category")
    cats = _bc(names, sizes, "dim_category")
    cat_groups = (wh["br_category_group"].select("category_group_id", "category_id")
                  .join(cats, "category_id").select("category_group_id", "category").distinct())
    if "br_category_group" not in (sizes or {}):
        return checked_broadcast(cat_groups)
    longest = names.agg(F.max(F.octet_length("category"))).first()[0] or 0
    return checked_broadcast(cat_groups, sizes["br_category_group"] // 16 * (longest + 16))


def report_year(wh: dict[str, DataFrame], year: int | None = None,
                sizes: dict[str, int] | None = None) -> DataFrame:
    """Incidents by year, month, category, district and resolution.

    ``year`` narrows the report to one year (the dashboard's selector);
    without it every year is reported.
    """
    dates = wh["dim_date"].select(F.col("date_id").alias("incident_date"), "year", "month")
    if year is not None:
        dates = dates.filter(F.col("year") == year)
    f = (wh["fact_incident"]
         .join(_bc(dates, sizes, "dim_date"), "incident_date")
         .join(_bc(wh["dim_police_district"], sizes, "dim_police_district"), "police_district_id")
         .join(_bc(wh["dim_resolution"], sizes, "dim_resolution"), "resolution_id")
         .select("incident_id", "category_group_id", "year", "month", "police_district", "resolution").distinct()
         .join(_categories(wh, sizes), "category_group_id"))
    return (f.groupBy("year", "month", "category", "police_district", "resolution")
            .agg(F.count_distinct("incident_id").alias("n_incidents")))


def report_daily(wh: dict[str, DataFrame], day: str | None = None,
                 sizes: dict[str, int] | None = None) -> DataFrame:
    """R2: incidents per day by hour, Day/Night, category and district."""
    dates = wh["dim_date"].select(F.col("date_id").alias("incident_date"), "full_date")
    if day is not None:
        dates = dates.filter(F.col("full_date") == day)
    times = wh["dim_time"].select(F.col("time_id").alias("incident_time"), "hour", "daytime_indicator")
    f = (wh["fact_incident"]
         .join(_bc(dates, sizes, "dim_date"), "incident_date")
         .join(_bc(times, sizes, "dim_time"), "incident_time")
         .join(_bc(wh["dim_police_district"], sizes, "dim_police_district"), "police_district_id")
         .select("incident_id", "category_group_id", "full_date", "hour", "daytime_indicator", "police_district").distinct()
         .join(_categories(wh, sizes), "category_group_id"))
    return (f.groupBy("full_date", "hour", "daytime_indicator", "category", "police_district")
            .agg(F.count_distinct("incident_id").alias("n_incidents")))


def incident_numbers(fact: DataFrame, dense: bool | None = None) -> DataFrame:
    """(incident_date, police_district_id, number): a row's incident as a number for bitmaps.

    ``dense``: number the incidents 1, 2, ... by date, so that neighbours share bitmaps;
    None: only if the ids are sparse.  The counts are the same either way.
    """
    f = fact.select("incident_date", "police_district_id", "incident_id")
    if dense is None:
        low, high, n = f.agg(F.min("incident_id"), F.max("incident_id"), F.count("incident_id")).first()
        dense = bool(n) and (high - low + 1) > n * SPARSEST
    if not dense:
        return f.withColumnRenamed("incident_id", "number")
    firsts = f.filter(F.col("incident_id").isNotNull()).groupBy("incident_id").agg(F.min("incident_date").alias("_first"))
    ids = assign_ids(firsts, "number", ["_first", "incident_id"]).select("incident_id", "number")
    return f.join(ids, "incident_id", "left").drop("incident_id")


def report_year_rollup(wh: dict[str, DataFrame], sizes: dict[str, int] | None = None,
                       dense: bool | None = None) -> DataFrame:
    """R1 with subtotals: incidents per (year, month, district), per (year,
    month), per year and overall (NULL marks a rolled-up level).

    The bitmaps of the finest level are stored (one row per group and 32,768 numbers);
    each level above ORs those of the level below and is stored in turn.
    """
    dates = wh["dim_date"].select(F.col("date_id").alias("incident_date"), "year", "month")
    spark = dates.sparkSession
    f = (incident_numbers(wh["fact_incident"], dense)
         .join(_bc(dates, sizes, "dim_date"), "incident_date")
         .join(_bc(wh["dim_police_district"], sizes, "dim_police_district"), "police_district_id"))
    keys = ["year", "month", "police_district"]
    kinds = {k: f.schema[k].dataType for k in keys}
    maps = f.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    out = None
    for level in range(len(keys), -1, -1):
        path = scratch_path(spark, f"report-bitmaps-{level}")
        maps.write.parquet(path)
        maps = spark.read.schema(maps.schema).parquet(path)
        own = keys[:level]
        counts = maps.groupBy(*own).agg(F.sum(F.bitmap_count("bits")).alias("n_incidents"))
        # As count(DISTINCT): the overall row is there, with 0, even for an empty fact.
        counts = counts.select(*[F.col(k) if k in own else F.lit(None).cast(kinds[k]).alias(k) for k in keys],
                               F.coalesce("n_incidents", F.lit(0)).cast("bigint").alias("n_incidents"))
        out = counts if out is None else out.unionByName(counts)
        if level:
            maps = maps.groupBy(*keys[:level - 1], "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return out
