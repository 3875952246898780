"""Fact loads G1-G3: resolve every dimension key of the staged incidents.

Plan shape: the staged fact is joined to each (size-checked, broadcast)
dimension without a shuffle, reduced to distinct rows of the eight
non-group columns (map-side partial aggregation first), and only then
joined to the one-row-per-incident group id.  The group id is a function
of the incident, so the DISTINCT over all nine columns equals this one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starloom.operators.bridge import group_signature, incoming_signatures
from starloom.operators.colocate import SALT
from starloom.operators.keys import checked_broadcast, dimension_join

FACT_COLUMNS = ["category_group_id", "resolution_id", "incident_date", "incident_time", "report_date",
                "report_time", "intersection_id", "police_district_id", "incident_id"]


# dimension -> staged key column, lookup table, its key, its id, and the name the id gets in the fact
LOOKUPS = {
    "resolution": ("stg_resolution", "dim_resolution", "resolution", "resolution_id", "resolution_id"),
    "incident_date": ("stg_incident_date", "dim_date", "full_date", "date_id", "incident_date"),
    "incident_time": ("stg_incident_time", "dim_time", "full_time", "time_id", "incident_time"),
    "report_date": ("stg_report_date", "dim_date", "full_date", "date_id", "report_date"),
    "report_time": ("stg_report_time", "dim_time", "full_time", "time_id", "report_time"),
    "intersection": ("stg_cnn", "dim_intersection", "cnn", "intersection_id", "intersection_id"),
    "police_district": ("stg_police_district", "dim_police_district", "police_district", "police_district_id",
                        "police_district_id"),
}


def resolve_dimension_keys(stg_fact: DataFrame, dims: dict[str, DataFrame],
                           current_only: bool = True, sizes: dict[str, int] | None = None,
                           how: str = "inner", extra: list[str] = []) -> DataFrame:
    """Staged rows with the seven dimension keys (inner joins, Q15;
    ``how="left"`` keeps rows that do not resolve, with NULL ids) and the
    ``extra`` columns of the staged fact.

    Every lookup is broadcast when its (known or measured) bytes allow it; beyond that
    only the rows of its rarer keys are shuffled (``dimension_join``).
    """
    j = stg_fact
    for key, table, natural, surrogate, out in LOOKUPS.values():
        dim = dims[table]
        if table == "dim_intersection" and current_only:
            dim = dim.filter(F.col("current_flag") == 1)
        lookup = dim.select(F.col(natural).alias("_key"), F.col(surrogate).alias(out))
        j = dimension_join(j, key, lookup, "_key", how, (sizes or {}).get(table), stg_fact)
    return j.select("resolution_id", "incident_date", "incident_time", "report_date", "report_time", "intersection_id",
                    "police_district_id", F.col("stg_incident_id").alias("incident_id"), *extra)


def incident_groups_full(stg_fact: DataFrame, groups: DataFrame,
                         signatures: DataFrame | None = None) -> DataFrame:
    """Group id of each staged incident from its code signature (full load).

    ``signatures``: the (stg_incident_id, signature) rows if already built.
    """
    sig = signatures if signatures is not None else group_signature(stg_fact, "stg_incident_id", "stg_category_code")
    g = checked_broadcast(groups.select(F.col("signature"), F.col("group_id").alias("category_group_id")))
    return (sig.join(g, "signature")
            .select(F.col("stg_incident_id").alias("incident_id"), "category_group_id"))


def incident_groups_incremental(stg_fact: DataFrame, dim_category: DataFrame,
                                signatures: DataFrame, n_bytes: int | None = None,
                                incoming: DataFrame | None = None) -> DataFrame:
    """Group id of each staged incident from its current-category-id signature.

    ``signatures``: (category_group_id, category_id_group) of every group
    (``bridge_signatures(bridge)`` or the stored signature index);
    ``n_bytes`` is its measured size, for the broadcast check; ``incoming``: the
    batch's (incident_id, category_id_group) rows if already built.
    """
    sig = incoming if incoming is not None else incoming_signatures(stg_fact, dim_category)
    g = checked_broadcast(signatures.select("category_group_id", "category_id_group"), n_bytes)
    return sig.join(g, "category_id_group").select("incident_id", "category_group_id")


KEY_COLUMNS = {"resolution": "resolution_id", "incident_date": "incident_date", "incident_time": "incident_time",
               "report_date": "report_date", "report_time": "report_time", "intersection": "intersection_id",
               "police_district": "police_district_id", "category_group": "category_group_id"}


def build_fact(stg_fact: DataFrame, dims: dict[str, DataFrame], incident_groups: DataFrame,
               current_only: bool = True, sizes: dict[str, int] | None = None,
               unmatched: Observation | None = None) -> DataFrame:
    """Distinct fact rows of the batch.

    With ``unmatched`` the same plan also counts, per dimension, the staged
    rows whose key does not resolve (G3): the lookups are left joins, the
    distinct keeps how many staged rows a row stands for, and the counts are
    observed just before unresolved rows are dropped.

    Where staged fact and incident groups are bucketed by (incident, salt)
    (``colocate``), neither the distinct nor the join moves a row.
    """
    how = "inner" if unmatched is None else "left"
    salt = [SALT] if SALT in stg_fact.columns else []
    keyed = resolve_dimension_keys(stg_fact, dims, current_only, sizes, how, salt)
    if unmatched is None:
        return keyed.distinct().join(incident_groups, ["incident_id", *salt]).select(*FACT_COLUMNS)
    counted = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("_n"))
    joined = counted.join(incident_groups, ["incident_id", *salt], "left")
    lost = [F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_n")).otherwise(0)), F.lit(0)).alias(d)
            for d, c in KEY_COLUMNS.items()]
    found = F.lit(True)
    for c in KEY_COLUMNS.values():
        found = found & F.col(c).isNotNull()
    return joined.observe(unmatched, *lost).filter(found).select(*FACT_COLUMNS)


def fact_unmatched(stg_fact: DataFrame, dims: dict[str, DataFrame],
                   incident_groups: DataFrame, sizes: dict[str, int] | None = None) -> DataFrame:
    """Staged rows whose key does not resolve, per dimension (ours; Q15).

    One pass: left joins to every lookup, then conditional counts.  Rows are counted per incident before they
    meet its group, so that one small row of each incident is shuffled.
    """
    keyed = resolve_dimension_keys(stg_fact, dims, True, sizes, "left")
    found = [c for c in KEY_COLUMNS.values() if c in keyed.columns]
    lost = keyed.groupBy("incident_id").agg(F.count(F.lit(1)).alias("_n"),
                                            *[F.count_if(F.col(c).isNull()).alias(c) for c in found]).alias("f")
    j = lost.join(incident_groups.alias("g"), F.col("f.incident_id") == F.col("g.incident_id"), "left")
    counts = {c: F.col(f"f.{c}") if c in found else F.when(F.col(f"g.{c}").isNull(), F.col("f._n"))
              for c in KEY_COLUMNS.values()}
    agg = j.agg(*[F.coalesce(F.sum(counts[c]), F.lit(0)).alias(name) for name, c in KEY_COLUMNS.items()])
    stack = "stack({}, {})".format(len(KEY_COLUMNS), ", ".join(f"'{n}', `{n}`" for n in KEY_COLUMNS))
    return agg.selectExpr(f"{stack} as (dimension, n_unmatched)")
