"""Versioned dimension maintenance D4-D9 without row-level DML.

``scd_apply`` joins a dimension once with the staged keys and explodes each pair
into the rows it becomes; the pipeline writes each result as a new attempt.
Changes are detected against *current* rows only (Q1).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.dims import ScdSpec, staged_versions
from starloom.operators.keys import assign_ids, max_id
from starloom.schemas import OPEN_END_DATE
from starloom.session import scratch_root


def _date(d: str | _dt.date | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


def current_rows(dim: DataFrame, spec: ScdSpec) -> DataFrame:
    """The open version of each key."""
    return dim.filter(F.col(spec.flag_col) == 1)


def scd_classify(dim: DataFrame, stg: DataFrame, spec: ScdSpec) -> DataFrame:
    """Staged rows (one per key) labelled ``new_row`` / ``change_row``."""
    s = staged_versions(stg, spec)
    cur = current_rows(dim, spec).select(spec.key, F.col(spec.hash_col).alias("_cur_hash"), F.lit(True).alias("_known"))
    c = s.join(cur, spec.key, "left")
    same = F.col("_cur_hash").eqNullSafe(F.col(spec.hash_col))
    return (c.withColumn("new_row", F.when(F.col("_known").isNull(), 1).otherwise(0))
             .withColumn("change_row", F.when(F.col("_known") & ~same, 1).otherwise(0))
             .drop("_cur_hash", "_known"))


def _apply_to_current(dim: DataFrame, classified: DataFrame, spec: ScdSpec, as_of: Column) -> DataFrame:
    """D5 + D7 on the current rows: close changed keys, overwrite unchanged ones."""
    flags = classified.select(
        spec.key, "new_row", "change_row", *[F.col(c).alias(f"_stg_{c}") for c in spec.overwrite])
    j = current_rows(dim, spec).join(flags, spec.key, "left")
    changed = F.coalesce(F.col("change_row"), F.lit(0)) == 1
    unchanged = (F.col("new_row") == 0) & (F.col("change_row") == 0)
    cols = []
    for c in dim.columns:
        if c in spec.overwrite:
            cols.append(F.when(unchanged, F.col(f"_stg_{c}")).otherwise(F.col(c)).alias(c))
        elif c == spec.exp_col:
            cols.append(F.when(changed, as_of).otherwise(F.col(c)).alias(c))
        elif c == spec.flag_col:
            cols.append(F.when(changed, F.lit(0)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def scd2_expire(dim: DataFrame, stg: DataFrame, spec: ScdSpec, as_of) -> DataFrame:
    """The closed versions of changed keys (exp_date = as_of, flag 0)."""
    cls = scd_classify(dim, stg, spec).filter("change_row = 1").select(spec.key)
    return (current_rows(dim, spec).join(cls, spec.key, "left_semi")
            .withColumn(spec.exp_col, _date(as_of)).withColumn(spec.flag_col, F.lit(0))
            .select(*dim.columns))


def scd2_insert_versions(dim: DataFrame, stg: DataFrame, spec: ScdSpec, as_of,
                         classified: DataFrame | None = None) -> DataFrame:
    """New open versions for new or changed keys, ids after the max."""
    cls = classified if classified is not None else scd_classify(dim, stg, spec)
    new = cls.filter((F.col("new_row") == 1) | (F.col("change_row") == 1))
    new = assign_ids(new, spec.id_col, spec.key, start=max_id(dim, spec.id_col))
    return new.select(
        spec.id_col, *spec.attrs, spec.hash_col,
        _date(as_of).alias(spec.eff_col), F.lit(OPEN_END_DATE).cast("date").alias(spec.exp_col),
        F.lit(1).alias(spec.flag_col)).select(*dim.columns)


def scd1_overwrite(dim: DataFrame, stg: DataFrame, spec: ScdSpec) -> DataFrame:
    """Current rows of unchanged keys with overwrite columns from staging."""
    cls = scd_classify(dim, stg, spec).filter("new_row = 0 AND change_row = 0")
    cur = current_rows(dim, spec).drop(*spec.overwrite)
    return cur.join(cls.select(spec.key, *spec.overwrite), spec.key).select(*dim.columns)


def joined_versions(dim: DataFrame, stg: DataFrame, spec: ScdSpec, as_of) -> DataFrame:
    """Every row of the next version, from one full outer join of the dimension with the staged keys.

    A staged key meets the open row of its key only.  A changed pair becomes
    two rows, the closed one (D5) and the new one (D6, still without id); an
    unchanged pair takes the overwrite columns (D7); a staged key without an
    open row is a new row, a row of the dimension without a staged key stays.
    """
    d, s = dim.alias("d"), staged_versions(stg, spec).withColumn("_staged", F.lit(True)).alias("s")
    j = d.join(s, (F.col(f"d.{spec.key}") == F.col(f"s.{spec.key}")) & (F.col(f"d.{spec.flag_col}") == 1), "full_outer")
    old, new = F.col(f"d.{spec.id_col}").isNotNull(), F.col("s._staged").isNotNull()
    changed = old & new & ~F.col(f"d.{spec.hash_col}").eqNullSafe(F.col(f"s.{spec.hash_col}"))
    as_of = _date(as_of)

    def kept(c) -> Column:
        value = F.col(f"d.{c}")
        if c in spec.overwrite:
            return F.when(new & ~changed, F.col(f"s.{c}")).otherwise(value)
        if c in (spec.exp_col, spec.flag_col):
            return F.when(changed, as_of if c == spec.exp_col else F.lit(0)).otherwise(value)
        return value
    fixed = {spec.id_col: F.lit(None), spec.eff_col: as_of, spec.exp_col: F.lit(OPEN_END_DATE), spec.flag_col: F.lit(1)}
    types = dict(dim.dtypes)
    row = [F.struct(*[kept(c).cast(types[c]).alias(c) for c in dim.columns]),
           F.struct(*[fixed.get(c, F.col(f"s.{c}")).cast(types[c]).alias(c) for c in dim.columns])]
    versions = F.when(changed, F.array(*row)).when(old, F.array(row[0])).otherwise(F.array(row[1]))
    return j.select(F.explode(versions).alias("v")).select("v.*")


def scd_apply(dim: DataFrame, stg: DataFrame, spec: ScdSpec, as_of) -> DataFrame:
    """The next version of the whole dimension.

    The dimension is read and joined once; the result is checkpointed, and only
    its new rows, those without an id, are numbered after the maximum.  Keys
    absent from staging are left open; a rerun with the same staging rows
    changes nothing.
    """
    scratch_root(dim.sparkSession)
    rows = joined_versions(dim, stg, spec, as_of).checkpoint()
    new = rows.filter(F.col(spec.id_col).isNull()).drop(spec.id_col)
    new = assign_ids(new, spec.id_col, spec.key, start=max_id(rows, spec.id_col))
    return rows.filter(F.col(spec.id_col).isNotNull()).unionByName(new)


def scd_as_of(dim: DataFrame, spec: ScdSpec, when) -> DataFrame:
    """The version valid on a date, ``eff <= d < exp``."""
    d = _date(when)
    return dim.filter((F.col(spec.eff_col) <= d) & (d < F.col(spec.exp_col)))
