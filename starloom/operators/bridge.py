"""Many-to-many category bridge: signatures, group ids, bridge rows.

A group's identity is its *signature*: the comma-joined, numerically ordered
list of its distinct members, each with its number of occurrences where that
is more than one (``9,10*2``), so duplicates count (Q12).  Signatures are built
from per-(group, member) counts: map-side partial aggregation collapses a hot
incident to a few rows before any shuffle, and its signature is bounded by
its distinct members, however many rows it has.  Duplicates are expanded in
the bridge's rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import assign_ids, checked_broadcast, max_id

#: Partitions of the signature index, by a prefix of the signature's hash.
PREFIXES = 64


def group_signature(df: DataFrame, by: str, member: str, out: str = "signature") -> DataFrame:
    """One row per ``by`` with its ordered member list."""
    return _signature_of(df.groupBy(by, member).agg(F.count(F.lit(1)).alias("_n")), by, member, out)


def _signature_of(counted: DataFrame, by: str, member: str, out: str) -> DataFrame:
    """Signatures from (group, member, occurrences ``_n``) rows."""
    per_group = counted.groupBy(by).agg(
        F.array_sort(F.collect_list(F.struct(F.col(member).alias("m"), F.col("_n").alias("n")))).alias("_ms"))
    parts = F.transform("_ms", lambda x: F.when(x["n"] == 1, x["m"].cast("string")).otherwise(
        F.concat(x["m"].cast("string"), F.lit("*"), x["n"].cast("string"))))
    return per_group.select(by, F.array_join(parts, ",").alias(out))


def number_groups(signatures: DataFrame, id_col: str = "group_id", sig: str = "signature",
                  start=0) -> DataFrame:
    """Distinct signatures numbered in string order.

    The number of groups grows with the data, so ids use the distributed
    path of ``assign_ids``.
    """
    distinct = signatures.select(sig).distinct()
    return assign_ids(distinct, id_col, sig, start=start).select(id_col, sig)


def explode_signature(groups: DataFrame, id_col: str, sig: str = "signature",
                      out: str = "member") -> DataFrame:
    """One row per member occurrence of each group."""
    parts = groups.select(id_col, F.explode_outer(F.split(sig, ",")).alias("_part"))
    member, times = F.split_part("_part", F.lit("*"), F.lit(1)), F.split_part("_part", F.lit("*"), F.lit(2))
    counted = parts.select(id_col, member.cast("bigint").alias(out),
                           F.coalesce(F.nullif(times, F.lit("")).cast("bigint"), F.lit(1)).alias("_n"))
    return counted.select(id_col, out, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_k")).drop("_k")


def bridge_full_load(groups: DataFrame, dim_category: DataFrame, id_col: str = "group_id",
                     sig: str = "signature") -> DataFrame:
    """(category_group_id, category_id) from code signatures."""
    codes = explode_signature(groups, id_col, sig, "category_code")
    return (codes.join(dim_category.select("category_code", "category_id"), "category_code")
            .select(F.col(id_col).alias("category_group_id"), "category_id"))


def category_signatures(groups: DataFrame, dim_category: DataFrame, id_col: str = "group_id",
                        sig: str = "signature") -> DataFrame:
    """B5 from the numbered code signatures, without the bridge: signature of
    category ids per group."""
    counted = groups.select(F.col(id_col).alias("category_group_id"), F.explode(F.split(sig, ",")).alias("_part"))
    code = F.split_part("_part", F.lit("*"), F.lit(1)).cast("bigint")
    times = F.coalesce(F.nullif(F.split_part("_part", F.lit("*"), F.lit(2)), F.lit("")).cast("bigint"), F.lit(1))
    ids = counted.select("category_group_id", code.alias("category_code"), times.alias("_n")).join(
        dim_category.select("category_code", "category_id"), "category_code")
    return _signature_of(ids.select("category_group_id", "category_id", "_n"), "category_group_id", "category_id",
                         "category_id_group")


def group_dim_full(bridge: DataFrame) -> DataFrame:
    """B4."""
    return bridge.select("category_group_id").distinct()


def bridge_signatures(bridge: DataFrame) -> DataFrame:
    """Signature of category ids per existing group."""
    return group_signature(bridge, "category_group_id", "category_id", "category_id_group")


def incident_category_ids(stg_fact: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Staged incidents resolved to the *current* category versions."""
    cur = dim_category.filter(F.col("current_flag") == 1).select("category_code", "category_id")
    return (stg_fact.select(F.col("stg_incident_id").alias("incident_id"),
                            F.col("stg_category_code").alias("category_code"))
            .join(cur, "category_code").select("incident_id", "category_id"))


def incoming_signatures(stg_fact: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Signature (current category ids) of each incoming incident."""
    return group_signature(incident_category_ids(stg_fact, dim_category),
                           "incident_id", "category_id", "category_id_group")


def signature_prefix(sig="category_id_group") -> Column:
    return F.pmod(F.xxhash64(sig), F.lit(PREFIXES)).cast("int")


def write_by_prefix(rows: DataFrame, path: str) -> None:
    """Index rows in a folder for each prefix, one file each (a prefix of many rows is split by size)."""
    out = rows.withColumn("prefix", signature_prefix())
    out.hint("rebalance", "prefix").write.partitionBy("prefix").parquet(path)


def known_groups(index: DataFrame, incoming: DataFrame) -> DataFrame:
    """The index rows of the batch's signatures.

    ``index`` is partitioned by ``prefix``: only the partitions of the batch's
    own prefixes (at most ``PREFIXES`` rows, broadcast) are opened.
    """
    wanted = incoming.select("category_id_group").distinct()
    prefixes = wanted.select(signature_prefix().alias("prefix")).filter(F.col("prefix") >= 0).distinct()
    near = index.join(F.broadcast(prefixes), "prefix", "left_semi")
    return near.join(checked_broadcast(wanted), "category_id_group", "left_semi").select("category_group_id", "category_id_group")


def new_groups(signatures: DataFrame, incoming: DataFrame, start=None) -> DataFrame:
    """Signatures not yet known (Q2), numbered after the current maximum (Q3).

    ``signatures``: (category_group_id, category_id_group) of every existing
    group.  Returns (category_group_id, category_id_group) of the new ones.
    """
    new = incoming.select("category_id_group").distinct().join(
        signatures.select("category_id_group"), "category_id_group", "left_anti")
    start = max_id(signatures, "category_group_id") if start is None else start
    return number_groups(new, "category_group_id", "category_id_group", start=start)


def bridge_rows(numbered: DataFrame) -> DataFrame:
    """Bridge rows (one per member occurrence) of numbered signatures."""
    rows = explode_signature(numbered, "category_group_id", "category_id_group", "category_id")
    return rows.select("category_group_id", "category_id")


def bridge_insert_new(bridge: DataFrame, incoming: DataFrame, signatures: DataFrame | None = None) -> DataFrame:
    """Bridge rows of signatures not yet present (Q2), ids after the max (Q3).

    Returns only the rows to append.  Pass the stored ``signatures`` of the
    existing groups to avoid re-aggregating the whole bridge.
    """
    sigs = signatures if signatures is not None else bridge_signatures(bridge)
    return bridge_rows(new_groups(sigs, incoming, max_id(bridge, "category_group_id")))


def group_dim_insert_new(group_dim: DataFrame, bridge: DataFrame) -> DataFrame:
    """Group ids of the bridge not yet in the group dimension (Q4)."""
    return group_dim_full(bridge).join(group_dim, "category_group_id", "left_anti")
