"""Surrogate keys (K1), defaults (K2), size-checked broadcast and the hybrid join beyond it (K3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Broadcast bound for dimension joins: a dimension is replicated only when
# its measured bytes are at most this; otherwise the planner decides.
BROADCAST_MAX_BYTES = 64 << 20

# A key is hot when it alone holds more than 1 / (HOT_FACTOR * shuffle partitions) of the rows, so there
# are fewer than HOT_FACTOR * partitions hot keys whatever the data's size.
HOT_FACTOR = 4

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row position


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: strings by their content, other values 8 bytes."""
    size = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        size = size + (F.coalesce(F.octet_length(f.name), F.lit(0)) + 8 if f.dataType.typeName() == "string" else F.lit(8))
    return size.cast("bigint")


def _order_cols(order_by) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in ([order_by] if isinstance(order_by, (str, Column)) else order_by)]


def max_id(df: DataFrame, id_col: str) -> Column:
    """Scalar subquery ``coalesce(max(id), 0)`` (J6 without a join)."""
    return df.select(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()


def assign_ids(df: DataFrame, id_col: str, order_by, start: Column | int = 0,
               bounded: bool = False) -> DataFrame:
    """Add ``id_col`` = start + 1, 2, ... in ``order_by`` order.

    Rows are range-partitioned and sorted, each row gets its in-partition
    position from ``monotonically_increasing_id``, the result is checkpointed
    to the shared checkpoint folder so positions are stable under task
    retries, and per-partition offsets (one row per partition, a bounded
    table) are broadcast back.

    ``bounded=True``: a global ``row_number`` window, in one partition; only
    for sets that the domain bounds whatever the data's size (minutes of the
    day, districts, resolutions).  Same ids when the order is total.
    """
    start_col = start if isinstance(start, Column) else F.lit(start)
    order = _order_cols(order_by)
    if bounded:
        w = Window.orderBy(*order)
        return df.withColumn(id_col, (start_col + F.row_number().over(w)).cast("bigint"))

    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    from starloom.session import scratch_root
    scratch_root(spark)
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), _POS_BITS)
    counts = placed.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    return (placed.join(F.broadcast(offsets), pid == F.col("_pid"))
            .withColumn(id_col, (start_col + F.coalesce(F.col("_off"), F.lit(0)) + pos + 1).cast("bigint"))
            .drop("_mid", "_pid", "_off"))


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """K2: add constant columns that the input does not carry."""
    return df.withColumns({k: v for k, v in defaults.items() if k not in df.columns})


def checked_broadcast(df: DataFrame, n_bytes: int | None = None,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """K3: broadcast hint only when the bytes are proven small.

    ``n_bytes`` is a known upper bound (measured when the table was
    written); otherwise the rows are measured.  Beyond the bound the frame is
    returned as is and the planner keeps a shuffle join.
    """
    if n_bytes is None:
        n_bytes = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return F.broadcast(df) if n_bytes <= max_bytes else df


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """(``key``) of the keys that hold more than their share of the rows; at most ``HOT_FACTOR`` times
    the shuffle partitions, checkpointed.  Null is never among them."""
    from starloom.session import scratch_root
    scratch_root(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.select(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") * (HOT_FACTOR * parts) > total).select(key).checkpoint(eager=True)


def dimension_join(fact: DataFrame, key: str, dim: DataFrame, dim_key: str, how: str = "inner",
                   n_bytes: int | None = None, counted: DataFrame | None = None,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """K3: ``fact`` with the columns of ``dim`` (without ``dim_key``) where ``key`` equals ``dim_key``.

    A dimension within the bound is broadcast.  A larger one is joined in two parts: rows
    whose key is hot, and (for a left join) rows without a key, stay where they are and
    meet the broadcast dimension rows of the hot keys; only the other rows are shuffled.
    ``how`` is "inner" or "left".  ``counted`` (default: ``fact``) is the frame in which keys are
    counted: the stored table that ``fact`` is derived from, to spare computing ``fact`` for it.
    """
    names = [c for c in dim.columns if c != dim_key]
    hinted = checked_broadcast(dim, n_bytes, max_bytes)

    def joined(rows: DataFrame, other: DataFrame) -> DataFrame:
        return rows.join(other, rows[key] == other[dim_key], how).select(*[rows[c] for c in rows.columns], *[other[c] for c in names])

    if hinted is not dim:
        return joined(fact, hinted)
    hot = hot_keys(fact if counted is None else counted, key).withColumnRenamed(key, "_hot_key")
    # A duplicated dimension key may make the hot rows many, so their bytes are checked as well.
    few = checked_broadcast(dim.join(F.broadcast(hot), dim[dim_key] == hot["_hot_key"], "left_semi"), None, max_bytes)
    marked = fact.join(F.broadcast(hot), fact[key] == F.col("_hot_key"), "left")
    stays = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    return joined(marked.filter(stays).drop("_hot_key"), few).unionByName(
        joined(marked.filter(~stays).drop("_hot_key"), dim))
