"""Zone I/O and ingest-window operators.

Raw files are JSON (arrays of records as delivered by an open-data API, or
JSON lines); every value is read as a string and typed by the cleaning
step, since the API may quote numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.json_arrays import CORRUPT, SOURCE, parse_lines, read_json_arrays


class SizeGateError(RuntimeError):
    """A batch is larger than the configured limit."""


def read_raw(spark: SparkSession, path: str, columns: list[str], multi_line: bool = True, damaged: bool = False) -> DataFrame:
    """JSON records with every listed column read as a string.

    ``multi_line=True`` reads files holding one JSON array of records each (a
    large file by several tasks), ``False`` reads JSON lines.  What is not a
    record is left out, or with ``damaged`` comes as a row of its own: its text
    in ``_corrupt_record``, NULL for records, and the file in ``_source_file``.
    """
    if multi_line:
        rows = read_json_arrays(spark, path, columns)
    else:
        rows = parse_lines(spark.read.text(path).select("value", F.col("_metadata.file_path").alias(SOURCE)), columns)
    return rows if damaged else sound(rows).select(*columns)


def sound(raw: DataFrame) -> DataFrame:
    """The rows of ``read_raw(damaged=True)`` that are records."""
    return raw.filter(F.col(CORRUPT).isNull()) if CORRUPT in raw.columns else raw


def quarantined(raw: DataFrame) -> DataFrame:
    """What of a raw batch is no record: file, text, and what could be read of it (as JSON)."""
    rest = [c for c in raw.columns if c not in (CORRUPT, SOURCE)]
    return raw.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(SOURCE).alias("source_file"), F.col(CORRUPT).alias("record_text"), F.to_json(F.struct(*rest)).alias("read_as"))


def read_zone(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet dataset (pruning and pushdown by the scan)."""
    return spark.read.parquet(path)


def write_zone(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """S3: replace a Parquet dataset (only the written partitions when
    ``partition_by`` is set)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, compression: str | None = None, rows_per_file: int = 1_000_000) -> None:
    """JSON lines.  Compressed files (``gzip``) take about a tenth of the room, but each is read by one task,
    so they hold at most ``rows_per_file`` rows."""
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression).option("maxRecordsPerFile", rows_per_file)
    w.json(path)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int | None = 50_000, end: str = "]", append: bool = False) -> None:
    """JSON files that each hold one array of records, as an API delivers its
    pages; about ``rows_per_file`` records each (``None``: one file).  ``end`` is
    what closes an array: anything but a bracket makes files that were cut off.

    A page is a partition, and its file is written record by record, a line each:
    what comes first opens the array, and a row without a record, which comes last, closes
    it.  So a task holds a record at a time, never a page, and no file holds two arrays.
    """
    n = max(1, -(-df.count() // rows_per_file)) if rows_per_file else 1
    page = F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int")
    rows = df.select(page.alias("page"), F.struct(*df.columns).alias("record"))
    ends = df.sparkSession.range(n).select(F.col("id").cast("int"), F.lit(None).cast(rows.schema["record"].dataType))
    rows = rows.union(ends).repartitionById(n, "page").sortWithinPartitions(F.col("record").isNull())
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    more = F.when(first, "[").when(F.col("record").isNotNull(), ",").otherwise("")
    lines = rows.select(F.concat(more, F.coalesce(F.to_json("record"), F.lit(end))).alias("value"))
    lines.write.mode("append" if append else "overwrite").option("maxRecordsPerFile", 0).text(path)


def as_raw_strings(df: DataFrame) -> DataFrame:
    """Every column as a string, as an API delivers it (timestamps ISO-8601)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            cols.append(F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*cols)


def write_dated(df: DataFrame, root: str, ds_col: str = "ds") -> None:
    """Dated layout ``root/ds=YYYY-MM-DD``; a rerun replaces only its days.

    ``REBALANCE`` on the day gathers each day's rows into few files; from the
    sizes of the shuffle the engine splits a hot day over as many tasks as it
    has target sizes (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and
    joins small days.  The input is evaluated once.
    """
    (df.hint("rebalance", ds_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(ds_col).parquet(root))


def change_window(df: DataFrame, since: str, created: str = "created_at",
                  updated: str = "updated_at") -> DataFrame:
    """Rows created or updated at or after ``since``; no upper bound."""
    ts = F.to_timestamp_ntz(F.lit(since))
    inside = (F.col(created) >= ts) | (F.col(updated) >= ts)
    if CORRUPT in df.columns:               # what could not be read has no dates, and stays visible
        inside = inside | F.col(CORRUPT).isNotNull()
    return df.filter(inside)


def full_extract(df: DataFrame, from_date: str | None = None, **cols) -> DataFrame:
    """Everything, or the change window from ``from_date``."""
    return change_window(df, from_date, **cols) if from_date else df


def row_cap(df: DataFrame, n: int | None, order_by: list[str]) -> DataFrame:
    """At most ``n`` rows, deterministically ordered (Q13); no cap when None."""
    if n is None:
        return df
    return df.orderBy(*order_by).limit(n)


def batch_measures(df: DataFrame) -> dict[str, Column]:
    """Rows and payload bytes of a batch as aggregates: every column's value as text, in UTF-8 (not the file names)."""
    size = F.lit(0).cast("bigint")
    for c in df.columns:
        if c != SOURCE:
            size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("bigint")
    return {"n_rows": F.count(F.lit(1)), "n_bytes": F.coalesce(F.sum(size), F.lit(0)).cast("bigint")}


def batch_stats(df: DataFrame) -> DataFrame:
    """Rows and payload bytes of a batch."""
    return df.agg(*[m.alias(k) for k, m in batch_measures(df).items()])


def check_size(n_rows: int, n_bytes: int, max_bytes: int | None, max_rows: int | None) -> None:
    """Raise ``SizeGateError`` when a measured batch exceeds a given limit (Q16)."""
    if (max_rows is not None and n_rows > max_rows) or (max_bytes is not None and n_bytes > max_bytes):
        raise SizeGateError(f"batch of {n_rows} rows / {n_bytes} bytes exceeds the limit")


def size_gate(df: DataFrame, max_bytes: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Raise ``SizeGateError`` when the batch exceeds a given limit (Q16).

    One aggregate job measures the payload itself, not a Python object;
    without a limit nothing is measured.  The pipelines measure in the job that
    lands the batch instead, and withhold the rest of the load.
    """
    if max_bytes is None and max_rows is None:
        return df
    row = batch_stats(df).first()
    check_size(row["n_rows"], row["n_bytes"], max_bytes, max_rows)
    return df
