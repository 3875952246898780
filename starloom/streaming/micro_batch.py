"""The daily incremental load as a Structured Streaming query.

New raw files landing in a folder are picked up with
``trigger(availableNow=True)``; each micro-batch runs the incremental
pipeline (E2) through ``foreachBatch``.  The load id is the streaming
query's id (kept in its checkpoint) and the batch id, and a load id already
committed to the warehouse is skipped: a batch replayed after a failure is a
no-op, while a new checkpoint, which counts batches from 0 again, is a new
query whose batches are all loaded.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.clean import RAW_COLUMNS
from starloom.plans.incremental import run_incremental
from starloom.sources.json_arrays import SOURCE, parse_lines
from starloom.sources.tables import _folder

RAW_STREAM_COLUMNS = RAW_COLUMNS + ["created_at", "updated_at"]


def raw_stream(spark: SparkSession, landing: str, multi_line: bool = False,
               files_per_batch: int | None = None, bytes_per_batch: str | None = None) -> DataFrame:
    """The landing as a stream; a batch takes every new file unless a limit is given.

    Lines that are no records stay in the batch (``_corrupt_record``), and the
    load puts them into quarantine; of array files a damaged one goes as a whole.
    """
    r = spark.readStream
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        r = r.option("maxBytesPerTrigger", bytes_per_batch)
    whole = r.option("wholetext", True) if multi_line else r
    return parse_lines(whole.text(landing).select("value", F.col("_metadata.file_path").alias(SOURCE)), RAW_STREAM_COLUMNS)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query that owns ``checkpoint`` (Spark writes it to ``metadata`` at the start)."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def batch_date(spark: SparkSession, root: str, load_id: str, today: str) -> str:
    """The date a batch is versioned with: written under ``batch_dates`` before its first attempt, read by every later one."""
    path = f"{root.rstrip('/')}/batch_dates/load_id={load_id}"
    known = spark.read.schema("as_of string").parquet(path).first() if _folder(spark, path) else None
    if known:
        return known["as_of"]
    spark.createDataFrame([(today,)], "as_of string").coalesce(1).write.mode("overwrite").parquet(path)
    return today


def run_micro_batches(spark: SparkSession, landing: str, root: str, checkpoint: str,
                      as_of=None, multi_line: bool = False, files_per_batch: int | None = None,
                      bytes_per_batch: str | None = None) -> None:
    """Process every file present in ``landing`` and stop.

    ``as_of`` is a date or a callable of the batch id; by default the date on
    which the batch was first tried, so a replay after midnight versions alike.
    """
    today = _dt.date.today().isoformat()

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        load_id = f"stream-{query_id(spark, checkpoint)}-{batch_id}"
        d = as_of(batch_id) if callable(as_of) else as_of or batch_date(batch.sparkSession, root, load_id, today)
        run_incremental(batch.sparkSession, batch, root, as_of=str(d), load_id=load_id)

    q = (raw_stream(spark, landing, multi_line, files_per_batch, bytes_per_batch).writeStream
         .foreachBatch(apply_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
