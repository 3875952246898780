"""The corpus pipeline: quality, exact and near deduplication, mixing, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that its predecessor kept; its result
is written as Parquet to the shared folder and read back as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``; the mix repeats a row for each time it is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import quality_crf
from starloom.llm.common import free_name, on_workers, stored, table
from starloom.llm.exact_dedup import exact_dedup
from starloom.llm.golay_simhash import keep_one
from starloom.llm.mixing import Mix
from starloom.llm.packing import MAX_TOKENS, pack
from starloom.llm.queries import QUALITY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality_crf.learn(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "quality_score")
    return quality_crf.score(docs, model, out=name).filter(F.col(name) >= QUALITY).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    kept = free_name(docs, "kept")
    return exact_dedup(docs).filter(F.col(kept)).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest doc_id stays (of equal ids by the text's digest)."""
    return keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, shuffled within shards."""
    return Mix(docs).shuffled()


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return pack(docs, max_segments=MAX_TOKENS)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", packing)]

#: No SQL: trained models, random draws and a tokenizer.  tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_workers(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
