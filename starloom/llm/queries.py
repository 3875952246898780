"""The registered queries of the operators: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru_lm, quality_crf, quality_rules, toxicity
from .common import crc_bucket, table
from .exact_dedup import exact_dedup
from .filter_audit import audit
from .golay_simhash import hex_fingerprint, near_duplicates
from .line_dedup import line_dedup
from .mixing import Mix
from .packing import pack
from .periodic_runs import periodic_runs, run_digests, with_planted_runs
from .simple8b import token_files
from .substring_dedup import substring_dedup

#: A text is kept if its quality score reaches this (fixed by the contract).
QUALITY = 0.3
#: A text counts as toxic if its score reaches this (fixed by the contract).
TOXIC = 0.7


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(table(spark, sf_dir, "documents")).taken()


def op2_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_crf.learn(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "text")
    return quality_crf.score(rows, model).drop("text").withColumn("predicted", (F.col("score") >= QUALITY).cast("int"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs, keep_text=False)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


def op5_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.language_scores(table(spark, sf_dir, "documents"))


def op6_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


def op8_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(table(spark, sf_dir, "documents"))
    judged = quality_rules.apply_policy(quality_rules.apply_policy(book, quality_rules.BASE, "base"), quality_rules.WEB)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~F.col("base")).alias("base_failed"), "kept")


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op11_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic_runs(docs, keep=["doc_id"]).select("doc_id", *run_digests(F.col("runs"), F.col("collapsed_text")))


def op12_potential_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "text")
    return toxicity.score(rows, model, keep=["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_mix_sources, op2_quality_crf, op3_exact_dedup, op4_substring_dedup, op5_gru_lm, op6_simple8b_tokens,
    op7_line_dedup, op8_rule_ledger, op9_vector_packing, op10_golay_simhash, op11_recompression_runs,
    op12_potential_audit, op13_weak_toxicity)}
