"""Registered queries against DuckDB where SQL can express them; the pipeline against brute force."""

import brute
import duckdb
import numpy as np
import pytest
import samples
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm.oracle import SQL
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, SF)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(want.select(*cols).fetchall(), key=str)


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_simhash_and_packing_queries_cover_their_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [brute.fingerprint(t) for _, t in rows]
    want = sorted(zip([d for d, _ in rows], [f"{f:016x}" for f in fps], brute.components(fps, [d for d, _ in rows])))
    assert sorted(map(tuple, QUERIES["op10_golay_simhash"](spark, SF).collect())) == want
    packed = QUERIES["op9_vector_packing"](spark, SF)
    tokens = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all"))
    assert tokens.count() == len(rows) and tokens.filter("n <> all").count() == 0


def test_stages_follow_each_other(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}, docs
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, before, SF)
        assert after.columns == columns
        got = {r.doc_id: r.text for r in after.collect()}
        assert len(got) == after.count() and set(got.items()) <= set(kept.items())
        gone = set(kept) - set(got)
        if name == "quality":
            assert not [d for d in gone if labels.get(d) == 1] and [d for d in gone if labels.get(d) == 0]
        if name == "exact_dedup":
            last = {}
            for d, t in kept.items():
                last[t] = max(d, last.get(t, d))
            assert set(got) == set(last.values())
        if name == "near_dedup":
            named = brute.components([brute.fingerprint(t) for t in kept.values()], list(kept))
            assert set(got) == set(named)
        kept, before = got, spark.createDataFrame(after.collect(), docs.schema)
    mixed = corpus_pipeline.mix(spark, before, SF)
    assert mixed.columns == columns and {r.doc_id for r in mixed.select("doc_id").collect()} <= set(kept)
    times = np.array([r["count"] for r in mixed.groupBy("doc_id").count().collect()])
    assert times.max() <= 3
    pieces = corpus_pipeline.packing(spark, mixed, SF)
    n = mixed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"))
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t")).join(n, "doc_id")
    assert whole.filter("n <> k * t").count() == 0 and whole.count() == n.count()


def test_run_returns_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:2] == ["doc_id", "start"] and out.count() > 0
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_stages_take_odd_and_empty_tables(spark):
    labels_dir = SF
    for df in (samples.odd(spark), samples.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, labels_dir)
            if name != "packing":
                assert out.columns == df.columns
            out.collect()
