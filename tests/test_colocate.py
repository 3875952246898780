"""The staged fact in buckets: no exchange after it is staged, hot incidents over many tasks, same rows."""

from conftest import SF001
from pyspark.sql import Observation
from pyspark.sql import functions as F

from starloom.operators import colocate as K
from starloom.operators.fact import build_fact
from starloom.plans.full_load import run_full_load
from starloom.plans.incremental import run_incremental
from starloom.registry import natural_fact
from starloom.sources.adapter import batch_one, batch_two, raw_incidents


def test_loads_with_and_without_buckets_are_equal(spark, scratch, monkeypatch):
    monkeypatch.setattr(K, "hot_incidents", lambda clean: K.__dict__["_real"](clean, hot_rows=3))
    monkeypatch.setattr("starloom.plans.full_load.hot_incidents", lambda clean: K.__dict__["_real"](clean, hot_rows=3))
    raw, facts = raw_incidents(spark, SF001), []
    for colocate in (False, True):
        root = scratch(f"wh-{colocate}")
        run_full_load(spark, batch_one(raw), root, load_id="b1", colocate=colocate)
        zones = run_incremental(spark, batch_two(raw), root, as_of="2000-01-01", load_id="b2", colocate=colocate)
        facts.append(natural_fact(zones.prod.tables()))
        counts = spark.read.parquet(f"{root}/audit_unmatched").groupBy("dimension").agg(F.sum("n_unmatched").alias("n")).collect()
        assert {r.n for r in counts} == {0}
    assert facts[0].count() > 0 and facts[0].exceptAll(facts[1]).count() == facts[1].exceptAll(facts[0]).count() == 0
    assert [t for t in spark.catalog.listTables() if t.name.startswith("starloom_buckets")] == []


K._real = K.hot_incidents


def test_fact_of_buckets_moves_no_row_and_spreads_a_hot_incident(spark, scratch):
    zones = run_full_load(spark, raw_incidents(spark, SF001), scratch("wh"))
    staged = zones.stg.read("fact_incident")
    one = staged.limit(1)
    minutes = zones.prod.read("dim_time").select(F.col("full_time").alias("t"))
    hot = one.drop("stg_incident_time", "stg_report_time").join(F.broadcast(minutes.select(F.col("t").alias("stg_incident_time")))).join(
        F.broadcast(minutes.limit(20).select(F.col("t").alias("stg_report_time")))).withColumn("stg_incident_id", F.lit(-7).cast("bigint"))
    n_hot = hot.count()
    both = staged.unionByName(hot)
    groups = both.select(F.col("stg_incident_id").alias("incident_id")).distinct().withColumn("category_group_id", F.lit(1).cast("bigint"))
    plain = build_fact(both, zones.prod.tables(), groups, sizes=zones.prod.sizes())
    found = K._real(both, "stg_incident_id", hot_rows=n_hot // 8)
    assert [(r.hot_incident, r.salts >= 8) for r in found.collect()] == [(-7, True)]
    with K.buckets(spark) as laid:
        laid.count = 16
        fact = laid.write(K.salted(both, found), scratch("fact"), "stg_incident_id")
        sized = fact.filter("stg_incident_id = -7").groupBy("_metadata.file_path").count().collect()   # a file a bucket, a task a bucket
        assert len(sized) >= 4 and max(r["count"] for r in sized) < n_hot / 2
        salts = laid.write(K.per_salt(groups, found), scratch("groups"), "incident_id")
        # Small groups would be broadcast, which needs no bucket: here they are as large as in production.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            for seen in (None, Observation("colocated")):
                laid_fact = build_fact(fact, zones.prod.tables(), salts, sizes=zones.prod.sizes(), unmatched=seen)
                plan = laid_fact._jdf.queryExecution().executedPlan().toString()
                assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == plan.count("Exchange rangepartitioning") == 0
                assert "Bucketed: true" in plan and laid_fact.exceptAll(plain).count() == plain.exceptAll(laid_fact).count() == 0
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
