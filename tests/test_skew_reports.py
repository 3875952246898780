from conftest import SF001
from pyspark.sql import functions as F

from starloom.operators import bridge as B


def test_hot_incident_signature_is_exact(spark):
    # incident 0 holds 3,000,000 rows (codes 1..5); its signature is bounded by its distinct codes
    hot = spark.range(3_000_000).select(F.lit(0).alias("inc"), ((F.col("id") % 5) + 1).cast("int").alias("code"))
    rest = spark.range(6000).select((F.col("id") % 2000 + 1).alias("inc"), ((F.col("id") % 3) + 1).cast("int").alias("code"))
    df = hot.unionByName(rest)
    sig = {r.inc: r.signature for r in B.group_signature(df, "inc", "code").collect()}
    assert sig[0] == ",".join(f"{c}*600000" for c in range(1, 6))
    assert len(sig) == 2001
    plan = B.group_signature(df, "inc", "code")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.rindex("Exchange"):]                  # below the first exchange: pre-aggregated rows
    assert "partial_count" in before_shuffle


def test_report_filters(spark, scratch):
    from starloom.operators.reports import report_daily, report_year, report_year_rollup
    from starloom.plans.full_load import run_full_load
    from starloom.sources.adapter import raw_incidents
    z = run_full_load(spark, raw_incidents(spark, SF001), scratch("rep"), fresh=True)
    wh = z.prod.tables()
    all_years = report_year(wh)
    y = all_years.agg(F.min("year")).first()[0]
    one = report_year(wh, y)
    assert one.count() == all_years.filter(F.col("year") == y).count() > 0
    d = report_daily(wh).agg(F.min("full_date")).first()[0]
    assert report_daily(wh, d).count() == report_daily(wh).filter(F.col("full_date") == d).count() > 0
    total = report_year_rollup(wh).filter(F.col("year").isNull()).first().n_incidents
    assert total == z.prod.read("fact_incident").select("incident_id").distinct().count()


def test_rollup_merges_bitmaps(spark, scratch):
    # ids above and below zero, sparse ones, rows that repeat an incident in several months and districts
    fact = spark.sql("""SELECT CAST(id % 70 AS int) AS incident_date, CAST(id % 7 AS int) AS police_district_id,
                        (id % 4001 - 2000) * 1000003 AS incident_id FROM range(20000)""")
    dates = spark.sql("SELECT CAST(id AS int) AS date_id, CAST(2000 + id div 40 AS int) AS year, CAST(id div 10 AS int) AS month FROM range(70)")
    pds = spark.sql("SELECT CAST(id AS int) AS police_district_id, concat('d', id) AS police_district FROM range(7)")
    wh = {"fact_incident": fact, "dim_date": dates, "dim_police_district": pds}
    from starloom.operators.reports import report_year_rollup
    want = sorted((fact.join(dates, fact.incident_date == dates.date_id).join(pds, "police_district_id")
                   .rollup("year", "month", "police_district").agg(F.count_distinct("incident_id")).collect()), key=str)
    for dense in (True, False, None):
        out = report_year_rollup(wh, dense=dense)
        assert sorted(out.collect(), key=str) == want
        assert all("report-bitmaps-" in f for f in out.inputFiles())             # only stored bitmaps are read
        assert "incident_id" not in out._jdf.queryExecution().executedPlan().toString()
    empty = report_year_rollup({**wh, "fact_incident": fact.limit(0)}).collect()
    assert [tuple(r) for r in empty] == [(None, None, None, 0)]


def test_oversize_dimension_keeps_hot_rows_in_place(spark, scratch):
    from starloom.operators.keys import dimension_join
    fact = spark.sql("""SELECT id, CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 11 = 1 THEN NULL WHEN id % 50 = 2 THEN 'gone'
                        ELSE concat('k', id % 5000) END AS k FROM range(30000)""")
    dim = spark.sql("SELECT 'hot' AS name, 0L AS dim_id UNION ALL SELECT concat('k', id), id + 1 FROM range(5000)")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)                   # as if the dimension were large
    try:
        for how in ("inner", "left"):
            want = sorted(fact.join(dim, fact.k == dim.name, how).select("id", "k", "dim_id").collect(), key=str)
            got = dimension_join(fact, "k", dim, "name", how, max_bytes=1000)
            assert got.columns == ["id", "k", "dim_id"] and sorted(got.collect(), key=str) == want
            plan = dimension_join(fact, "k", dim, "name", how, max_bytes=1000)._jdf.queryExecution().executedPlan().toString()
            stays, moves = plan.split("\n   :- ")[1].split("\n   +- ")[:2]
            assert "SortMergeJoin" in moves and "BroadcastHashJoin" in stays
            # where hot rows meet their dimension rows, no rows of the fact are exchanged
            first = stays[:stays.index("Range (0, 30000")]
            assert "hashpartitioning" not in first and "SortMergeJoin" not in first
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    near = dimension_join(fact, "k", dim, "name")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in near and "hashpartitioning" not in near
    flat = fact.withColumn("k", F.concat(F.lit("k"), F.col("id") % 5000))            # no hot key: all rows take the shuffle join
    assert dimension_join(flat, "k", dim, "name", max_bytes=1000).count() == 30000
