from conftest import SF001

from starloom.schemas import STG_SCHEMAS
from starloom.sources.tables import Warehouse, conform, create_tables, load_table, reset_database


def test_reset_and_create_catalog_tables(spark):
    reset_database(spark, "sl_stg")
    create_tables(spark, "sl_stg", STG_SCHEMAS)
    assert {t.name for t in spark.catalog.listTables("sl_stg")} == set(STG_SCHEMAS)
    spark.createDataFrame([("Open",)], "stg_resolution string").write.insertInto("sl_stg.dim_resolution")
    assert spark.table("sl_stg.dim_resolution").count() == 1
    reset_database(spark, "sl_stg")
    assert spark.catalog.listTables("sl_stg") == []


def test_truncate_append_column_list_and_failed_load(spark, scratch):
    wh = Warehouse(spark, scratch("wh"), STG_SCHEMAS)
    df = spark.createDataFrame([("Open",), ("Closed",)], "stg_resolution string")
    load_table(wh, "dim_resolution", df, "truncate", "l1")
    load_table(wh, "dim_resolution", df, "append", "l2")
    load_table(wh, "dim_resolution", df, "append", "l2")          # rerun of a load replaces it
    wh.commits.commit()
    assert wh.read("dim_resolution").count() == 4
    load_table(wh, "dim_resolution", df, "append", "l3")          # never committed: invisible
    fresh = Warehouse(spark, wh.root, STG_SCHEMAS)
    assert fresh.read("dim_resolution").count() == 4
    load_table(wh, "dim_resolution", df.limit(1), "truncate", "l4")
    wh.commits.commit()
    assert Warehouse(spark, wh.root, STG_SCHEMAS).read("dim_resolution").count() == 1
    sub = conform(spark.createDataFrame([(7, 1)], "stg_incident_id bigint, x int"), STG_SCHEMAS["fact_incident"],
                  ["stg_incident_id"]).first()
    assert sub.stg_incident_id == 7 and sub.stg_cnn is None


def test_pipeline_writes_audit_rows(spark, scratch):
    from starloom.plans.full_load import run_full_load
    from starloom.sources.adapter import raw_incidents
    raw = raw_incidents(spark, SF001)
    z = run_full_load(spark, raw, scratch("audit"))
    audit = {r.outcome: r.n_rows for r in spark.read.parquet(f"{z.root}/audit").collect()}
    assert sum(audit.values()) == raw.count()
    assert audit["kept"] == z.stg.read("fact_incident").count()
    unmatched = {r.dimension: r.n_unmatched for r in spark.read.parquet(f"{z.root}/audit_unmatched").collect()}
    assert len(unmatched) == 8 and set(unmatched.values()) == {0}   # a full load resolves every key


def test_scans_push_filters_and_prune(spark, scratch):
    from pyspark.sql import functions as F
    from starloom.operators.clean import filter_from_date
    from starloom.sources.adapter import raw_incidents
    from starloom.sources.zones import read_zone, write_zone
    path = scratch("zone")
    write_zone(raw_incidents(spark, SF001).select("incident_id", "incident_datetime", "resolution", "cnn"), path)
    q = filter_from_date(read_zone(spark, path), "1997-01-01").select("incident_id")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(incident_datetime,1997-01-01" in plan
    assert "ReadSchema: struct<incident_id:bigint,incident_datetime:timestamp_ntz>" in plan

    wh = Warehouse(spark, scratch("wh"), STG_SCHEMAS, fresh=True)
    df = spark.createDataFrame([("Open",)], "stg_resolution string")
    load_table(wh, "dim_resolution", df, "truncate", "l1")
    load_table(wh, "dim_resolution", df, "append", "l2")
    wh.commits.commit()
    import re
    plan = wh.read_load("dim_resolution", "l2")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*load_id#\d+ = l2", plan)   # only the load's own partition is read
    plan = wh.read("dim_resolution")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan                                    # attempts that do not count are not opened


def test_history_does_not_depend_on_file_order(spark, scratch):
    wh = Warehouse(spark, scratch("wh"), STG_SCHEMAS, fresh=True)
    for n, load in ((2, "b1"), (30, "b2"), (5, "b3")):
        for _ in range(3):                                            # several writes of a load: the last counts
            load_table(wh, "dim_resolution", spark.range(n).selectExpr("cast(id as string) stg_resolution"), "append", load)
        wh.commits.commit()
    m = Warehouse(spark, wh.root, STG_SCHEMAS).commits
    at = {b: Warehouse(spark, wh.root, STG_SCHEMAS, m.upto(b)) for b in ("b1", "b2", "b3")}
    assert [at[b].load_ids("dim_resolution") for b in at] == [["b1"], ["b1", "b2"], ["b1", "b2", "b3"]]
    assert m.state().count() == 3                                       # a commit holds the whole state
    assert {b: w.row_count("dim_resolution") for b, w in at.items()} == {"b1": 2, "b2": 32, "b3": 37}
    assert {b: w.read("dim_resolution").count() for b, w in at.items()} == {"b1": 2, "b2": 32, "b3": 37}


def test_failed_attempt_then_empty_retry_leaves_nothing_behind(spark, scratch):
    root = scratch("wh")
    df = spark.createDataFrame([("Open",), ("Closed",)], "stg_resolution string")
    wh = Warehouse(spark, root, STG_SCHEMAS)
    load_table(wh, "dim_resolution", df, "truncate", "l1")
    wh.commits.commit()
    failed = Warehouse(spark, root, STG_SCHEMAS)                      # never commits
    load_table(failed, "dim_resolution", spark.createDataFrame([("BAD",)] * 2, "stg_resolution string"), "append", "l2")
    retry = Warehouse(spark, root, STG_SCHEMAS)
    load_table(retry, "dim_resolution", df.limit(0), "append", "l2")
    retry.commits.commit()
    now = Warehouse(spark, root, STG_SCHEMAS)
    assert now.read("dim_resolution").count() == now.row_count("dim_resolution") == 2
    from starloom.sources.tables import retain
    deleted = retain([now], keep_commits=2)
    assert len(deleted) == 1 and "/load_id=l2/" in deleted[0]         # the failed attempt's partition
    assert Warehouse(spark, root, STG_SCHEMAS).read("dim_resolution").count() == 2


def test_damaged_log_is_an_error(spark, scratch):
    import pytest
    wh = Warehouse(spark, scratch("wh"), STG_SCHEMAS, fresh=True)
    load_table(wh, "dim_resolution", spark.createDataFrame([("Open",)], "stg_resolution string"), "truncate", "l1")
    wh.commits.commit()
    broken = f"{wh.commits.path}/commit=2"
    spark.createDataFrame([("{broken",)], "value string").coalesce(1).write.text(broken)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(broken).getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(hadoop.Path(broken)):
        if f.getPath().getName().endswith(".txt"):
            fs.rename(f.getPath(), hadoop.Path(f"{broken}/part-0.parquet"))
    with pytest.raises(Exception, match="CANNOT_READ|not a Parquet|FAILED_READ"):
        Warehouse(spark, wh.root, STG_SCHEMAS).read("dim_resolution").count()


def test_replace_keys_writes_only_loads_that_hold_one_again(spark, scratch):
    wh = Warehouse(spark, scratch("wh"), STG_SCHEMAS, fresh=True)

    def rows(*ids):
        return spark.createDataFrame([(i, i % 3) for i in ids], "stg_incident_id bigint, stg_category_code int").selectExpr(
            "*", *[f"cast(null as string) {c}" for c in STG_SCHEMAS["fact_incident"].fieldNames() if c not in ("stg_incident_id", "stg_category_code")])
    for load, ids in (("a", (1, 2, 3)), ("b", (3, 4)), ("c", (5, 6)), ("odd id/%=é", (7, 3))):
        wh.append("fact_incident", rows(*ids), load)
    wh.commits.commit()
    before = {r.load_id: r.attempt for r in wh.live("fact_incident").collect()}
    wh.replace_keys("fact_incident", rows(3, 7, 9), "stg_incident_id", "d")
    for now in (wh, None):
        now = now or Warehouse(spark, wh.root, STG_SCHEMAS)
        got = {i: sorted(r.stg_incident_id for r in now.read_load("fact_incident", i).collect()) for i in [*before, "d"]}
        assert got == {"a": [1, 2], "b": [4], "c": [5, 6], "odd id/%=é": [], "d": [3, 7, 9]}
        assert now.read("fact_incident").count() == now.row_count("fact_incident") == 8
        wh.commits.commit()
    after = {r.load_id: r.attempt for r in Warehouse(spark, wh.root, STG_SCHEMAS).live("fact_incident").collect()}
    assert after["c"] == before["c"] and after["a"] == after["b"] != before["a"]
    assert all(wh.has_load("fact_incident", i) for i in (*before, "d")) and not wh.has_load("fact_incident", "e")


def test_hot_day_is_split_by_its_size(spark, scratch):
    from starloom.sources.zones import read_zone, write_dated
    root = scratch("hot-day")
    df = spark.range(9000).selectExpr("if(id < 8000, '2022-01-01', concat('2022-02-0', id % 9 + 1)) ds", "id v", "sha2(cast(id as string), 256) x")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        write_dated(df.repartition(6), root)
    finally:
        spark.conf.set(name, before)
    files = read_zone(spark, root).filter("ds = '2022-01-01'").select("v", "_metadata.file_path")
    assert files.count() == 8000 and files.select("file_path").distinct().count() >= 3


def test_oversize_batch_leaves_the_warehouse_as_it_was(spark, scratch):
    import pytest
    from starloom.plans.full_load import Zones, run_full_load
    from starloom.plans.incremental import run_incremental
    from starloom.sources.adapter import batch_one, batch_two, raw_incidents
    from starloom.sources.zones import SizeGateError, batch_stats
    raw, root = raw_incidents(spark, SF001), scratch("gate")
    one, two = batch_one(raw), batch_two(raw)
    size = batch_stats(one).first()
    with pytest.raises(SizeGateError):
        run_full_load(spark, one, root, load_id="b1", max_bytes=size.n_bytes - 1)
    assert Zones.open(spark, root).commits.number == 0
    run_full_load(spark, one, root, load_id="b1", max_bytes=size.n_bytes, max_rows=size.n_rows)
    before = Zones.open(spark, root)
    with pytest.raises(SizeGateError):
        run_incremental(spark, two, root, as_of="2000-01-01", load_id="b2", max_rows=10)
    after = Zones.open(spark, root)
    assert after.commits.number == before.commits.number and after.prod.sizes() == before.prod.sizes()
    assert spark.read.parquet(f"{root}/audit").filter("load_id = 'b2'").count() == 0


def test_size_gate(spark):
    import pytest
    from starloom.sources.zones import SizeGateError, batch_stats, size_gate
    df = spark.createDataFrame([("ab", 12, None), ("é", None, 1.5)], "s string, i int, d double")
    assert tuple(batch_stats(df).first()) == (2, 2 + 2 + 2 + 3)        # every column counts, as UTF-8 text
    assert size_gate(df) is df and size_gate(df, max_bytes=9, max_rows=2) is df
    for limit in ({"max_bytes": 8}, {"max_rows": 1}):
        with pytest.raises(SizeGateError):
            size_gate(df, **limit)


def test_dated_layout_rerun_replaces_only_its_days(spark, scratch):
    from starloom.sources.zones import read_zone, write_dated
    root = scratch("dated")
    df = spark.createDataFrame([("2022-01-01", i) for i in range(5)] + [("2022-01-02", i) for i in range(3)],
                               "ds string, v int")
    write_dated(df, root)
    write_dated(spark.createDataFrame([("2022-01-01", 99)], "ds string, v int"), root)
    got = {(str(r.ds), r.n) for r in read_zone(spark, root).groupBy("ds").count().withColumnRenamed("count", "n").collect()}
    assert got == {("2022-01-01", 1), ("2022-01-02", 3)}
