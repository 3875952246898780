from pyspark.sql import functions as F

from starloom.operators import dims as D
from starloom.operators.scd import scd_apply, scd_as_of

SPEC = D.SCD_SPECS["dim_intersection"]
STG = "stg_cnn int, stg_intersection string, stg_latitude double, stg_longitude double"


def stg(spark, rows):
    return spark.createDataFrame(rows, STG)


def materialize(spark, df):
    """Each version is written and read back in the pipeline; here: collect."""
    return spark.createDataFrame(df.collect(), df.schema)


def current(dim):
    return {r.cnn: r for r in dim.filter("current_flag = 1").collect()}


def test_scd_history_rerun_and_revert(spark):
    v1 = materialize(spark, D.scd_init(stg(spark, [(1, "A", 1.0, 1.0), (2, "X", 2.0, 2.0), (3, "K", 3.0, 3.0)]), SPEC))
    assert sorted(r.intersection_id for r in v1.collect()) == [1, 2, 3]

    b = [(1, "B", 1.5, 1.0), (2, "X", 2.5, 2.5), (4, "N", 4.0, 4.0)]        # 1 changes, 2 overwrites, 4 new, 3 absent
    v2 = materialize(spark, scd_apply(v1, stg(spark, b), SPEC, "2022-02-01"))
    cur = current(v2)
    assert cur[1].intersection == "B" and cur[1].intersection_id == 4 and str(cur[1].eff_date) == "2022-02-01"
    assert cur[2].latitude == 2.5 and cur[2].intersection_id == 2            # SCD1 overwrite in place
    assert cur[3].intersection == "K"                                        # absent key stays open
    assert cur[4].intersection_id == 5
    old1 = v2.filter("cnn = 1 AND current_flag = 0").collect()
    assert len(old1) == 1 and old1[0].latitude == 1.0 and str(old1[0].exp_date) == "2022-02-01"

    v2b = materialize(spark, scd_apply(v2, stg(spark, b), SPEC, "2022-02-02"))  # rerun: no-op
    assert sorted(map(tuple, v2b.collect())) == sorted(map(tuple, v2.collect()))

    v3 = materialize(spark, scd_apply(v2, stg(spark, [(1, "A", 1.5, 1.0)]), SPEC, "2022-03-01"))  # A -> B -> A
    hist = v3.filter("cnn = 1").orderBy("eff_date").collect()
    assert [h.intersection for h in hist] == ["A", "B", "A"]
    assert [h.current_flag for h in hist] == [0, 0, 1]
    for a, b_ in zip(hist, hist[1:]):                                        # intervals chain, no overlap
        assert a.exp_date == b_.eff_date
    per_key = v3.groupBy("cnn").agg(F.sum("current_flag").alias("n")).collect()
    assert all(r.n == 1 for r in per_key)
    assert {r.intersection for r in scd_as_of(v3, SPEC, "2022-02-15").filter("cnn = 1").collect()} == {"B"}


def test_repeated_staging_key_collapses_deterministically(spark):
    v1 = D.scd_init(stg(spark, [(1, "B", 1.0, 1.0), (1, "A", 9.0, 9.0)]), SPEC).collect()
    assert len(v1) == 1 and v1[0].intersection == "A"


def test_scd_on_empty_dimension_and_empty_batch(spark):
    empty_dim = spark.createDataFrame([], D.scd_init(stg(spark, [(1, "A", 1.0, 1.0)]), SPEC).schema)
    v = scd_apply(empty_dim, stg(spark, [(5, "E", 0.0, 0.0)]), SPEC, "2022-01-01").collect()
    assert [(r.intersection_id, r.cnn, r.current_flag) for r in v] == [(1, 5, 1)]
    v1 = materialize(spark, D.scd_init(stg(spark, [(1, "A", 1.0, 1.0)]), SPEC))
    same = scd_apply(v1, spark.createDataFrame([], STG), SPEC, "2022-01-01")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, v1.collect()))


def test_insert_new_continues_ids(spark):
    spec = D.DIM_SPECS["dim_resolution"]
    dim = D.full_load_dim(spark.createDataFrame([("Open",), ("Closed",)], "stg_resolution string"), spec)
    dim = materialize(spark, dim)
    new = D.insert_new(dim, spark.createDataFrame([("Open",), ("Arrest",), ("Zeta",)], "stg_resolution string"), spec)
    assert sorted((r.resolution_id, r.resolution) for r in new.collect()) == [(3, "Arrest"), (4, "Zeta")]


def test_numbering_follows_the_key_and_continues(spark):
    rows = [(i, f"I{i % 7}", float(i), float(-i)) for i in range(50, 0, -1)]
    a = sorted(map(tuple, D.scd_init(stg(spark, rows), SPEC).collect()))
    assert [r[1] for r in a] == sorted(r[0] for r in rows)            # ids in key order
    v1 = materialize(spark, D.scd_init(stg(spark, rows), SPEC))
    nxt = [(i, f"J{i % 5}", float(i), float(-i)) for i in range(40, 60)]
    x = sorted(map(tuple, scd_apply(v1, stg(spark, nxt), SPEC, "2022-01-01").collect()))
    assert [r[0] for r in x if r[0] > 50] == list(range(51, 51 + len([r for r in x if r[0] > 50])))


def test_null_tracked_value_is_no_change_on_rerun(spark):
    rows = [(1, None, 1.0, 1.0), (2, "A", 1.0, 1.0)]
    v1 = materialize(spark, D.scd_init(stg(spark, rows), SPEC))
    same = materialize(spark, scd_apply(v1, stg(spark, rows), SPEC, "2022-01-01"))
    assert sorted(map(tuple, same.collect()), key=str) == sorted(map(tuple, v1.collect()), key=str)
    changed = scd_apply(same, stg(spark, [(1, "", 1.0, 1.0), (2, None, 1.0, 1.0)]), SPEC, "2022-01-02").collect()
    assert len(changed) == 4 and sum(r.current_flag for r in changed) == 2      # NULL, "" and "A" are three values


def test_collapse_takes_the_least_row_null_first_in_one_aggregate(spark):
    df = spark.createDataFrame([(1, "b", 2.0, 1.0), (1, None, 9.0, 3.0), (2, "b", 2.0, 1.0), (2, "b", 1.0, 7.0)], STG)
    got = D.collapse_per_key(df, df.columns[0], df.columns[1:])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, None, 9.0, 3.0), (2, "b", 1.0, 7.0)]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_apply_joins_the_dimension_once(spark, scratch):
    from starloom.operators.scd import joined_versions
    path = scratch("dim")
    D.scd_init(stg(spark, [(i, "A", 1.0, 1.0) for i in range(50)]), SPEC).write.parquet(path)
    dim, batch = spark.read.parquet(path), stg(spark, [(i, "AB"[i % 2], 2.0, 2.0) for i in range(25, 75)])
    rows = joined_versions(dim, batch, SPEC, "2022-02-01")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 1 and plan.count("Join") == 1 and plan.count("FileScan") == 1
    # 12 changed keys become two rows, 25 keys are new
    assert rows.count() == 50 + 12 + 25 + (1 if 49 % 2 else 0) and rows.filter("intersection_id is null").count() == 12 + 25 + 1
