from pyspark.sql import functions as F

from starloom.operators import bridge as B
from starloom.operators.keys import assign_ids, checked_broadcast


def test_distributed_ids_equal_window_ids(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.concat(F.lit("g"), F.lpad((F.col("id") * 7919 % 5000).cast("string"), 6, "0")).alias("k"))
    a = {r.k: r.i for r in assign_ids(df, "i", "k", start=10, bounded=True).collect()}
    b = {r.k: r.i for r in assign_ids(df, "i", "k", start=10).collect()}
    assert a == b and sorted(a.values()) == list(range(11, 5011))


def test_checked_broadcast_respects_bound(spark):
    df = spark.range(10).withColumn("s", F.lit("x" * 100))          # 10 rows of 8 and 108 bytes
    plan_small = spark.range(100).join(checked_broadcast(df, max_bytes=1160), "id")._jdf.queryExecution().toString()
    assert "broadcast" in plan_small.lower()
    assert checked_broadcast(df, max_bytes=1159) is df
    assert checked_broadcast(df, n_bytes=1 << 40) is df


def test_signature_keeps_duplicates_in_numeric_order(spark):
    df = spark.createDataFrame([(1, 10), (1, 9), (1, 10), (2, 2), (3, 9), (3, 10), (3, 10)], "inc int, code int")
    got = {r.inc: r.signature for r in B.group_signature(df, "inc", "code").collect()}
    assert got == {1: "9,10*2", 2: "2", 3: "9,10*2"}
    numbered = B.number_groups(B.group_signature(df, "inc", "code"))
    assert {r.signature: r.group_id for r in numbered.collect()} == {"2": 1, "9,10*2": 2}
    members = sorted(map(tuple, B.explode_signature(numbered, "group_id").collect()))
    assert members == [(1, 2), (2, 9), (2, 10), (2, 10)]             # duplicates come back in the rows


def test_members_beyond_32_bits_and_signatures_without_the_bridge(spark):
    big = 3_000_000_000
    df = spark.createDataFrame([(1, big), (1, big), (1, 7), (2, 7)], "inc bigint, code bigint")
    groups = B.number_groups(B.group_signature(df, "inc", "code"))
    dim = spark.createDataFrame([(big, big + 1), (7, 8)], "category_code bigint, category_id bigint")
    bridge = B.bridge_full_load(groups, dim)
    assert sorted(r.category_id for r in bridge.collect()) == [8, 8, big + 1, big + 1]
    assert sorted(map(tuple, B.category_signatures(groups, dim).collect())) == sorted(map(tuple, B.bridge_signatures(bridge).collect()))
    again = B.bridge_insert_new(bridge, spark.createDataFrame([(9, f"8,{big + 1}*3")], "incident_id bigint, category_id_group string"))
    assert sorted(r.category_id for r in again.collect()) == [8] + [big + 1] * 3


def test_bridge_insert_new_and_group_dim(spark):
    empty = spark.createDataFrame([], "category_group_id bigint, category_id bigint")
    incoming = spark.createDataFrame([(1, "3,4"), (2, "5"), (3, "3,4")], "incident_id bigint, category_id_group string")
    first = B.bridge_insert_new(empty, incoming).collect()       # empty bridge: ids start at 1 (Q3)
    assert sorted(map(tuple, first)) == [(1, 3), (1, 4), (2, 5)]
    bridge = spark.createDataFrame(first, "category_group_id bigint, category_id bigint")
    nxt = spark.createDataFrame([(4, "5"), (5, "3,6"), (6, "1")], "incident_id bigint, category_id_group string")
    added = sorted(map(tuple, B.bridge_insert_new(bridge, nxt).collect()))
    assert added == [(3, 1), (4, 3), (4, 6)]                      # only unseen groups (Q2), after max id
    gdim = spark.createDataFrame([], "category_group_id bigint")   # empty group dim still filled (Q4)
    assert sorted(r.category_group_id for r in B.group_dim_insert_new(gdim, bridge).collect()) == [1, 2]


def test_known_groups_open_only_the_prefixes_of_the_batch(spark, scratch):
    from starloom.operators import bridge as B
    rows = spark.range(1, 2001).selectExpr("id category_group_id", "concat(id, ',', id + 1) category_id_group")
    path = scratch("index")
    B.write_by_prefix(rows, path)
    index = spark.read.schema("category_group_id bigint, category_id_group string, prefix int").parquet(path)
    batch = spark.createDataFrame([(1, "5,6"), (2, "5,6"), (3, "9,9"), (4, "1000,1001")], "incident_id bigint, category_id_group string")
    known = B.known_groups(index, batch)
    assert "dynamicpruning" in known._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, known.collect())) == [(5, "5,6"), (1000, "1000,1001")]
    new = B.new_groups(known, batch, F.lit(2000)).collect()
    assert [tuple(r) for r in new] == [(2001, "9,9")]
    scanned = spark.read.parquet(path).filter(F.col("prefix").isin([r[0] for r in batch.select(B.signature_prefix()).distinct().collect()]))
    assert scanned.count() < 400


def test_batches_look_up_what_earlier_ones_numbered(spark, scratch):
    from conftest import SF001
    from starloom.plans.full_load import run_full_load
    from starloom.plans.incremental import run_incremental
    from starloom.sources.adapter import raw_incidents
    raw, root = raw_incidents(spark, SF001), scratch("idx")
    third = F.col("incident_id") % 3
    run_full_load(spark, raw.filter(third == 0), root)
    for i, day in ((1, "2000-01-01"), (2, "2000-01-02")):
        z = run_incremental(spark, raw.filter((third == i) | (F.col("incident_id") % 12 == 0)), root, as_of=day, load_id=f"d{i}")
    idx = z.idx.read("group_signature")
    n = idx.count()
    assert idx.select("category_id_group").distinct().count() == n == z.idx.row_count("group_signature")
    assert sorted(r[0] for r in idx.select("category_group_id").collect()) == list(range(1, n + 1))
    assert z.prod.read("dim_category_group").count() == n
