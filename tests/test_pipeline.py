from conftest import SF001
from pyspark.sql import functions as F

from starloom.plans.full_load import Zones, run_full_load
from starloom.plans.incremental import run_incremental
from starloom.registry import natural_fact
from starloom.sources.adapter import batch_two, raw_incidents


def test_full_equals_full_plus_incremental_without_changes(spark, scratch):
    raw = raw_incidents(spark, SF001)
    split = F.col("incident_datetime") < F.to_timestamp_ntz(F.lit("1998-01-01"))
    all_root, inc_root = scratch("all"), scratch("inc")
    full = run_full_load(spark, raw, all_root)
    run_full_load(spark, raw.filter(split), inc_root, load_id="b1")
    inc = run_incremental(spark, raw.filter(~split), inc_root, as_of="1998-01-01", load_id="b2")
    a, b = natural_fact(full.prod.tables()), natural_fact(inc.prod.tables())
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # the stored signature index equals the bridge's signatures, one group per signature
    from starloom.operators.bridge import bridge_signatures
    idx, derived = inc.idx.read("group_signature"), bridge_signatures(inc.prod.read("br_category_group"))
    assert idx.exceptAll(derived).count() == 0 and derived.exceptAll(idx).count() == 0
    assert idx.select("category_id_group").distinct().count() == idx.count()
    # every fact key resolves
    f = inc.prod.read("fact_incident")
    assert f.join(inc.prod.read("dim_category_group"), "category_group_id", "left_anti").count() == 0

    # a retried load id is a no-op, a repeated batch adds no dimension rows or groups
    before = {t: inc.prod.read(t).count() for t in inc.prod.schemas}
    again = run_incremental(spark, raw.filter(~split), inc_root, as_of="1998-01-02", load_id="b2")
    assert {t: again.prod.read(t).count() for t in again.prod.schemas} == before
    rep = run_incremental(spark, raw.filter(~split), inc_root, as_of="1998-01-03", load_id="b3")
    after = {t: rep.prod.read(t).count() for t in rep.prod.schemas}
    for t in ("dim_intersection", "dim_category", "br_category_group", "dim_category_group", "dim_date", "dim_time"):
        assert after[t] == before[t], t


def test_reopen_reads_committed_state(spark, scratch):
    raw = raw_incidents(spark, SF001)
    root = scratch("reopen")
    z = run_full_load(spark, raw, root)
    z2 = Zones.open(spark, root)
    assert z2.prod.sizes() == z.prod.sizes()
    assert z2.prod.read("fact_incident").count() == z.prod.row_count("fact_incident")


def test_fact_plan_broadcasts_dims_without_cartesian(spark, scratch):
    from starloom.operators import bridge as B
    from starloom.operators.fact import build_fact, incident_groups_full
    z = run_full_load(spark, raw_incidents(spark, SF001), scratch("plan"))
    stg = z.stg.read("fact_incident")
    groups = B.number_groups(B.group_signature(stg, "stg_incident_id", "stg_category_code"))
    fact = build_fact(stg, z.prod.tables(), incident_groups_full(stg, groups), sizes=z.prod.sizes())
    plan = fact._jdf.queryExecution().executedPlan().toString()
    # seven lookups, the group ids onto the signatures, and the offsets of the group numbering; beside them
    # each table read is joined with its live attempts
    assert plan.count("BroadcastHashJoin") - plan.count("LeftSemi, BuildRight") == 9
    # the fact: its distinct and its join on the incident; the signatures: by (incident, code) and by
    # incident; the numbering: one row per partition
    assert plan.count("Exchange hashpartitioning(") == 5
    assert "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_streaming_micro_batches(spark, scratch):
    from starloom.sources import zones as Z
    from starloom.streaming.micro_batch import run_micro_batches
    raw = raw_incidents(spark, SF001)
    landing, root, ckpt = scratch("landing"), scratch("wh"), scratch("ckpt")
    Z.write_json(Z.as_raw_strings(raw.filter(F.col("incident_datetime") < F.to_timestamp_ntz(F.lit("1998-01-01")))),
                 f"{landing}/d=1")
    run_micro_batches(spark, f"{landing}/*/*.json", root, ckpt, as_of="1998-01-01")
    n1 = Zones.open(spark, root).prod.read("fact_incident").count()
    Z.write_json(Z.as_raw_strings(batch_two(raw, changed=False)), f"{landing}/d=2")
    run_micro_batches(spark, f"{landing}/*/*.json", root, ckpt, as_of="1998-01-01")
    z = Zones.open(spark, root)
    n = z.prod.read("fact_incident").count()
    assert 0 < n1 < n
    loads = set(z.prod.load_ids("fact_incident"))
    assert len(loads) == 2 and {x.rsplit("-", 1)[1] for x in loads} == {"0", "1"}
    run_micro_batches(spark, f"{landing}/*/*.json", root, ckpt, as_of="1998-01-01")
    assert Zones.open(spark, root).prod.read("fact_incident").count() == n        # nothing new
    # a second landing with a checkpoint of its own counts batches from 0 again, and is loaded all the same
    other = scratch("landing")
    Z.write_json(Z.as_raw_strings(raw.filter(F.col("incident_id") % 50 == 0)), f"{other}/d=1")
    run_micro_batches(spark, f"{other}/*/*.json", root, scratch("ckpt"), as_of="1998-01-02")
    assert Zones.open(spark, root).prod.read("fact_incident").count() > n


def test_batch_after_a_reload_is_loaded(spark, scratch):
    raw = raw_incidents(spark, SF001)
    split = F.col("incident_datetime") < F.to_timestamp_ntz(F.lit("1998-01-01"))
    root = scratch("reload")
    run_full_load(spark, raw.filter(split), root)
    n1 = run_incremental(spark, raw.filter(~split), root, as_of="1998-01-01", load_id="d1").prod.row_count("fact_incident")
    n0 = run_full_load(spark, raw.filter(split), root).prod.row_count("fact_incident")
    again = run_incremental(spark, raw.filter(~split), root, as_of="1998-01-01", load_id="d1")
    assert n0 < n1 == again.prod.row_count("fact_incident") == Zones.open(spark, root).prod.read("fact_incident").count()
    once_more = run_incremental(spark, raw.filter(~split), root, as_of="1998-01-02", load_id="d1")
    assert once_more.prod.row_count("fact_incident") == n1           # a repeated batch of this epoch is not


def test_unmatched_rows_are_counted_by_the_load_itself(spark, scratch):
    from starloom.operators.fact import build_fact
    from pyspark.sql import Observation
    z = run_full_load(spark, raw_incidents(spark, SF001), scratch("unmatched"))
    stg = z.stg.read("fact_incident")
    lost = stg.limit(3).withColumns({"stg_resolution": F.lit("Nowhere"), "stg_cnn": F.lit(-1), "stg_incident_id": F.lit(-5).cast("bigint")})
    groups = z.prod.read("fact_incident").select("incident_id", "category_group_id").distinct()
    obs = Observation("t")
    fact = build_fact(stg.unionByName(lost), z.prod.tables(), groups, sizes=z.prod.sizes(), unmatched=obs)
    assert fact.count() == z.prod.row_count("fact_incident")
    got = obs.get
    assert (got["resolution"], got["intersection"], got["category_group"], got["police_district"]) == (3, 3, 3, 0)
    stored = {r.dimension: r.n_unmatched for r in spark.read.parquet(f"{z.root}/audit_unmatched").collect()}
    assert len(stored) == 8 and set(stored.values()) == {0}


def test_empty_batch_and_replace_mode(spark, scratch):
    raw = raw_incidents(spark, SF001)
    root = scratch("modes")
    z = run_full_load(spark, raw, root)
    before = {t: z.prod.read(t).count() for t in z.prod.schemas}
    z = run_incremental(spark, raw.limit(0), root, as_of="2001-01-01", load_id="empty")
    assert {t: z.prod.read(t).count() for t in z.prod.schemas} == before

    # re-send some incidents with a new resolution: append keeps both, replace keeps the new rows only
    resent = raw.filter(F.col("incident_id") % 5 == 0).withColumn("resolution", F.lit("Reopened"))
    ids = {r.incident_id for r in z.prod.read("fact_incident").filter(F.col("incident_id") % 5 == 0)
           .select("incident_id").distinct().collect()}
    z = run_incremental(spark, resent, root, as_of="2001-01-02", load_id="resend", fact_mode="replace")
    f = z.prod.read("fact_incident").join(z.prod.read("dim_resolution"), "resolution_id")
    resent_rows = f.filter(F.col("incident_id").isin(list(ids)))
    assert resent_rows.count() > 0
    assert {r.resolution for r in resent_rows.select("resolution").distinct().collect()} == {"Reopened"}
    assert f.count() == before["fact_incident"]
    assert z.prod.load_ids("fact_incident") == ["empty", "full", "resend"]
    # a retry of the earlier load id stays a no-op after the replace started a new fact version
    again = run_incremental(spark, resent, root, as_of="2001-01-02", load_id="empty")
    assert again.prod.read("fact_incident").count() == before["fact_incident"]


def test_a_replayed_batch_keeps_its_date(spark, scratch):
    from starloom.streaming.micro_batch import batch_date
    root = scratch("dates")
    assert batch_date(spark, root, "stream-a-0", "2022-01-01") == "2022-01-01"
    assert batch_date(spark, root, "stream-a-0", "2022-01-02") == "2022-01-01"      # replayed after midnight
    assert batch_date(spark, root, "stream-a-1", "2022-01-02") == "2022-01-02"
