"""Benchmark of the headline operators; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Times (seconds, wall clock, each includes writing its result):
  e1_full_load       full pipeline over all raw incidents
  e2_incremental     one incremental batch on top of a full load of batch one
  scd_apply          the two versioned dimensions of that batch
  bridge_insert_new  new bridge groups of that batch
  fact_full_load     resolve + distinct + write of the full-load fact
  report_year        year report over the full-load warehouse (collected)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.operators import bridge as B  # noqa: E402
from starloom.operators import dims as D  # noqa: E402
from starloom.operators.fact import build_fact, incident_groups_full  # noqa: E402
from starloom.operators.reports import report_year  # noqa: E402
from starloom.operators.scd import scd_apply  # noqa: E402
from starloom.plans.full_load import Zones, run_full_load  # noqa: E402
from starloom.plans.incremental import run_incremental  # noqa: E402
from starloom.session import build_session, scratch_path  # noqa: E402
from starloom.sources.adapter import batch_one, batch_two, raw_incidents  # noqa: E402


def timed(fn):
    t = time.time()
    out = fn()
    return round(time.time() - t, 3), out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="starloom-bench-")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                                 "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # Steady-state timing: warm the JVM (JIT, codegen caches) with one
    # untimed load of the smallest fixture, as a long-running driver would be.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        run_full_load(spark, raw_incidents(spark, warm), scratch_path(spark, "warm-up"), fresh=True)
    raw = raw_incidents(spark, sf_dir)
    q: dict[str, float] = {}

    q["e1_full_load"], full = timed(lambda: run_full_load(spark, raw, scratch_path(spark, "wh-full"), fresh=True))

    root = scratch_path(spark, "wh-incr")
    run_full_load(spark, batch_one(raw), root, load_id="b1", fresh=True)
    q["e2_incremental"], incr = timed(
        lambda: run_incremental(spark, batch_two(raw), root, as_of="2000-01-01", load_id="b2"))

    # Operator timings on the state before batch two, results written to scratch.
    b1 = incr.at("b1")
    stg2 = incr.stg.tables()
    out = Zones.open(spark, scratch_path(spark, "wh-ops"), fresh=True)

    def scd():
        for name, spec in D.SCD_SPECS.items():
            out.prod.replace(name, scd_apply(b1.prod.read(name), stg2[name], spec, "2000-01-01"), "op")
    q["scd_apply"], _ = timed(scd)

    def bridge():
        incoming = B.incoming_signatures(stg2["fact_incident"], incr.prod.read("dim_category"))
        out.prod.replace("br_category_group", B.bridge_insert_new(b1.prod.read("br_category_group"), incoming,
                                                                  b1.idx.read("group_signature")), "op")
    q["bridge_insert_new"], _ = timed(bridge)

    def fact():
        stg = full.stg.read("fact_incident")
        groups = B.number_groups(B.group_signature(stg, "stg_incident_id", "stg_category_code"))
        out.prod.replace("fact_incident",
                         build_fact(stg, full.prod.tables(), incident_groups_full(stg, groups),
                                    sizes=full.prod.sizes()), "op")
    q["fact_full_load"], _ = timed(fact)

    q["report_year"], _ = timed(lambda: report_year(full.prod.tables(), sizes=full.prod.sizes()).collect())

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "pipeline_e1_plus_e2", "value": round(q["e1_full_load"] + q["e2_incremental"], 3),
                      "unit": "sec", "queries": q, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
