"""One incremental load (the daily batch) into an existing warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators import bridge as B
from starloom.operators import dims as D
from starloom.operators.colocate import Buckets, buckets
from starloom.operators.fact import build_fact, incident_groups_incremental
from starloom.operators.scd import scd_apply
from starloom.plans.full_load import Zones, laid_groups, land_cleansed, load_staging, write_unmatched
from starloom.plans.steps import run_concurrently, step
from starloom.sources.zones import change_window


def run_incremental(spark: SparkSession, raw: DataFrame, root: str, as_of: str, load_id: str,
                    since: str | None = None, fact_mode: str = "append",
                    max_bytes: int | None = None, max_rows: int | None = None, colocate: bool = False) -> Zones:
    """S6 -> S9 -> C -> P -> D3/D8 -> B6-B8 -> G2.

    ``fact_mode="append"`` keeps earlier rows of re-sent incidents (the
    reference behaviour, Q11); ``"replace"`` drops earlier rows of the
    incoming incident ids, writing only the loads again that hold some.
    ``colocate`` stages the fact in buckets, as in the full load.
    """
    if colocate:
        with buckets(spark) as laid:
            return _incremental(spark, raw, root, as_of, load_id, since, fact_mode, max_bytes, max_rows, laid)
    return _incremental(spark, raw, root, as_of, load_id, since, fact_mode, max_bytes, max_rows, None)


def _incremental(spark, raw, root, as_of, load_id, since, fact_mode, max_bytes, max_rows, laid: Buckets | None) -> Zones:
    zones = Zones.open(spark, root)
    if zones.prod.has_load("fact_incident", load_id):           # a retried batch is a no-op
        return zones
    if since:
        raw = change_window(raw, since)
    with step("clean"):
        clean = land_cleansed(spark, raw, zones, load_id, None, max_bytes, max_rows)
    with step("staging"):
        stg = load_staging(clean, zones, load_id, laid)
    prod = zones.prod

    def dim(name, spec):                                        # D3
        prod.append(name, D.insert_new(prod.read(name), stg[name], spec), load_id)

    def scd(name, spec):                                        # D4-D8
        prod.replace(name, scd_apply(prod.read(name), stg[name], spec, as_of), load_id)

    with step("dims"):
        run_concurrently([lambda n=n, s=s: dim(n, s) for n, s in D.DIM_SPECS.items()]
                         + [lambda n=n, s=s: scd(n, s) for n, s in D.SCD_SPECS.items()])

    with step("bridge"):
        incoming = B.incoming_signatures(stg["fact_incident"], prod.read("dim_category")).checkpoint()   # B6
        # The batch's groups that exist are looked up in the index's own partitions; ids are dense, so the
        # largest is the number of rows, which the commits know.
        known = B.known_groups(zones.idx.read_inner("group_signature"), incoming).checkpoint()
        numbered = B.new_groups(known, incoming, F.lit(zones.idx.row_count("group_signature")))          # B7
        # The new group ids are exactly the ones numbered here (Q4), so
        # the group dimension needs no pass over the bridge.
        run_concurrently([
            lambda: prod.append("br_category_group", B.bridge_rows(numbered), load_id),
            lambda: prod.append("dim_category_group", numbered.select("category_group_id"), load_id),
            lambda: zones.idx.append("group_signature", numbered, load_id, B.write_by_prefix)])

    with step("fact"):
        groups = incident_groups_incremental(stg["fact_incident"], prod.read("dim_category"), known.unionByName(numbered),
                                             incoming=incoming)
        groups = laid_groups(groups, stg, zones, load_id, laid)
        unmatched = Observation(f"unmatched-{load_id}")
        fact = build_fact(stg["fact_incident"], prod.tables(), groups, sizes=prod.sizes(), unmatched=unmatched)  # G2
        if fact_mode == "replace":
            prod.replace_keys("fact_incident", fact, "incident_id", load_id)
        else:
            prod.append("fact_incident", fact, load_id)
        write_unmatched(zones, unmatched, load_id)                                                               # G3
    with step("commit"):
        zones.commit()
    return zones
