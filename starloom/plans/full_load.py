"""The full load, raw records -> cleansed zone -> staging -> warehouse.

Every zone is written (and read back) instead of cached: a written table
survives executor loss and cuts lineage for the later steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators import bridge as B
from starloom.operators import dims as D
from starloom.operators.clean import clean_observed
from starloom.operators.colocate import Buckets, buckets, hot_incidents, per_salt, salted
from starloom.operators.fact import build_fact, incident_groups_full
from starloom.operators.staging import stage_all
from starloom.schemas import INDEX_PARTITIONS, INDEX_SCHEMAS, PROD_SCHEMAS, STG_SCHEMAS
from starloom.plans.steps import run_concurrently, step
from starloom.session import scratch_path
from starloom.sources.tables import Commits, Warehouse, conform, retain
from starloom.sources.zones import batch_measures, check_size, full_extract, quarantined, read_zone, write_zone


@dataclass
class Zones:
    """The stores of one warehouse root (with one table of commits)."""
    root: str
    stg: Warehouse
    prod: Warehouse
    idx: Warehouse
    commits: Commits

    @classmethod
    def open(cls, spark: SparkSession, root: str, fresh: bool = False) -> "Zones":
        return cls._with(spark, root.rstrip("/"), Commits(spark, root.rstrip("/"), fresh))

    @classmethod
    def _with(cls, spark: SparkSession, root: str, m: Commits) -> "Zones":
        return cls(root, Warehouse(spark, f"{root}/stg", STG_SCHEMAS, m, "stg"),
                   Warehouse(spark, f"{root}/prod", PROD_SCHEMAS, m, "prod"),
                   Warehouse(spark, f"{root}/idx", INDEX_SCHEMAS, m, "idx", inner=INDEX_PARTITIONS), m)

    def commit(self) -> None:
        self.commits.commit()

    def at(self, load_id: str) -> "Zones":
        """The warehouse as it was right after ``load_id`` (read-only use)."""
        return Zones._with(self.stg.spark, self.root, self.commits.upto(load_id))

    def retain(self, keep_commits: int = 7) -> list[str]:
        """Delete partitions that none of the last ``keep_commits`` commits names (explicit call only)."""
        return retain([self.stg, self.prod, self.idx], keep_commits)


def land_cleansed(spark: SparkSession, raw: DataFrame, zones: Zones, load_id: str, valid_date: str | None = None,
                  max_bytes: int | None = None, max_rows: int | None = None) -> DataFrame:
    """C1-C7, written to ``cleansed/load_id=<id>`` and read back; the ingest
    audit (S10: rows per outcome) is observed by the same job and written
    to ``audit/load_id=<id>``.  Input that is no record goes to
    ``quarantine/load_id=<id>`` with its file (a second pass over the raw batch,
    only where the audit counts some).

    Where a limit is given (S9) the same job measures the raw batch, and a batch
    over it stops the load here: no audit, no table, no commit (what was landed is
    read by nothing, and written over by a retry).
    """
    path = f"{zones.root}/cleansed/load_id={load_id}"
    obs = Observation(f"audit-{load_id}")
    gated = max_bytes is not None or max_rows is not None
    write_zone(clean_observed(raw, obs, valid_date, batch_measures(raw) if gated else None), path)
    if gated:
        check_size(obs.get["n_rows"], obs.get["n_bytes"], max_bytes, max_rows)
    rows = [(k, int(v)) for k, v in obs.get.items() if k not in ("n_rows", "n_bytes")]
    (spark.createDataFrame(rows, "outcome string, n_rows bigint").coalesce(1)   # a retry replaces its rows
     .write.mode("overwrite").parquet(f"{zones.root}/audit/load_id={load_id}"))
    if obs.get.get("corrupt"):
        write_zone(quarantined(raw), f"{zones.root}/quarantine/load_id={load_id}")
    return read_zone(spark, path)


def load_staging(clean: DataFrame, zones: Zones, load_id: str, laid: Buckets | None = None) -> dict[str, DataFrame]:
    """P1-P7 truncate-loaded into the staging store.

    With ``laid`` the staged fact is written in buckets (``colocate``) and comes
    back with its salt; ``hot`` are its hot incidents.
    """
    staged, tables = stage_all(clean), {}

    def fact():
        tables["hot"] = hot_incidents(clean).checkpoint()

        def write(rows, path):
            tables["fact_incident"] = laid.write(rows, path, "stg_incident_id")
        fixed = conform(staged["fact_incident"], STG_SCHEMAS["fact_incident"])
        zones.stg.replace("fact_incident", salted(fixed, tables["hot"]), load_id, write)
    run_concurrently([fact if laid and n == "fact_incident" else lambda n=n, df=df: zones.stg.replace(n, df, load_id)
                      for n, df in staged.items()])
    return {**zones.stg.tables(), **tables}


def laid_groups(igroups: DataFrame, stg: dict[str, DataFrame], zones: Zones, load_id: str, laid: Buckets | None) -> DataFrame:
    """The incidents' groups in the same buckets as the staged fact (as they are without ``laid``)."""
    if laid is None:
        return igroups
    path = scratch_path(zones.prod.spark, f"incident-groups-{load_id}")
    return laid.write(per_salt(igroups, stg["hot"]), path, "incident_id")


def write_unmatched(zones: Zones, counts: Observation, load_id: str) -> None:
    """G3 (Q15): staged rows the fact drops, per dimension, observed by the
    job that wrote the fact; under ``audit_unmatched/load_id=<id>`` (a retry
    replaces them)."""
    rows = [(k, int(v)) for k, v in counts.get.items()]
    (zones.prod.spark.createDataFrame(rows, "dimension string, n_unmatched bigint").coalesce(1)
     .write.mode("overwrite").parquet(f"{zones.root}/audit_unmatched/load_id={load_id}"))


def run_full_load(spark: SparkSession, raw: DataFrame, root: str, valid_date: str | None = None,
                  load_id: str = "full", fresh: bool = False, from_date: str | None = None,
                  max_bytes: int | None = None, max_rows: int | None = None, colocate: bool = False) -> Zones:
    """E1 into ``root`` (``fresh=True`` when the root is known to be new).

    ``colocate`` stages the fact in buckets, so that it is shuffled once, while
    it is staged, and not again (``operators/colocate.py``).

    Ingest: rows created or changed from ``from_date`` on (S7), the size gate
    where a limit is given (S9), then cleaning, from ``valid_date`` on (C6).
    """
    if colocate:
        with buckets(spark) as laid:
            return _full_load(spark, raw, root, valid_date, load_id, fresh, from_date, max_bytes, max_rows, laid)
    return _full_load(spark, raw, root, valid_date, load_id, fresh, from_date, max_bytes, max_rows, None)


def _full_load(spark, raw, root, valid_date, load_id, fresh, from_date, max_bytes, max_rows, laid: Buckets | None) -> Zones:
    zones = Zones.open(spark, root, fresh)
    raw = full_extract(raw, from_date)
    with step("clean"):
        clean = land_cleansed(spark, raw, zones, load_id, valid_date, max_bytes, max_rows)
    with step("staging"):
        stg = load_staging(clean, zones, load_id, laid)
    prod = zones.prod

    def dim(name, spec):                                        # D1
        prod.replace(name, D.full_load_dim(stg[name], spec), load_id)

    def scd(name, spec):                                        # D2
        prod.replace(name, D.scd_init(stg[name], spec), load_id)

    with step("dims"):
        run_concurrently([lambda n=n, s=s: dim(n, s) for n, s in D.DIM_SPECS.items()]
                         + [lambda n=n, s=s: scd(n, s) for n, s in D.SCD_SPECS.items()])

    with step("groups"):                                        # B1, B2
        # incident signatures are built once (checkpointed) and reused for
        # the numbering and the fact lookup
        isig = B.group_signature(stg["fact_incident"], "stg_incident_id", "stg_category_code").checkpoint()
        groups = B.number_groups(isig)
    with step("bridge"):
        # B4 and B5 follow from the numbered groups; neither reads the bridge.
        codes = prod.read("dim_category")
        run_concurrently([
            lambda: prod.replace("br_category_group", B.bridge_full_load(groups, codes), load_id),             # B3
            lambda: prod.replace("dim_category_group", groups.select(F.col("group_id").alias("category_group_id")), load_id),  # B4
            lambda: zones.idx.replace("group_signature", B.category_signatures(groups, codes), load_id,
                                      B.write_by_prefix)])                                                     # B5

    with step("fact"):
        igroups = laid_groups(incident_groups_full(stg["fact_incident"], groups, isig), stg, zones, load_id, laid)
        unmatched = Observation(f"unmatched-{load_id}")
        prod.replace("fact_incident", build_fact(stg["fact_incident"], prod.tables(), igroups, sizes=prod.sizes(),
                                                 unmatched=unmatched), load_id)                                # G1
        write_unmatched(zones, unmatched, load_id)                                                             # G3
    with step("commit"):
        zones.commit()
    return zones
