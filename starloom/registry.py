"""Registered queries: one per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables (through the incident adapter), whole tables every time.
Warehouses that several queries read are built once per session and
scale factor and kept under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import calendar as cal
from starloom.functions.hashing import fnv1a64, fnv1a64_chain
from starloom.operators import bridge as B
from starloom.operators import clean as C
from starloom.operators import dims as D
from starloom.operators import scd as S
from starloom.operators import staging as P
from starloom.operators.fact import fact_unmatched, incident_groups_incremental, resolve_dimension_keys
from starloom.operators.keys import assign_ids, checked_broadcast, max_id
from starloom.operators.reports import report_daily, report_year, report_year_rollup
from starloom.plans.full_load import Zones, run_full_load
from starloom.plans.incremental import run_incremental
from starloom.schemas import PROD_DEFAULTS, PROD_SCHEMAS, STG_SCHEMAS
from starloom.session import configure, scratch_path
from starloom.sources import zones as Z
from starloom.sources.adapter import batch_one, batch_two, raw_incidents, untidy
from starloom.sources.tables import Warehouse, conform, load_table

# Fixed parameters of the registered queries.
VALID_DATE = "1996-01-01"        # C6 / full extract start
SINCE = "1998-01-01"             # S6 change window
AS_OF_B2 = "2000-01-01"          # E2 load date of batch two
AS_OF_B3 = "2000-01-02"          # revert batch
ROW_CAP = 1000                   # S8 cap (the feature itself)
VERSION_DATE = "1999-12-31"      # D9 point in time

_CACHE: dict[tuple, object] = {}


def _memo(key, build):
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def _raw(spark, sf) -> DataFrame:
    configure(spark)
    return raw_incidents(spark, sf)


def _raw_kept(spark, sf) -> DataFrame:
    """All raw rows, joined from the driver's tables once and read back: for queries that go over them several times."""
    def build():
        raw, path = _raw(spark, sf), scratch_path(spark, "raw")
        Z.write_zone(raw, path)
        return path, raw.schema
    path, schema = _memo(("raw", id(spark), sf), build)
    return configure(spark).read.schema(schema).parquet(path)


def _clean(spark, sf) -> DataFrame:
    """Cleansed incidents of all raw rows, written once and read back."""
    def build():
        path = scratch_path(spark, "cleansed")
        Z.write_zone(C.clean_incidents(_raw(spark, sf)), path)
        return path
    return spark.read.parquet(_memo(("clean", id(spark), sf), build))


def _full(spark, sf) -> Zones:
    """E1 over all raw rows."""
    return _memo(("full", id(spark), sf),
                 lambda: run_full_load(spark, _raw(spark, sf), scratch_path(spark, "wh-full"), fresh=True))


def _incr(spark, sf) -> Zones:
    """E1 on batch one, then E2 on batch two (with injected changes)."""
    def build():
        root = scratch_path(spark, "wh-incr")
        raw = _raw_kept(spark, sf)
        run_full_load(spark, batch_one(raw), root, load_id="b1", fresh=True)
        return run_incremental(spark, batch_two(raw), root, as_of=AS_OF_B2, load_id="b2")
    return _memo(("incr", id(spark), sf), build)


def _b1(spark, sf) -> Zones:
    return _incr(spark, sf).at("b1")


def _stg2(spark, sf) -> dict[str, DataFrame]:
    """Staging datasets of batch two."""
    return _incr(spark, sf).stg.tables()


# --- sources / sinks ---------------------------------------------------------

INGEST_COLUMNS = C.RAW_COLUMNS + ["created_at", "updated_at"]


def _landed(spark, raw: DataFrame) -> DataFrame:
    """Raw records as an API delivers them: files that each hold a JSON array, every value text."""
    path = scratch_path(spark, "raw-json")
    Z.write_json_arrays(Z.as_raw_strings(raw), path)
    return Z.read_raw(spark, path, INGEST_COLUMNS)


def q_json_scan(spark, sf):
    """S1 in both forms: rows of batch one come as arrays, the others as lines."""
    raw, path = _raw_kept(spark, sf), scratch_path(spark, "raw-json-lines")
    Z.write_json(Z.as_raw_strings(batch_two(raw, changed=False)), path, compression="gzip")
    both = _landed(spark, batch_one(raw)).unionByName(Z.read_raw(spark, path, INGEST_COLUMNS, multi_line=False))
    return C.cast_types(C.project_columns(both))


def q_parquet_scan(spark, sf):
    path = scratch_path(spark, "zone")
    Z.write_zone(C.clean_incidents(_raw(spark, sf)), path)
    return Z.read_zone(spark, path).select("incident_id", "incident_code", "resolution", "latitude")


def q_parquet_sink(spark, sf):
    path = scratch_path(spark, "zone")
    Z.write_zone(P.stage_fact_incident(_clean(spark, sf)), path)
    return Z.read_zone(spark, path)


def q_json_sink(spark, sf):
    path = scratch_path(spark, "zone-json")
    Z.write_json(P.stage_dim_category(_clean(spark, sf)), path)
    return spark.read.schema(STG_SCHEMAS["dim_category"]).json(path)


def q_dated_layout(spark, sf):
    root = scratch_path(spark, "dated")
    raw = _raw(spark, sf).withColumn("ds", F.date_format("incident_datetime", "yyyy-MM-dd"))
    Z.write_dated(raw, root)
    Z.write_dated(raw.filter(F.col("ds") == "1998-01-01"), root)   # a rerun of one day
    return (Z.read_zone(spark, root).groupBy(F.col("ds").cast("string").alias("ds"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_change_window(spark, sf):
    return Z.change_window(_raw(spark, sf), SINCE)


def q_full_extract(spark, sf):
    return Z.full_extract(_raw(spark, sf), VALID_DATE)


def q_row_cap(spark, sf):
    clean = _clean(spark, sf)
    return Z.row_cap(clean, ROW_CAP, clean.columns)


def q_size_gate(spark, sf):
    """Without a limit a batch passes; then its measure, which as a limit lets it pass and one byte less not."""
    raw = Z.size_gate(C.project_columns(_raw_kept(spark, sf)).drop("incident_datetime", "report_datetime", "latitude", "longitude"))
    n = Z.batch_stats(raw).first()["n_bytes"]
    passed = Z.batch_stats(Z.size_gate(raw, max_bytes=n))
    try:
        Z.size_gate(raw, max_bytes=n - 1)
        stopped = n == 0
    except Z.SizeGateError:
        stopped = True
    return passed.withColumn("stopped_below", F.lit(stopped))


def q_load_audit(spark, sf):
    """S10 over array files as delivered, and two that were cut off: one in its last record, one right after a record.
    Their whole records (the lines of the first and of the last incident) count; what is lost of each is one corrupt row."""
    raw, path = untidy(_raw(spark, sf)), scratch_path(spark, "raw-json")
    Z.write_json_arrays(raw, path)
    for pick, end in ((F.min, ',{"incident_id":"1'), (F.max, "")):
        one = raw.agg(pick(F.col("incident_id").cast("bigint")).cast("string").alias("i"))
        lines = raw.join(one, F.col("incident_id") == F.col("i"), "left_semi")
        Z.write_json_arrays(lines, path, rows_per_file=None, end=end, append=True)
    return C.load_audit(Z.read_raw(spark, path, INGEST_COLUMNS, damaged=True), VALID_DATE)


def q_truncate_load(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "stg"), STG_SCHEMAS, fresh=True)
    fact = P.stage_fact_incident(_clean(spark, sf))
    load_table(wh, "fact_incident", fact, "truncate", "l1")
    load_table(wh, "fact_incident", fact, "truncate", "l2")
    wh.commits.commit()
    return wh.read("fact_incident")


def q_append_load(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "stg"), STG_SCHEMAS, fresh=True)
    raw = _raw_kept(spark, sf)
    load_table(wh, "fact_incident", P.stage_fact_incident(C.clean_incidents(batch_one(raw))), "truncate", "b1")
    load_table(wh, "fact_incident", P.stage_fact_incident(C.clean_incidents(batch_two(raw, False))), "append", "b2")
    wh.commits.commit()
    return wh.read("fact_incident")


def q_column_list_load(spark, sf):
    wh = Warehouse(spark, scratch_path(spark, "stg"), STG_SCHEMAS, fresh=True)
    load_table(wh, "fact_incident", P.stage_fact_incident(_clean(spark, sf)), "truncate", "l1",
               col_list=["stg_incident_id", "stg_category_code", "stg_cnn"])
    wh.commits.commit()
    return wh.read("fact_incident")


def q_micro_batch(spark, sf):
    """Two daily landings, each picked up by one availableNow run of the
    streaming load (one micro-batch per run)."""
    from starloom.streaming.micro_batch import run_micro_batches
    raw = _raw_kept(spark, sf)
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "wh-stream")
    ckpt = scratch_path(spark, "stream-ckpt")
    dates = {0: "1999-12-31", 1: AS_OF_B2}
    for day, batch in ((1, batch_one(raw)), (2, batch_two(raw))):
        Z.write_json(Z.as_raw_strings(batch), f"{landing}/day={day}", compression="gzip")
        run_micro_batches(spark, f"{landing}/*/*.json.gz", root, ckpt, as_of=lambda b: dates.get(b, AS_OF_B2))
    return Zones.open(spark, root).prod.read("fact_incident")


# --- table definition / keys -------------------------------------------------

def _contents(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, rows, filled, different, least, most): the content of tables column by column.

    Every column is counted by itself, from a scan of that column: its values are combined to one row each
    before they are shuffled, and never travel with those of other columns.
    """
    out = None
    for t, df in tables.items():
        for c, kind in df.dtypes:
            values = df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            # Text order is not that of a number, so the extremes are taken of the text.
            text = F.lit(None).cast("string") if kind == "double" else F.col("value").cast("string")
            one = values.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
                             F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_filled"),
                             F.count("value").alias("n_different"), F.min(text).alias("least"), F.max(text).alias("most"))
            one = one.select(F.lit(t).alias("table_name"), "n_rows", F.lit(c).alias("column_name"), "n_filled", "n_different", "least", "most")
            out = one if out is None else out.unionByName(one)
    return out


def q_staging_tables(spark, sf):
    """Rows, and per column its filled and different values, of every staging table."""
    return _contents({t: _full(spark, sf).stg.read(t) for t in STG_SCHEMAS})


def q_prod_tables(spark, sf):
    """The same of every warehouse table."""
    return _contents({t: _full(spark, sf).prod.read(t) for t in PROD_SCHEMAS})


def q_surrogate_key(spark, sf):
    ids = _clean(spark, sf).select("incident_id").distinct()
    return assign_ids(ids, "incident_key", "incident_id")


def q_column_defaults(spark, sf):
    spec = D.SCD_SPECS["dim_category"]
    df = P.stage_dim_category(_clean(spark, sf)).select(*[F.col(s).alias(t) for s, t in spec.columns.items()])
    return conform(df, PROD_SCHEMAS["dim_category"], spec.attrs, PROD_DEFAULTS["dim_category"])


def q_replicated_dims(spark, sf):
    z = _full(spark, sf)
    pd = checked_broadcast(z.prod.read("dim_police_district"), z.prod.byte_size("dim_police_district"))
    f = z.stg.read("fact_incident")
    return (f.join(pd, f.stg_police_district == pd.police_district)
            .select("stg_incident_id", "stg_category_code", "stg_report_time", "police_district_id"))


# --- cleaning ----------------------------------------------------------------

def q_project_columns(spark, sf):
    return C.project_columns(_raw(spark, sf))


def q_drop_any_null(spark, sf):
    return C.drop_any_null(C.project_columns(_raw(spark, sf)))


def q_filter_not_equal(spark, sf):
    return C.filter_not_equal(C.project_columns(_raw(spark, sf)))


def q_filter_not_contains(spark, sf):
    return C.filter_not_contains(C.project_columns(_raw(spark, sf)))


def q_drop_columns(spark, sf):
    return C.drop_columns(C.project_columns(_raw(spark, sf)))


def q_filter_from_date(spark, sf):
    return C.filter_from_date(_clean(spark, sf), VALID_DATE)


def q_cast_types(spark, sf):
    return C.cast_types(C.project_columns(untidy(_raw(spark, sf))))


def q_clean_incidents(spark, sf):
    return C.clean_incidents(untidy(_raw(spark, sf)), VALID_DATE)


def q_rename_columns(spark, sf):
    return _clean(spark, sf).withColumnsRenamed(
        {"cnn": "stg_cnn", "intersection": "stg_intersection", "latitude": "stg_latitude",
         "longitude": "stg_longitude"}).select("incident_id", "stg_cnn", "stg_intersection",
                                               "stg_latitude", "stg_longitude")


def q_case_when(spark, sf):
    c = _clean(spark, sf)
    return c.select("incident_id", "report_datetime",
                    cal.weekday_indicator(F.col("incident_datetime")).alias("weekday_indicator"),
                    cal.daytime_indicator(F.hour("report_datetime")).alias("daytime_indicator"))


# --- staging -----------------------------------------------------------------

def _stage(name):
    def q(spark, sf):
        return P.STAGERS[name](_clean(spark, sf))
    return q


def q_us_federal_holidays(spark, sf):
    c = _clean(spark, sf)
    return cal.us_federal_holidays(P._all_timestamps(c), "ts")


def q_date_time_functions(spark, sf):
    ts = P._all_timestamps(_clean(spark, sf)).distinct()
    return ts.select("ts", *cal.date_attributes(F.col("ts")), *cal.time_attributes(F.col("ts")))


def q_hash64(spark, sf):
    s = P.stage_dim_intersection(_clean(spark, sf)).select("stg_cnn", "stg_intersection").distinct()
    return s.select("stg_cnn", "stg_intersection", fnv1a64("stg_intersection").alias("h"))


def q_hash64_chain(spark, sf):
    s = P.stage_dim_category(_clean(spark, sf)).select("stg_category", "stg_subcategory").distinct()
    return s.select("stg_category", "stg_subcategory",
                    fnv1a64_chain(["stg_category", "stg_subcategory"]).alias("h"))


# --- joins, aggregates, windows, set operations -----------------------------

def q_inner_equi_join(spark, sf):
    z = _full(spark, sf)
    f, c = z.stg.read("fact_incident"), z.prod.read("dim_category")
    return (f.join(c, f.stg_category_code == c.category_code)
            .select("stg_incident_id", "stg_incident_time", "category_id"))


def q_star_join(spark, sf):
    z = _full(spark, sf)
    return resolve_dimension_keys(z.stg.read("fact_incident"), z.prod.tables(), sizes=z.prod.sizes())


def q_anti_join(spark, sf):
    """Staged rows of batch two whose incident is not in the fact yet."""
    f = _b1(spark, sf).prod.read("fact_incident").select(F.col("incident_id").alias("stg_incident_id")).distinct()
    return _stg2(spark, sf)["fact_incident"].join(f, "stg_incident_id", "left_anti")


def q_left_join_flags(spark, sf):
    spec = D.SCD_SPECS["dim_intersection"]
    return S.scd_classify(_b1(spark, sf).prod.read("dim_intersection"), _stg2(spark, sf)["dim_intersection"], spec)


def q_conditional_join(spark, sf):
    z = _incr(spark, sf)
    return B.incident_category_ids(z.stg.read("fact_incident"), z.prod.read("dim_category"))


def q_cross_join_scalar(spark, sf):
    z = _b1(spark, sf)
    new = _stg2(spark, sf)["dim_time"]
    return new.select("stg_full_time", (max_id(z.prod.read("dim_time"), "time_id") + F.col("stg_minute"))
                      .alias("shifted_id"))


def q_lateral_unnest(spark, sf):
    z = _full(spark, sf)
    groups = B.number_groups(B.group_signature(z.stg.read("fact_incident"), "stg_incident_id", "stg_category_code"))
    return B.explode_signature(groups, "group_id", "signature", "category_code")


def q_join_update(spark, sf):
    spec = D.SCD_SPECS["dim_category"]
    dim = _b1(spark, sf).prod.read("dim_category")
    cls = S.scd_classify(dim, _stg2(spark, sf)["dim_category"], spec)
    return S._apply_to_current(dim, cls, spec, F.lit(AS_OF_B2).cast("date"))


def q_ordered_listagg(spark, sf):
    return B.bridge_signatures(_full(spark, sf).prod.read("br_category_group"))


def q_distinct_rows(spark, sf):
    return _clean(spark, sf).select("resolution", "police_district", "incident_category").distinct()


def q_distinct_on_key(spark, sf):
    s = _stg2(spark, sf)["dim_intersection"]
    return D.collapse_per_key(s, "stg_cnn", ["stg_intersection", "stg_latitude", "stg_longitude"])


def q_max_scalar(spark, sf):
    return _clean(spark, sf).agg(F.max("incident_id").alias("max_incident_id"),
                                 F.max("report_datetime").alias("max_report_datetime"))


def q_min_scalar(spark, sf):
    return _clean(spark, sf).agg(F.min("incident_datetime").alias("min_incident_datetime"),
                                 F.min("report_datetime").alias("min_report_datetime"))


def q_row_number_ids(spark, sf):
    sig = B.group_signature(_full(spark, sf).stg.read("fact_incident"), "stg_incident_id", "stg_category_code")
    return assign_ids(sig.select("signature").distinct(), "group_id", "signature")


def q_union_all(spark, sf):
    return P._all_timestamps(_clean(spark, sf))


# --- dimensions and SCD ------------------------------------------------------

def q_dim_full_load(spark, sf):
    return _full(spark, sf).prod.read("dim_time")


def q_dim_full_load_date(spark, sf):
    return _full(spark, sf).prod.read("dim_date")


def q_dim_full_load_district(spark, sf):
    return _full(spark, sf).prod.read("dim_police_district")


def q_scd_full_load(spark, sf):
    return _full(spark, sf).prod.read("dim_category")


def q_scd_full_load_intersection(spark, sf):
    return _full(spark, sf).prod.read("dim_intersection")


def q_dim_insert_new(spark, sf):
    """D3 on a dimension that holds some of the staged minutes (those of even
    hours, numbered in falling order): only the others come, after the largest id."""
    staged = P.stage_dim_time(_clean(spark, sf))
    spec = D.DIM_SPECS["dim_time"]
    known = D._rename(staged.filter("stg_hour % 2 = 0"), spec.columns)
    known = assign_ids(known, "time_id", F.col("full_time").desc(), start=100, bounded=True)
    return D.insert_new(known, staged, spec)


def _scd_args(spark, sf, name):
    return _b1(spark, sf).prod.read(name), _stg2(spark, sf)[name], D.SCD_SPECS[name]


def q_scd_classify(spark, sf):
    return S.scd_classify(*_scd_args(spark, sf, "dim_category"))


def q_scd2_expire(spark, sf):
    return S.scd2_expire(*_scd_args(spark, sf, "dim_intersection"), AS_OF_B2)


def q_scd2_insert_versions(spark, sf):
    return S.scd2_insert_versions(*_scd_args(spark, sf, "dim_intersection"), AS_OF_B2)


def q_scd1_overwrite(spark, sf):
    return S.scd1_overwrite(*_scd_args(spark, sf, "dim_intersection"))


def q_scd_apply(spark, sf):
    return _incr(spark, sf).prod.read("dim_intersection")


def q_scd_apply_category(spark, sf):
    return _incr(spark, sf).prod.read("dim_category")


def _revert(spark, sf) -> Zones:
    """A third load that reverts batch two's changes (A -> B -> A history)."""
    def build():
        z = _incr(spark, sf)
        return run_incremental(spark, batch_two(_raw_kept(spark, sf), changed=False), z.root, as_of=AS_OF_B3,
                               load_id="b3")
    return _memo(("revert", id(spark), sf), build)


def q_scd_apply_revert(spark, sf):
    return _revert(spark, sf).prod.read("dim_intersection")


def q_scd_apply_revert_category(spark, sf):
    return _revert(spark, sf).prod.read("dim_category")


def q_new_keys_only(spark, sf):
    """Staged category codes of batch two unseen in the dimension."""
    stg = _stg2(spark, sf)["dim_category"].select(F.col("stg_category_code").alias("category_code"))
    return stg.join(_b1(spark, sf).prod.read("dim_category").select("category_code"), "category_code", "left_anti")


def q_scd_as_of(spark, sf):
    return S.scd_as_of(_incr(spark, sf).prod.read("dim_category"), D.SCD_SPECS["dim_category"], VERSION_DATE)


# --- bridge, fact, reports, pipelines ---------------------------------------

def q_group_signature(spark, sf):
    return B.group_signature(_full(spark, sf).stg.read("fact_incident"), "stg_incident_id", "stg_category_code")


def q_group_ids_full(spark, sf):
    return B.number_groups(q_group_signature(spark, sf))


def q_bridge_full_load(spark, sf):
    return _full(spark, sf).prod.read("br_category_group")


def q_group_dim_full(spark, sf):
    return _full(spark, sf).prod.read("dim_category_group")


def q_bridge_signatures(spark, sf):
    return B.bridge_signatures(_b1(spark, sf).prod.read("br_category_group"))


def q_incoming_signatures(spark, sf):
    z = _incr(spark, sf)
    return B.incoming_signatures(z.stg.read("fact_incident"), z.prod.read("dim_category"))


def q_bridge_insert_new(spark, sf):
    return _incr(spark, sf).prod.read_load("br_category_group", "b2")


def q_group_dim_insert_new(spark, sf):
    return _incr(spark, sf).prod.read_load("dim_category_group", "b2")


def q_fact_full_load(spark, sf):
    return _full(spark, sf).prod.read("fact_incident")


def q_fact_incremental(spark, sf):
    return _incr(spark, sf).prod.read_load("fact_incident", "b2")


def q_fact_unmatched(spark, sf):
    b1 = _b1(spark, sf)
    stg = _stg2(spark, sf)["fact_incident"]
    groups = incident_groups_incremental(stg, b1.prod.read("dim_category"),
                                         B.bridge_signatures(b1.prod.read("br_category_group")))
    return fact_unmatched(stg, b1.prod.tables(), groups, b1.prod.sizes())


def q_report_year(spark, sf):
    z = _full(spark, sf)
    return report_year(z.prod.tables(), sizes=z.prod.sizes())


def q_report_year_rollup(spark, sf):
    z = _full(spark, sf)
    return report_year_rollup(z.prod.tables(), sizes=z.prod.sizes())


def q_report_daily(spark, sf):
    z = _full(spark, sf)
    return report_daily(z.prod.tables(), sizes=z.prod.sizes())


def natural_fact(prod: dict[str, DataFrame]) -> DataFrame:
    """The fact with every surrogate key replaced by its natural key."""
    f = prod["fact_incident"]
    d = prod["dim_date"].select("date_id", "full_date")
    t = prod["dim_time"].select("time_id", "full_time")
    sig = B.group_signature(
        prod["br_category_group"].join(prod["dim_category"].select("category_id", "category_code"), "category_id"),
        "category_group_id", "category_code", "category_codes")
    return (f.join(sig, "category_group_id")
            .join(prod["dim_resolution"], "resolution_id")
            .join(d.withColumnsRenamed({"date_id": "incident_date", "full_date": "incident_day"}), "incident_date")
            .join(t.withColumnsRenamed({"time_id": "incident_time", "full_time": "incident_hhmm"}), "incident_time")
            .join(d.withColumnsRenamed({"date_id": "report_date", "full_date": "report_day"}), "report_date")
            .join(t.withColumnsRenamed({"time_id": "report_time", "full_time": "report_hhmm"}), "report_time")
            .join(prod["dim_intersection"].select("intersection_id", "cnn"), "intersection_id")
            .join(prod["dim_police_district"], "police_district_id")
            .select("incident_id", "category_codes", "resolution", "incident_day", "incident_hhmm",
                    "report_day", "report_hhmm", "cnn", "police_district"))


# Limit of the size gate in the composed pipelines: far above any day's batch; a larger one must stop.
GATE_BYTES = 1 << 50


def q_pipeline_full(spark, sf):
    """E1 with its ingest: JSON arrays, rows changed since the start (S7), the
    size gate (S9), cleaning from the same date on (C6), then the warehouse."""
    z = _memo(("ingest", id(spark), sf),
              lambda: run_full_load(spark, _landed(spark, _raw(spark, sf)), scratch_path(spark, "wh-ingest"), fresh=True,
                                    valid_date=VALID_DATE, from_date=VALID_DATE, max_bytes=GATE_BYTES))
    return natural_fact(z.prod.tables())


def q_pipeline_incremental(spark, sf):
    """E1 on batch one, then E2 on what of batch two was created or changed since."""
    def build():
        root, raw = scratch_path(spark, "wh-since"), _raw_kept(spark, sf)
        run_full_load(spark, batch_one(raw), root, load_id="b1", fresh=True)
        return run_incremental(spark, _landed(spark, batch_two(raw)), root, as_of=AS_OF_B2, load_id="b2", since=SINCE,
                               max_bytes=GATE_BYTES)
    return natural_fact(_memo(("since", id(spark), sf), build).prod.tables())


def q_pipeline_full_collapse(spark, sf):
    z = _memo(("collapse", id(spark), sf),
              lambda: run_full_load(spark, raw_incidents(spark, sf, collapse=True), scratch_path(spark, "wh-col"),
                                    fresh=True))
    return z.prod.read("fact_incident")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources / sinks
    "json_scan": q_json_scan, "parquet_scan": q_parquet_scan, "parquet_sink": q_parquet_sink,
    "json_sink": q_json_sink, "dated_layout": q_dated_layout, "change_window": q_change_window,
    "full_extract": q_full_extract, "row_cap": q_row_cap, "size_gate": q_size_gate,
    "load_audit": q_load_audit, "truncate_load": q_truncate_load, "append_load": q_append_load,
    "column_list_load": q_column_list_load, "micro_batch": q_micro_batch,
    # table definition, keys
    "staging_tables": q_staging_tables, "prod_tables": q_prod_tables, "surrogate_key": q_surrogate_key,
    "column_defaults": q_column_defaults, "replicated_dims": q_replicated_dims,
    # cleaning
    "project_columns": q_project_columns, "drop_any_null": q_drop_any_null,
    "filter_not_equal": q_filter_not_equal, "filter_not_contains": q_filter_not_contains,
    "drop_columns": q_drop_columns, "filter_from_date": q_filter_from_date, "cast_types": q_cast_types,
    "clean_incidents": q_clean_incidents, "rename_columns": q_rename_columns, "case_when": q_case_when,
    # staging
    **{f"stage_{n}": _stage(n) for n in P.STAGERS},
    "us_federal_holidays": q_us_federal_holidays, "date_time_functions": q_date_time_functions,
    "hash64": q_hash64, "hash64_chain": q_hash64_chain,
    # joins, aggregates, windows, set ops
    "inner_equi_join": q_inner_equi_join, "star_join": q_star_join, "anti_join": q_anti_join,
    "left_join_flags": q_left_join_flags, "conditional_join": q_conditional_join,
    "cross_join_scalar": q_cross_join_scalar, "lateral_unnest": q_lateral_unnest,
    "join_update": q_join_update, "ordered_listagg": q_ordered_listagg, "distinct_rows": q_distinct_rows,
    "distinct_on_key": q_distinct_on_key, "max_scalar": q_max_scalar, "min_scalar": q_min_scalar,
    "row_number_ids": q_row_number_ids, "union_all": q_union_all,
    # dimensions
    "dim_full_load": q_dim_full_load, "dim_full_load_date": q_dim_full_load_date,
    "dim_full_load_district": q_dim_full_load_district, "scd_full_load": q_scd_full_load,
    "scd_full_load_intersection": q_scd_full_load_intersection, "dim_insert_new": q_dim_insert_new,
    "scd_classify": q_scd_classify, "scd2_expire": q_scd2_expire,
    "scd2_insert_versions": q_scd2_insert_versions, "scd1_overwrite": q_scd1_overwrite,
    "scd_apply": q_scd_apply, "scd_apply_category": q_scd_apply_category, "scd_as_of": q_scd_as_of,
    "scd_apply_revert": q_scd_apply_revert, "scd_apply_revert_category": q_scd_apply_revert_category,
    "new_keys_only": q_new_keys_only,
    # bridge, fact, reports, pipelines
    "group_signature": q_group_signature, "group_ids_full": q_group_ids_full,
    "bridge_full_load": q_bridge_full_load, "group_dim_full": q_group_dim_full,
    "bridge_signatures": q_bridge_signatures, "incoming_signatures": q_incoming_signatures,
    "bridge_insert_new": q_bridge_insert_new, "group_dim_insert_new": q_group_dim_insert_new,
    "fact_full_load": q_fact_full_load, "fact_incremental": q_fact_incremental,
    "fact_unmatched": q_fact_unmatched, "report_year": q_report_year, "report_daily": q_report_daily,
    "report_year_rollup": q_report_year_rollup,
    "pipeline_full": q_pipeline_full, "pipeline_incremental": q_pipeline_incremental,
    "pipeline_full_collapse": q_pipeline_full_collapse,
}


# --- single built-ins of the inventory (regression keys) ---------------------

def _timestamps(spark, sf) -> DataFrame:
    return P._all_timestamps(_clean(spark, sf)).distinct()


def _fn(expr_of_ts):
    def q(spark, sf):
        return _timestamps(spark, sf).select("ts", expr_of_ts(F.col("ts")).alias("v"))
    return q


SCALAR_QUERIES = {
    "date_id": _fn(cal.date_id),
    "full_date": _fn(cal.full_date),
    "year": _fn(F.year),
    "month": _fn(F.month),
    "day_of_month": _fn(F.dayofmonth),
    "month_name": _fn(lambda t: F.date_format(t, "MMMM")),
    "day_of_week": _fn(F.weekday),
    "day_name": _fn(lambda t: F.date_format(t, "EEEE")),
    "quarter_label": _fn(cal.quarter_label),
    "holiday_indicator": _fn(cal.holiday_indicator),
    "weekday_indicator": _fn(cal.weekday_indicator),
    "full_time": _fn(cal.full_time),
    "hour": _fn(F.hour),
    "minute": _fn(F.minute),
    "daytime_indicator": _fn(lambda t: cal.daytime_indicator(F.hour(t))),
    "is_in_set": _fn(lambda t: cal.is_us_federal_holiday(F.to_date(t))),
}


def q_split_to_array(spark, sf):
    g = B.number_groups(q_group_signature(spark, sf))
    parts = F.split("signature", ",")
    return g.select("group_id", F.size(parts).alias("n_parts"), F.element_at(parts, 1).alias("first_part"))


def q_cast_int(spark, sf):
    g = B.number_groups(q_group_signature(spark, sf))
    return g.select("group_id", F.explode(F.split("signature", ",")).alias("part")).select(
        "group_id", "part", F.split_part("part", F.lit("*"), F.lit(1)).cast("int").alias("code"))


def q_cast_date(spark, sf):
    return _full(spark, sf).prod.read("dim_category").select("category_code", "eff_date", "exp_date")


def q_current_date(spark, sf):
    """``as_of`` closes changed versions (no wall clock)."""
    return (_incr(spark, sf).prod.read("dim_intersection").filter("current_flag = 0")
            .select("cnn", "exp_date"))


def q_contains(spark, sf):
    return _raw(spark, sf).select("incident_id", "report_type_description",
                                  F.col("report_type_description").contains(C.EXCLUDED_REPORT_TEXT).alias("v"))


def q_int_add(spark, sf):
    """new group ids = max existing id + position."""
    return _incr(spark, sf).idx.read_load("group_signature", "b2")


def q_reorder_columns(spark, sf):
    f = P.stage_fact_incident(_clean(spark, sf))
    return f.select(*reversed(f.columns))


def q_is_null_filter(spark, sf):
    """C11: staged intersections of batch two without a dimension row."""
    s = _stg2(spark, sf)["dim_intersection"].select(F.col("stg_cnn").alias("cnn")).distinct()
    return s.join(_b1(spark, sf).prod.read("dim_intersection").select("cnn"), "cnn", "left_anti")


def q_sort_in_aggregate(spark, sf):
    """O1: ordering inside the aggregate only (per-incident ordered code list)."""
    return B.group_signature(_clean(spark, sf), "incident_id", "incident_code", "codes")


def q_reset_schema(spark, sf):
    """T1-T3 on the catalog: reset a schema, create typed tables under the
    shared folder, load the staging datasets, count through the catalog."""
    from starloom.sources.tables import create_tables, reset_database
    loc = scratch_path(spark, "catalog")
    db = "starloom_stg_" + loc.rsplit("-", 1)[-1]
    reset_database(spark, db, f"{loc}/db")
    create_tables(spark, db, STG_SCHEMAS, f"{loc}/tables")
    staged = P.stage_all(_clean(spark, sf))
    for t, df in staged.items():
        conform(df, STG_SCHEMAS[t]).write.insertInto(f"{db}.{t}")
    return _contents({t: spark.table(f"{db}.{t}") for t in staged})


QUERIES.update(SCALAR_QUERIES)
QUERIES.update({
    "split_to_array": q_split_to_array, "cast_int": q_cast_int, "cast_date": q_cast_date,
    "current_date": q_current_date, "contains": q_contains, "int_add": q_int_add,
    "reorder_columns": q_reorder_columns, "is_null_filter": q_is_null_filter,
    "sort_in_aggregate": q_sort_in_aggregate, "reset_schema": q_reset_schema,
})
