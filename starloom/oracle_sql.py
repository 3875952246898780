"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly from the operator semantics (SURVEY §2), not from the
Spark code: common table expressions for raw -> cleansed -> staging ->
warehouse, instantiated per batch with a prefix, then one final SELECT per
query.  Tables ``lineitem orders part supplier`` are the driver's views.
"""

from __future__ import annotations

from starloom.schemas import PROD_SCHEMAS, STG_SCHEMAS

# Fixed values (same as the Spark side): see registry.py and adapter.py.
VALID_DATE = "1996-01-01"
SINCE = "1998-01-01"
AS_OF_B2 = "2000-01-01"
AS_OF_B3 = "2000-01-02"
STREAM_AS_OF_1 = "1999-12-31"
SPLIT = "2000-01-01"
ROW_CAP = 1000
VERSION_DATE = "1999-12-31"

TWO64 = "18446744073709551616"
FNV_OFFSET_U = "14695981039346656037"
FNV_PRIME = "1099511628211"

RAW14 = ("incident_datetime, report_datetime, incident_id, report_type_description, incident_code, "
         "incident_category, incident_subcategory, incident_description, resolution, police_district, "
         "intersection, cnn, latitude, longitude")
CLEAN13 = ("incident_datetime, report_datetime, incident_id, incident_code, incident_category, "
           "incident_subcategory, incident_description, resolution, police_district, intersection, cnn, "
           "latitude, longitude")


# --- expressions -------------------------------------------------------------

def fnv_u(expr: str, seed_u: str = f"{FNV_OFFSET_U}::UHUGEINT") -> str:
    """FNV-1a 64 over the characters (ASCII) of ``expr``, as UHUGEINT."""
    return (f"list_reduce(list_transform(range(1, length({expr}) + 1), lambda i: ascii(substr({expr}, i::BIGINT, 1))::UHUGEINT), "
            f"lambda h, b: (xor(h, b) * {FNV_PRIME}::UHUGEINT) % {TWO64}::UHUGEINT, {seed_u})")


def signed(u: str) -> str:
    return (f"CAST(CASE WHEN ({u}) >= 9223372036854775808::UHUGEINT THEN ({u})::HUGEINT - {TWO64}::HUGEINT "
            f"ELSE ({u})::HUGEINT END AS BIGINT)")


def fnv(expr: str) -> str:
    return signed(fnv_u(expr))


def fnv_chain(a: str, b: str) -> str:
    inner_u = fnv_u(b)
    return signed(fnv_u(a, f"({inner_u})"))


def observed(d: str) -> str:
    return f"(CASE dayofweek({d}) WHEN 6 THEN ({d}) - 1 WHEN 0 THEN ({d}) + 1 ELSE ({d}) END)"


def nth_weekday(y: str, m: int, isodow: int, n: int) -> str:
    first = f"make_date({y}, {m}, 1)"
    return f"({first} + ((({isodow} - isodow({first})) + 7) % 7)::INT + {7 * (n - 1)})"


def holidays_of(y: str) -> list[str]:
    last_may = f"make_date({y}, 5, 31)"
    return [
        observed(f"make_date({y}, 1, 1)"),
        f"CASE WHEN {y} >= 2021 THEN {observed(f'make_date({y}, 6, 19)')} END",
        observed(f"make_date({y}, 7, 4)"),
        observed(f"make_date({y}, 11, 11)"),
        observed(f"make_date({y}, 12, 25)"),
        f"CASE WHEN {y} >= 1986 THEN {nth_weekday(y, 1, 1, 3)} END",
        nth_weekday(y, 2, 1, 3),
        nth_weekday(y, 9, 1, 1),
        nth_weekday(y, 10, 1, 2),
        nth_weekday(y, 11, 4, 4),
        f"({last_may} - ((isodow({last_may}) - 1 + 7) % 7)::INT)",
    ]


def date_cols(d: str, p: str = "") -> str:
    return ", ".join([
        f"CAST(strftime({d}, '%Y%m%d') AS INT) AS {p}date_id",
        f"strftime({d}, '%Y-%m-%d') AS {p}full_date",
        f"CAST(year({d}) AS INT) AS {p}year",
        f"CAST(month({d}) AS INT) AS {p}month",
        f"monthname({d}) AS {p}month_name",
        f"CAST(day({d}) AS INT) AS {p}day_of_month",
        f"CAST(isodow({d}) - 1 AS INT) AS {p}day_of_week",
        f"dayname({d}) AS {p}day_name",
        f"CAST(year({d}) AS VARCHAR) || 'Q' || CAST(quarter({d}) AS VARCHAR) AS {p}quarter",
        f"CASE WHEN CAST({d} AS DATE) IN (SELECT hd FROM hol) THEN 'Holiday' ELSE 'Non-Holiday' END AS {p}holiday_indicator",
        f"CASE WHEN isodow({d}) - 1 > 4 THEN 'Weekend' ELSE 'Weekday' END AS {p}weekday_indicator",
    ])


def time_cols(t: str, p: str = "") -> str:
    return ", ".join([
        f"strftime({t}, '%H:%M') AS {p}full_time",
        f"CAST(hour({t}) AS INT) AS {p}hour",
        f"CAST(minute({t}) AS INT) AS {p}minute",
        f"CASE WHEN hour({t}) BETWEEN 6 AND 18 THEN 'Day' ELSE 'Night' END AS {p}daytime_indicator",
    ])


# --- common table expressions -----------------------------------------------

def raw_select(collapse: bool = False) -> str:
    inc = "o_orderdate + to_minutes(o_orderkey % 1440)"
    if collapse:
        rep, sup_join, cnn = inc, "s_suppkey = o_orderkey % 10", "CAST(s_suppkey AS INT)"
    else:
        rep = "l_shipdate + to_minutes((o_orderkey * 7 + l_linenumber) % 1440)"
        sup_join, cnn = "l_suppkey = s_suppkey", "CAST(l_suppkey AS INT)"
    return f"""SELECT {inc} AS incident_datetime, {rep} AS report_datetime, l_orderkey AS incident_id,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'Vehicle Supplement' ELSE 'Initial' END AS report_type_description,
  CAST(substr(p_brand, 7) AS INT) AS incident_code,
  'CAT-' || CAST(CAST(substr(p_brand, 7) AS INT) % 5 AS VARCHAR) AS incident_category,
  nullif(p_brand, 'Brand#25') AS incident_subcategory,
  'about ' || p_brand AS incident_description,
  o_orderstatus AS resolution,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Out of SF' ELSE o_orderpriority END AS police_district,
  s_name AS intersection, {cnn} AS cnn,
  CAST(s_acctbal AS DOUBLE) / 100 AS latitude, -CAST(s_acctbal AS DOUBLE) / 50 AS longitude,
  o_orderdate AS created_at, l_shipdate AS updated_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON {sup_join}"""


def clean_select(src: str) -> str:
    nn = " AND ".join(f"{c.strip()} IS NOT NULL" for c in RAW14.split(","))
    return (f"SELECT {CLEAN13} FROM {src} WHERE {nn} AND police_district <> 'Out of SF' "
            f"AND NOT contains(report_type_description, 'Supplement')")


def stage_ctes(p: str, clean: str) -> list[tuple[str, str]]:
    ts = f"(SELECT incident_datetime AS ts FROM {clean} UNION ALL SELECT report_datetime FROM {clean})"
    return [
        (f"{p}_sdate", f"SELECT {date_cols('d', 'stg_')} FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM {ts})"),
        (f"{p}_stime", f"SELECT {time_cols('t', 'stg_')} FROM (SELECT DISTINCT make_timestamp(2000, 1, 1, hour(ts), minute(ts), 0) AS t FROM {ts})"),
        (f"{p}_sres", f"SELECT DISTINCT resolution AS stg_resolution FROM {clean}"),
        (f"{p}_spd", f"SELECT DISTINCT police_district AS stg_police_district FROM {clean}"),
        (f"{p}_sint", f"SELECT DISTINCT cnn AS stg_cnn, intersection AS stg_intersection, latitude AS stg_latitude, "
                      f"longitude AS stg_longitude FROM {clean}"),
        (f"{p}_scat", f"SELECT DISTINCT incident_code AS stg_category_code, incident_category AS stg_category, "
                      f"incident_subcategory AS stg_subcategory, incident_description AS stg_description FROM {clean}"),
        (f"{p}_sfact", f"""SELECT strftime(incident_datetime, '%Y-%m-%d') AS stg_incident_date,
  strftime(incident_datetime, '%H:%M') AS stg_incident_time,
  strftime(report_datetime, '%Y-%m-%d') AS stg_report_date,
  strftime(report_datetime, '%H:%M') AS stg_report_time,
  incident_id AS stg_incident_id, incident_code AS stg_category_code, resolution AS stg_resolution,
  police_district AS stg_police_district, cnn AS stg_cnn FROM {clean}"""),
    ]


def _collapsed_int(p: str) -> str:
    return f"""SELECT stg_cnn AS cnn, stg_intersection AS intersection, stg_latitude AS latitude, stg_longitude AS longitude,
  {fnv('stg_intersection')} AS track_hash
FROM (SELECT *, row_number() OVER (PARTITION BY stg_cnn ORDER BY stg_intersection ASC NULLS FIRST,
  stg_latitude ASC NULLS FIRST, stg_longitude ASC NULLS FIRST) AS rn FROM {p}_sint) WHERE rn = 1"""


def _collapsed_cat(p: str) -> str:
    return f"""SELECT stg_category_code AS category_code, stg_category AS category, stg_subcategory AS subcategory,
  stg_description AS description, {fnv_chain('stg_category', 'stg_subcategory')} AS track_hash
FROM (SELECT *, row_number() OVER (PARTITION BY stg_category_code ORDER BY stg_category ASC NULLS FIRST,
  stg_subcategory ASC NULLS FIRST, stg_description ASC NULLS FIRST) AS rn FROM {p}_scat) WHERE rn = 1"""


def _signature(src: str, by: str, member: str, out: str) -> str:
    return (f"SELECT {by}, string_agg(CASE WHEN n > 1 THEN {member} || '*' || n ELSE CAST({member} AS VARCHAR) END, ',' "
            f"ORDER BY {member}) AS {out} FROM (SELECT {by}, {member}, count(*) AS n FROM {src} GROUP BY {by}, {member}) GROUP BY {by}")


def _members(src: str, group: str, sig: str, out: str) -> str:
    """A row per member occurrence of each group's signature."""
    return (f"SELECT {group}, CAST(split_part(part, '*', 1) AS BIGINT) AS {out} FROM (SELECT {group}, part, "
            f"unnest(range(coalesce(try_cast(nullif(split_part(part, '*', 2), '') AS BIGINT), 1))) FROM "
            f"(SELECT {group}, unnest(string_split({sig}, ',')) AS part FROM {src}))")


def _contents(tables: dict[str, str], columns: dict[str, list[tuple[str, str]]]) -> str:
    """Rows and, per column, filled and different values, least and most (as text; not of doubles)."""
    out = []
    for t, c in tables.items():
        for name, kind in columns[t]:
            ends = ("NULL::VARCHAR AS least, NULL::VARCHAR AS most" if kind == "double"
                    else f"min(CAST({name} AS VARCHAR)) AS least, max(CAST({name} AS VARCHAR)) AS most")
            out.append(f"SELECT '{t}' AS table_name, count(*) AS n_rows, '{name}' AS column_name, count({name}) AS n_filled, "
                       f"count(DISTINCT {name}) AS n_different, {ends} FROM {c}")
    return " UNION ALL ".join(out)


def _fact(p: str, sfact: str, dims: str, igroups: str, inter_filter: str = "") -> str:
    return f"""SELECT DISTINCT g.category_group_id, r.resolution_id, d1.date_id AS incident_date, t1.time_id AS incident_time,
  d2.date_id AS report_date, t2.time_id AS report_time, i.intersection_id, pd.police_district_id,
  f.stg_incident_id AS incident_id
FROM {sfact} f
JOIN {igroups} g ON f.stg_incident_id = g.incident_id
JOIN {dims}_dim_res r ON f.stg_resolution = r.resolution
JOIN {dims}_dim_date d1 ON f.stg_incident_date = d1.full_date
JOIN {dims}_dim_time t1 ON f.stg_incident_time = t1.full_time
JOIN {dims}_dim_date d2 ON f.stg_report_date = d2.full_date
JOIN {dims}_dim_time t2 ON f.stg_report_time = t2.full_time
JOIN {dims}_dim_int i ON f.stg_cnn = i.cnn {inter_filter}
JOIN {dims}_dim_pd pd ON f.stg_police_district = pd.police_district"""


def full_ctes(p: str) -> list[tuple[str, str]]:
    """E1 from the staging CTEs of prefix ``p``."""
    return [
        (f"{p}_dim_date", f"SELECT stg_date_id AS date_id, stg_full_date AS full_date, stg_year AS year, stg_month AS month, "
                          f"stg_month_name AS month_name, stg_day_of_month AS day_of_month, stg_day_of_week AS day_of_week, "
                          f"stg_day_name AS day_name, stg_quarter AS quarter, stg_holiday_indicator AS holiday_indicator, "
                          f"stg_weekday_indicator AS weekday_indicator FROM {p}_sdate"),
        (f"{p}_dim_time", f"SELECT row_number() OVER (ORDER BY stg_full_time) AS time_id, stg_full_time AS full_time, "
                          f"stg_hour AS hour, stg_minute AS minute, stg_daytime_indicator AS daytime_indicator FROM {p}_stime"),
        (f"{p}_dim_res", f"SELECT row_number() OVER (ORDER BY stg_resolution) AS resolution_id, stg_resolution AS resolution FROM {p}_sres"),
        (f"{p}_dim_pd", f"SELECT row_number() OVER (ORDER BY stg_police_district) AS police_district_id, "
                        f"stg_police_district AS police_district FROM {p}_spd"),
        (f"{p}_dim_int", f"SELECT row_number() OVER (ORDER BY cnn) AS intersection_id, cnn, intersection, latitude, longitude, "
                         f"track_hash, DATE '1970-01-01' AS eff_date, DATE '2999-12-31' AS exp_date, 1 AS current_flag "
                         f"FROM ({_collapsed_int(p)})"),
        (f"{p}_dim_cat", f"SELECT row_number() OVER (ORDER BY category_code) AS category_id, category_code, category, "
                         f"subcategory, description, track_hash, DATE '1970-01-01' AS eff_date, DATE '2999-12-31' AS exp_date, "
                         f"1 AS current_flag FROM ({_collapsed_cat(p)})"),
        (f"{p}_isig", _signature(f"{p}_sfact", "stg_incident_id", "stg_category_code", "signature")),
        (f"{p}_groups", f"SELECT row_number() OVER (ORDER BY signature) AS group_id, signature "
                        f"FROM (SELECT DISTINCT signature FROM {p}_isig)"),
        (f"{p}_br", f"SELECT g.group_id AS category_group_id, c.category_id FROM "
                    f"({_members(f'{p}_groups', 'group_id', 'signature', 'category_code')}) g "
                    f"JOIN {p}_dim_cat c ON g.category_code = c.category_code"),
        (f"{p}_gdim", f"SELECT DISTINCT category_group_id FROM {p}_br"),
        (f"{p}_igroups", f"SELECT s.stg_incident_id AS incident_id, g.group_id AS category_group_id "
                         f"FROM {p}_isig s JOIN {p}_groups g ON s.signature = g.signature"),
        (f"{p}_fact", _fact(p, f"{p}_sfact", p, f"{p}_igroups", "AND i.current_flag = 1")),
        (f"{p}_brsig", _signature(f"{p}_br", "category_group_id", "category_id", "category_id_group")),
    ]


def _scd_next(old: str, stg: str, key: str, attrs: list[str], overwrite: list[str], id_col: str,
              as_of: str = AS_OF_B2) -> list[tuple[str, str]]:
    """CTEs ``{old}_cls`` (classified staging) and ``{old}_next`` (D8 result)."""
    cols = ", ".join(attrs)
    cls = (f"SELECT s.*, CASE WHEN c.{key} IS NULL THEN 1 ELSE 0 END AS new_row, "
           f"CASE WHEN c.{key} IS NOT NULL AND c.track_hash <> s.track_hash THEN 1 ELSE 0 END AS change_row "
           f"FROM {stg} s LEFT JOIN (SELECT {key}, track_hash FROM {old} WHERE current_flag = 1) c ON s.{key} = c.{key}")
    upd_cols = []
    for a in [id_col] + attrs + ["track_hash", "eff_date", "exp_date", "current_flag"]:
        if a in overwrite:
            upd_cols.append(f"CASE WHEN k.new_row = 0 AND k.change_row = 0 THEN k.{a} ELSE d.{a} END AS {a}")
        elif a == "exp_date":
            upd_cols.append(f"CASE WHEN coalesce(k.change_row, 0) = 1 THEN DATE '{as_of}' ELSE d.exp_date END AS exp_date")
        elif a == "current_flag":
            upd_cols.append("CASE WHEN coalesce(k.change_row, 0) = 1 THEN 0 ELSE d.current_flag END AS current_flag")
        else:
            upd_cols.append(f"d.{a}")
    upd = (f"SELECT {', '.join(upd_cols)} FROM {old} d LEFT JOIN {old}_cls k ON d.{key} = k.{key} "
           f"WHERE d.current_flag = 1")
    new = (f"SELECT (SELECT coalesce(max({id_col}), 0) FROM {old}) + row_number() OVER (ORDER BY {key}) AS {id_col}, "
           f"{cols}, track_hash, DATE '{as_of}' AS eff_date, DATE '2999-12-31' AS exp_date, 1 AS current_flag "
           f"FROM {old}_cls WHERE new_row = 1 OR change_row = 1")
    hist = f"SELECT {id_col}, {cols}, track_hash, eff_date, exp_date, current_flag FROM {old} WHERE current_flag <> 1"
    return [(f"{old}_cls", cls), (f"{old}_upd", upd), (f"{old}_new", new),
            (f"{old}_next", f"{hist} UNION ALL SELECT * FROM {old}_upd UNION ALL SELECT * FROM {old}_new")]


def incr_ctes(p1: str, p2: str, as_of: str = AS_OF_B2) -> list[tuple[str, str]]:
    """Batch ``p2`` loaded on top of the warehouse ``p1``; results in ``{p2}_*``."""
    out = [
        (f"{p2}_new_date", f"SELECT stg_date_id AS date_id, stg_full_date AS full_date, stg_year AS year, stg_month AS month, "
                           f"stg_month_name AS month_name, stg_day_of_month AS day_of_month, stg_day_of_week AS day_of_week, "
                           f"stg_day_name AS day_name, stg_quarter AS quarter, stg_holiday_indicator AS holiday_indicator, "
                           f"stg_weekday_indicator AS weekday_indicator FROM {p2}_sdate "
                           f"WHERE stg_date_id NOT IN (SELECT date_id FROM {p1}_dim_date)"),
        (f"{p2}_new_time", f"SELECT (SELECT coalesce(max(time_id), 0) FROM {p1}_dim_time) + row_number() OVER (ORDER BY stg_full_time) AS time_id, "
                           f"stg_full_time AS full_time, stg_hour AS hour, stg_minute AS minute, stg_daytime_indicator AS daytime_indicator "
                           f"FROM {p2}_stime WHERE stg_full_time NOT IN (SELECT full_time FROM {p1}_dim_time)"),
        (f"{p2}_new_res", f"SELECT (SELECT coalesce(max(resolution_id), 0) FROM {p1}_dim_res) + row_number() OVER (ORDER BY stg_resolution) AS resolution_id, "
                          f"stg_resolution AS resolution FROM {p2}_sres WHERE stg_resolution NOT IN (SELECT resolution FROM {p1}_dim_res)"),
        (f"{p2}_new_pd", f"SELECT (SELECT coalesce(max(police_district_id), 0) FROM {p1}_dim_pd) + row_number() OVER (ORDER BY stg_police_district) AS police_district_id, "
                         f"stg_police_district AS police_district FROM {p2}_spd WHERE stg_police_district NOT IN (SELECT police_district FROM {p1}_dim_pd)"),
        (f"{p2}_dim_date", f"SELECT * FROM {p1}_dim_date UNION ALL SELECT * FROM {p2}_new_date"),
        (f"{p2}_dim_time", f"SELECT * FROM {p1}_dim_time UNION ALL SELECT * FROM {p2}_new_time"),
        (f"{p2}_dim_res", f"SELECT * FROM {p1}_dim_res UNION ALL SELECT * FROM {p2}_new_res"),
        (f"{p2}_dim_pd", f"SELECT * FROM {p1}_dim_pd UNION ALL SELECT * FROM {p2}_new_pd"),
        (f"{p2}_sint_c", _collapsed_int(p2)),
        (f"{p2}_scat_c", _collapsed_cat(p2)),
    ]
    out += _scd_next(f"{p1}_dim_int", f"{p2}_sint_c", "cnn", ["cnn", "intersection", "latitude", "longitude"],
                     ["latitude", "longitude"], "intersection_id", as_of)
    out += _scd_next(f"{p1}_dim_cat", f"{p2}_scat_c", "category_code",
                     ["category_code", "category", "subcategory", "description"], ["description"], "category_id", as_of)
    out += [
        (f"{p2}_dim_int", f"SELECT * FROM {p1}_dim_int_next"),
        (f"{p2}_dim_cat", f"SELECT * FROM {p1}_dim_cat_next"),
        (f"{p2}_icat", f"SELECT f.stg_incident_id AS incident_id, c.category_id FROM {p2}_sfact f "
                       f"JOIN {p2}_dim_cat c ON f.stg_category_code = c.category_code AND c.current_flag = 1"),
        (f"{p2}_incoming", _signature(f"{p2}_icat", "incident_id", "category_id", "category_id_group")),
        (f"{p2}_newsig", f"SELECT (SELECT coalesce(max(category_group_id), 0) FROM {p1}_br) + row_number() OVER (ORDER BY category_id_group) "
                         f"AS category_group_id, category_id_group FROM (SELECT DISTINCT category_id_group FROM {p2}_incoming "
                         f"WHERE category_id_group NOT IN (SELECT category_id_group FROM {p1}_brsig))"),
        (f"{p2}_new_br", _members(f"{p2}_newsig", "category_group_id", "category_id_group", "category_id")),
        (f"{p2}_br", f"SELECT * FROM {p1}_br UNION ALL SELECT * FROM {p2}_new_br"),
        (f"{p2}_new_gdim", f"SELECT DISTINCT category_group_id FROM {p2}_br WHERE category_group_id NOT IN (SELECT category_group_id FROM {p1}_gdim)"),
        (f"{p2}_gdim", f"SELECT * FROM {p1}_gdim UNION ALL SELECT * FROM {p2}_new_gdim"),
        (f"{p2}_brsig", _signature(f"{p2}_br", "category_group_id", "category_id", "category_id_group")),
        (f"{p2}_igroups", f"SELECT s.incident_id, b.category_group_id FROM {p2}_incoming s JOIN {p2}_brsig b "
                          f"ON s.category_id_group = b.category_id_group"),
        (f"{p2}_new_fact", _fact(p2, f"{p2}_sfact", p2, f"{p2}_igroups", "AND i.current_flag = 1")),
        (f"{p2}_fact", f"SELECT * FROM {p1}_fact UNION ALL SELECT * FROM {p2}_new_fact"),
    ]
    return out


B1_PRED = f"incident_datetime < TIMESTAMP '{SPLIT}' AND NOT (incident_code > 20) AND NOT (cnn >= 90)"


def _b2_raw(changed: bool) -> str:
    base = f"SELECT * FROM raw WHERE NOT coalesce({B1_PRED}, false)"
    if not changed:
        return base
    return f"""SELECT * REPLACE (
  CASE WHEN incident_code % 7 = 0 THEN incident_subcategory || ' v2' ELSE incident_subcategory END AS incident_subcategory,
  CASE WHEN cnn % 10 = 0 THEN intersection || ' v2' ELSE intersection END AS intersection,
  CASE WHEN incident_code % 7 = 1 THEN incident_description || ' (rev)' ELSE incident_description END AS incident_description,
  CASE WHEN cnn % 10 = 1 THEN latitude + 1 ELSE latitude END AS latitude) FROM ({base})"""


def all_ctes() -> list[tuple[str, str]]:
    years = "range(1960, 2101) t(y)"
    ctes = [
        ("hol", f"SELECT DISTINCT hd FROM (SELECT unnest([{', '.join(holidays_of('y'))}]) AS hd FROM {years}) WHERE hd IS NOT NULL"),
        ("raw", raw_select()),
        ("raw_col", raw_select(collapse=True)),
        ("raw_untidy", "SELECT * REPLACE (CASE WHEN incident_id % 4 IN (0, 1) THEN cnn END AS cnn), cnn AS cnn_written FROM raw"),
        ("d_clean", clean_select("raw_untidy")),
        ("f_clean", f"SELECT * FROM ({clean_select(f"(SELECT * FROM raw WHERE created_at >= TIMESTAMP '{VALID_DATE}' OR updated_at >= TIMESTAMP '{VALID_DATE}')")}) "
                    f"WHERE incident_datetime >= TIMESTAMP '{VALID_DATE}'"),
        ("raw_b1", f"SELECT * FROM raw WHERE {B1_PRED}"),
        ("raw_b2", _b2_raw(True)),
        ("raw_b2u", _b2_raw(False)),
        ("a_clean", clean_select("raw")),
        ("c_clean", clean_select("raw_col")),
        ("b1_clean", clean_select("raw_b1")),
        ("b2_clean", clean_select("raw_b2")),
        ("u2_clean", clean_select("raw_b2u")),
    ]
    ctes += stage_ctes("a", "a_clean") + stage_ctes("c", "c_clean")
    ctes += stage_ctes("b1", "b1_clean") + stage_ctes("b2", "b2_clean") + stage_ctes("u2", "u2_clean")
    ctes += full_ctes("a") + full_ctes("c") + full_ctes("b1")
    ctes += stage_ctes("f", "f_clean") + full_ctes("f")
    # batch two limited to what changed since SINCE, on a warehouse of batch one
    ctes += [("i2_clean", clean_select(f"(SELECT * FROM raw_b2 WHERE created_at >= TIMESTAMP '{SINCE}' OR updated_at >= TIMESTAMP '{SINCE}')"))]
    ctes += stage_ctes("i1", "b1_clean") + full_ctes("i1") + stage_ctes("i2", "i2_clean") + incr_ctes("i1", "i2")
    ctes += incr_ctes("b1", "b2")
    # streaming (S14): batch one, then batch two, both as incremental loads
    # into an empty warehouse
    ctes += [(f"e0_{t}", f"SELECT * FROM b1_{t} WHERE false")
             for t in ("dim_date", "dim_time", "dim_res", "dim_pd", "dim_int", "dim_cat", "br", "gdim", "fact",
                       "brsig")]
    ctes += stage_ctes("s1", "b1_clean") + stage_ctes("s2", "b2_clean")
    ctes += incr_ctes("e0", "s1", STREAM_AS_OF_1) + incr_ctes("s1", "s2", AS_OF_B2)
    ctes += [("u2_sint_c", _collapsed_int("u2")), ("u2_scat_c", _collapsed_cat("u2"))]
    ctes += _scd_next("b2_dim_int", "u2_sint_c", "cnn", ["cnn", "intersection", "latitude", "longitude"],
                      ["latitude", "longitude"], "intersection_id", AS_OF_B3)
    ctes += _scd_next("b2_dim_cat", "u2_scat_c", "category_code",
                      ["category_code", "category", "subcategory", "description"], ["description"], "category_id", AS_OF_B3)
    return ctes


def with_clause() -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in all_ctes())


def _q(body: str) -> str:
    return f"{with_clause()}\n{body}"


def _columns(schemas) -> dict[str, list[tuple[str, str]]]:
    return {t: [(f.name, f.dataType.typeName()) for f in s.fields] for t, s in schemas.items()}


def _natural_fact(p: str) -> str:
    return f"""SELECT f.incident_id, s.category_codes, r.resolution, d1.full_date AS incident_day, t1.full_time AS incident_hhmm,
  d2.full_date AS report_day, t2.full_time AS report_hhmm, i.cnn, pd.police_district
FROM {p}_fact f
JOIN ({_signature(f"(SELECT b.category_group_id, c.category_code FROM {p}_br b JOIN {p}_dim_cat c ON b.category_id = c.category_id)",
                  "category_group_id", "category_code", "category_codes")}) s ON f.category_group_id = s.category_group_id
JOIN {p}_dim_res r ON f.resolution_id = r.resolution_id
JOIN {p}_dim_date d1 ON f.incident_date = d1.date_id
JOIN {p}_dim_time t1 ON f.incident_time = t1.time_id
JOIN {p}_dim_date d2 ON f.report_date = d2.date_id
JOIN {p}_dim_time t2 ON f.report_time = t2.time_id
JOIN {p}_dim_int i ON f.intersection_id = i.intersection_id
JOIN {p}_dim_pd pd ON f.police_district_id = pd.police_district_id"""


def _categories(p: str) -> str:
    return f"(SELECT DISTINCT b.category_group_id, c.category FROM {p}_br b JOIN {p}_dim_cat c ON b.category_id = c.category_id)"


def _unmatched() -> str:
    checks = [
        ("resolution", "b1_dim_res r", "f.stg_resolution = r.resolution", "r.resolution_id"),
        ("incident_date", "b1_dim_date d1", "f.stg_incident_date = d1.full_date", "d1.date_id"),
        ("incident_time", "b1_dim_time t1", "f.stg_incident_time = t1.full_time", "t1.time_id"),
        ("report_date", "b1_dim_date d2", "f.stg_report_date = d2.full_date", "d2.date_id"),
        ("report_time", "b1_dim_time t2", "f.stg_report_time = t2.full_time", "t2.time_id"),
        ("intersection", "(SELECT * FROM b1_dim_int WHERE current_flag = 1) i", "f.stg_cnn = i.cnn", "i.intersection_id"),
        ("police_district", "b1_dim_pd pd", "f.stg_police_district = pd.police_district", "pd.police_district_id"),
    ]
    joins = " ".join(f"LEFT JOIN {t} ON {c}" for _, t, c, _ in checks)
    grp = (f"(SELECT s.incident_id, b.category_group_id FROM ({_signature('''(SELECT f.stg_incident_id AS incident_id, c.category_id
        FROM b2_sfact f JOIN b1_dim_cat c ON f.stg_category_code = c.category_code AND c.current_flag = 1)''',
        'incident_id', 'category_id', 'category_id_group')}) s JOIN b1_brsig b ON s.category_id_group = b.category_id_group) g")
    sums = ", ".join(f"count(*) FILTER (WHERE {idc} IS NULL) AS {n}" for n, _, _, idc in checks)
    names = [n for n, *_ in checks] + ["category_group"]
    agg = f"SELECT {sums}, count(*) FILTER (WHERE g.category_group_id IS NULL) AS category_group FROM b2_sfact f {joins} LEFT JOIN {grp} ON f.stg_incident_id = g.incident_id"
    return " UNION ALL ".join(f"SELECT '{n}' AS dimension, {n} AS n_unmatched FROM ({agg})" for n in names)


def _holiday_range() -> str:
    return f"""SELECT DISTINCT hd AS holiday_date FROM (
  SELECT unnest([{', '.join(holidays_of('y'))}]) AS hd, lo, hi FROM (
    SELECT lo, hi, unnest(range(year(lo) - 1, year(hi) + 2)) AS y FROM (
      SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM
        (SELECT incident_datetime AS ts FROM a_clean UNION ALL SELECT report_datetime FROM a_clean))))
WHERE hd BETWEEN lo AND hi"""


def queries() -> dict[str, str]:
    raw14 = f"SELECT {RAW14} FROM raw"
    strings = ["report_type_description", "incident_category", "incident_subcategory", "incident_description",
               "resolution", "police_district", "intersection"]
    nbytes = " + ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)), 0)" for c in [*strings, "incident_id", "incident_code", "cnn"])
    sfact_cols = ("stg_incident_date, stg_incident_time, stg_report_date, stg_report_time, stg_incident_id, "
                  "stg_category_code, stg_resolution, stg_police_district, stg_cnn")
    audit = f"""SELECT outcome, count(*) AS n_rows FROM (SELECT CASE
  WHEN incident_id % 4 = 2 AND cnn_written IS NOT NULL THEN 'malformed'
  WHEN {' OR '.join(f'{c.strip()} IS NULL' for c in RAW14.split(','))} THEN 'null_value'
  WHEN police_district = 'Out of SF' THEN 'excluded_district'
  WHEN contains(report_type_description, 'Supplement') THEN 'supplement'
  WHEN incident_datetime < TIMESTAMP '{VALID_DATE}' THEN 'before_valid_date'
  ELSE 'kept' END AS outcome FROM (SELECT * FROM raw_untidy UNION ALL
    SELECT * FROM raw_untidy WHERE incident_id IN (SELECT min(incident_id) FROM raw_untidy UNION ALL SELECT max(incident_id) FROM raw_untidy))
  UNION ALL SELECT unnest(['corrupt', 'corrupt'])) GROUP BY outcome"""
    ts_all = "(SELECT incident_datetime AS ts FROM a_clean UNION ALL SELECT report_datetime FROM a_clean)"
    q = {
        "json_scan": raw14,
        "parquet_scan": "SELECT incident_id, incident_code, resolution, latitude FROM a_clean",
        "parquet_sink": "SELECT * FROM a_sfact",
        "json_sink": "SELECT * FROM a_scat",
        "dated_layout": "SELECT strftime(incident_datetime, '%Y-%m-%d') AS ds, count(*) AS n_rows FROM raw GROUP BY 1",
        "change_window": f"SELECT * FROM raw WHERE created_at >= TIMESTAMP '{SINCE}' OR updated_at >= TIMESTAMP '{SINCE}'",
        "full_extract": f"SELECT * FROM raw WHERE created_at >= TIMESTAMP '{VALID_DATE}' OR updated_at >= TIMESTAMP '{VALID_DATE}'",
        "row_cap": f"SELECT * FROM a_clean ORDER BY {CLEAN13} LIMIT {ROW_CAP}",
        "size_gate": f"SELECT count(*) AS n_rows, CAST(sum({nbytes}) AS BIGINT) AS n_bytes, true AS stopped_below FROM raw",
        "load_audit": audit,
        "truncate_load": "SELECT * FROM a_sfact",
        "append_load": "SELECT * FROM b1_sfact UNION ALL SELECT * FROM u2_sfact",
        "column_list_load": ("SELECT NULL::VARCHAR AS stg_incident_date, NULL::VARCHAR AS stg_incident_time, "
                             "NULL::VARCHAR AS stg_report_date, NULL::VARCHAR AS stg_report_time, stg_incident_id, "
                             "stg_category_code, NULL::VARCHAR AS stg_resolution, NULL::VARCHAR AS stg_police_district, "
                             "stg_cnn FROM a_sfact"),
        "staging_tables": _contents({t: f"a_{c}" for t, c in [
            ("dim_date", "sdate"), ("dim_time", "stime"), ("dim_resolution", "sres"), ("dim_police_district", "spd"),
            ("dim_intersection", "sint"), ("dim_category", "scat"), ("fact_incident", "sfact")]}, _columns(STG_SCHEMAS)),
        "prod_tables": _contents({t: f"a_{c}" for t, c in [
            ("dim_date", "dim_date"), ("dim_time", "dim_time"), ("dim_resolution", "dim_res"),
            ("dim_police_district", "dim_pd"), ("dim_intersection", "dim_int"), ("dim_category", "dim_cat"),
            ("br_category_group", "br"), ("dim_category_group", "gdim"), ("fact_incident", "fact")]}, _columns(PROD_SCHEMAS)),
        "surrogate_key": "SELECT incident_id, row_number() OVER (ORDER BY incident_id) AS incident_key FROM (SELECT DISTINCT incident_id FROM a_clean)",
        "column_defaults": ("SELECT NULL::BIGINT AS category_id, stg_category_code AS category_code, stg_category AS category, "
                            "stg_subcategory AS subcategory, stg_description AS description, NULL::BIGINT AS track_hash, "
                            "DATE '1970-01-01' AS eff_date, DATE '2999-12-31' AS exp_date, 1 AS current_flag FROM a_scat"),
        "replicated_dims": ("SELECT f.stg_incident_id, f.stg_category_code, f.stg_report_time, p.police_district_id "
                            "FROM a_sfact f JOIN a_dim_pd p ON f.stg_police_district = p.police_district"),
        "project_columns": raw14,
        "drop_any_null": f"{raw14} WHERE {' AND '.join(f'{c.strip()} IS NOT NULL' for c in RAW14.split(','))}",
        "filter_not_equal": f"{raw14} WHERE police_district <> 'Out of SF'",
        "filter_not_contains": f"{raw14} WHERE NOT contains(report_type_description, 'Supplement')",
        "drop_columns": f"SELECT {CLEAN13} FROM raw",
        "filter_from_date": f"SELECT * FROM a_clean WHERE incident_datetime >= TIMESTAMP '{VALID_DATE}'",
        "cast_types": f"SELECT {RAW14} FROM raw_untidy",
        "clean_incidents": f"SELECT * FROM d_clean WHERE incident_datetime >= TIMESTAMP '{VALID_DATE}'",
        "rename_columns": ("SELECT incident_id, cnn AS stg_cnn, intersection AS stg_intersection, latitude AS stg_latitude, "
                           "longitude AS stg_longitude FROM a_clean"),
        "case_when": ("SELECT incident_id, report_datetime, CASE WHEN isodow(incident_datetime) - 1 > 4 THEN 'Weekend' "
                      "ELSE 'Weekday' END AS weekday_indicator, CASE WHEN hour(report_datetime) BETWEEN 6 AND 18 "
                      "THEN 'Day' ELSE 'Night' END AS daytime_indicator FROM a_clean"),
        "stage_dim_date": "SELECT * FROM a_sdate",
        "stage_dim_time": "SELECT * FROM a_stime",
        "stage_dim_resolution": "SELECT * FROM a_sres",
        "stage_dim_police_district": "SELECT * FROM a_spd",
        "stage_dim_intersection": "SELECT * FROM a_sint",
        "stage_dim_category": "SELECT * FROM a_scat",
        "stage_fact_incident": "SELECT * FROM a_sfact",
        "us_federal_holidays": _holiday_range(),
        "date_time_functions": f"SELECT ts, {date_cols('ts')}, {time_cols('ts')} FROM (SELECT DISTINCT ts FROM {ts_all})",
        "hash64": f"SELECT stg_cnn, stg_intersection, {fnv('stg_intersection')} AS h FROM (SELECT DISTINCT stg_cnn, stg_intersection FROM a_sint)",
        "hash64_chain": (f"SELECT stg_category, stg_subcategory, {fnv_chain('stg_category', 'stg_subcategory')} AS h "
                         f"FROM (SELECT DISTINCT stg_category, stg_subcategory FROM a_scat)"),
        "inner_equi_join": ("SELECT f.stg_incident_id, f.stg_incident_time, c.category_id FROM a_sfact f "
                            "JOIN a_dim_cat c ON f.stg_category_code = c.category_code"),
        "star_join": """SELECT r.resolution_id, d1.date_id AS incident_date, t1.time_id AS incident_time, d2.date_id AS report_date,
  t2.time_id AS report_time, i.intersection_id, pd.police_district_id, f.stg_incident_id AS incident_id
FROM a_sfact f JOIN a_dim_res r ON f.stg_resolution = r.resolution
JOIN a_dim_date d1 ON f.stg_incident_date = d1.full_date JOIN a_dim_time t1 ON f.stg_incident_time = t1.full_time
JOIN a_dim_date d2 ON f.stg_report_date = d2.full_date JOIN a_dim_time t2 ON f.stg_report_time = t2.full_time
JOIN a_dim_int i ON f.stg_cnn = i.cnn AND i.current_flag = 1 JOIN a_dim_pd pd ON f.stg_police_district = pd.police_district""",
        "anti_join": "SELECT * FROM b2_sfact WHERE stg_incident_id NOT IN (SELECT incident_id FROM b1_fact)",
        "left_join_flags": "SELECT * FROM b1_dim_int_cls",
        "conditional_join": "SELECT * FROM b2_icat",
        "cross_join_scalar": "SELECT stg_full_time, (SELECT coalesce(max(time_id), 0) FROM b1_dim_time) + stg_minute AS shifted_id FROM b2_stime",
        "lateral_unnest": _members("a_groups", "group_id", "signature", "category_code"),
        "join_update": "SELECT * FROM b1_dim_cat_upd",
        "ordered_listagg": _signature("a_br", "category_group_id", "category_id", "category_id_group"),
        "distinct_rows": "SELECT DISTINCT resolution, police_district, incident_category FROM a_clean",
        "distinct_on_key": ("SELECT stg_cnn, stg_intersection, stg_latitude, stg_longitude FROM (SELECT *, row_number() OVER "
                            "(PARTITION BY stg_cnn ORDER BY stg_intersection ASC NULLS FIRST, stg_latitude ASC NULLS FIRST, "
                            "stg_longitude ASC NULLS FIRST) AS rn FROM b2_sint) WHERE rn = 1"),
        "max_scalar": "SELECT max(incident_id) AS max_incident_id, max(report_datetime) AS max_report_datetime FROM a_clean",
        "min_scalar": "SELECT min(incident_datetime) AS min_incident_datetime, min(report_datetime) AS min_report_datetime FROM a_clean",
        "row_number_ids": "SELECT * FROM a_groups",
        "union_all": ts_all.strip("()"),
        "dim_full_load": "SELECT * FROM a_dim_time",
        "dim_full_load_date": "SELECT * FROM a_dim_date",
        "dim_full_load_district": "SELECT * FROM a_dim_pd",
        "scd_full_load": "SELECT * FROM a_dim_cat",
        "scd_full_load_intersection": "SELECT * FROM a_dim_int",
        "dim_insert_new": ("SELECT (SELECT 100 + count(*) FILTER (stg_hour % 2 = 0) FROM a_stime) + row_number() OVER "
                           "(ORDER BY stg_full_time) AS time_id, stg_full_time AS full_time, stg_hour AS hour, "
                           "stg_minute AS minute, stg_daytime_indicator AS daytime_indicator FROM a_stime WHERE stg_hour % 2 = 1"),
        "scd_classify": "SELECT * FROM b1_dim_cat_cls",
        "scd2_expire": (f"SELECT intersection_id, cnn, intersection, latitude, longitude, track_hash, eff_date, "
                        f"DATE '{AS_OF_B2}' AS exp_date, 0 AS current_flag FROM b1_dim_int WHERE current_flag = 1 "
                        f"AND cnn IN (SELECT cnn FROM b1_dim_int_cls WHERE change_row = 1)"),
        "scd2_insert_versions": "SELECT * FROM b1_dim_int_new",
        "scd1_overwrite": ("SELECT d.intersection_id, d.cnn, d.intersection, k.latitude, k.longitude, d.track_hash, d.eff_date, "
                           "d.exp_date, d.current_flag FROM b1_dim_int d JOIN b1_dim_int_cls k ON d.cnn = k.cnn "
                           "WHERE d.current_flag = 1 AND k.new_row = 0 AND k.change_row = 0"),
        "scd_apply": "SELECT * FROM b2_dim_int",
        "scd_apply_category": "SELECT * FROM b2_dim_cat",
        "scd_as_of": f"SELECT * FROM b2_dim_cat WHERE eff_date <= DATE '{VERSION_DATE}' AND DATE '{VERSION_DATE}' < exp_date",
        "group_signature": "SELECT * FROM a_isig",
        "group_ids_full": "SELECT * FROM a_groups",
        "bridge_full_load": "SELECT * FROM a_br",
        "group_dim_full": "SELECT * FROM a_gdim",
        "bridge_signatures": "SELECT * FROM b1_brsig",
        "incoming_signatures": "SELECT * FROM b2_incoming",
        "bridge_insert_new": "SELECT * FROM b2_new_br",
        "group_dim_insert_new": "SELECT * FROM b2_new_gdim",
        "fact_full_load": "SELECT * FROM a_fact",
        "fact_incremental": "SELECT * FROM b2_new_fact",
        "fact_unmatched": _unmatched(),
        "report_year": f"""SELECT d.year, d.month, c.category, pd.police_district, r.resolution, count(DISTINCT f.incident_id) AS n_incidents
FROM a_fact f JOIN a_dim_date d ON f.incident_date = d.date_id JOIN a_dim_pd pd ON f.police_district_id = pd.police_district_id
JOIN a_dim_res r ON f.resolution_id = r.resolution_id JOIN {_categories('a')} c ON f.category_group_id = c.category_group_id
GROUP BY 1, 2, 3, 4, 5""",
        "report_daily": f"""SELECT d.full_date, t.hour, t.daytime_indicator, c.category, pd.police_district, count(DISTINCT f.incident_id) AS n_incidents
FROM a_fact f JOIN a_dim_date d ON f.incident_date = d.date_id JOIN a_dim_time t ON f.incident_time = t.time_id
JOIN a_dim_pd pd ON f.police_district_id = pd.police_district_id JOIN {_categories('a')} c ON f.category_group_id = c.category_group_id
GROUP BY 1, 2, 3, 4, 5""",
        "pipeline_full": _natural_fact("f"),
        "pipeline_incremental": _natural_fact("i2"),
        "pipeline_full_collapse": "SELECT * FROM c_fact",
        "micro_batch": "SELECT * FROM s2_fact",
        "scd_apply_revert": "SELECT * FROM b2_dim_int_next",
        "scd_apply_revert_category": "SELECT * FROM b2_dim_cat_next",
        "new_keys_only": "SELECT stg_category_code AS category_code FROM b2_scat WHERE stg_category_code NOT IN (SELECT category_code FROM b1_dim_cat)",
        "report_year_rollup": f"""SELECT d.year, d.month, pd.police_district, count(DISTINCT f.incident_id) AS n_incidents
FROM a_fact f JOIN a_dim_date d ON f.incident_date = d.date_id JOIN a_dim_pd pd ON f.police_district_id = pd.police_district_id
GROUP BY ROLLUP (d.year, d.month, pd.police_district)""",
    }
    ts = f"(SELECT DISTINCT ts FROM {ts_all})"
    scalar = {
        "date_id": "CAST(strftime(ts, '%Y%m%d') AS INT)",
        "full_date": "strftime(ts, '%Y-%m-%d')",
        "year": "CAST(year(ts) AS INT)",
        "month": "CAST(month(ts) AS INT)",
        "day_of_month": "CAST(day(ts) AS INT)",
        "month_name": "monthname(ts)",
        "day_of_week": "CAST(isodow(ts) - 1 AS INT)",
        "day_name": "dayname(ts)",
        "quarter_label": "CAST(year(ts) AS VARCHAR) || 'Q' || CAST(quarter(ts) AS VARCHAR)",
        "holiday_indicator": "CASE WHEN CAST(ts AS DATE) IN (SELECT hd FROM hol) THEN 'Holiday' ELSE 'Non-Holiday' END",
        "weekday_indicator": "CASE WHEN isodow(ts) - 1 > 4 THEN 'Weekend' ELSE 'Weekday' END",
        "full_time": "strftime(ts, '%H:%M')",
        "hour": "CAST(hour(ts) AS INT)",
        "minute": "CAST(minute(ts) AS INT)",
        "daytime_indicator": "CASE WHEN hour(ts) BETWEEN 6 AND 18 THEN 'Day' ELSE 'Night' END",
        "is_in_set": "CAST(ts AS DATE) IN (SELECT hd FROM hol)",
    }
    for k, expr in scalar.items():
        q[k] = f"SELECT ts, {expr} AS v FROM {ts}"
    q.update({
        "split_to_array": ("SELECT group_id, CAST(len(string_split(signature, ',')) AS INT) AS n_parts, "
                           "string_split(signature, ',')[1] AS first_part FROM a_groups"),
        "cast_int": ("SELECT group_id, part, CAST(split_part(part, '*', 1) AS INT) AS code FROM "
                     "(SELECT group_id, unnest(string_split(signature, ',')) AS part FROM a_groups)"),
        "cast_date": "SELECT category_code, eff_date, exp_date FROM a_dim_cat",
        "current_date": "SELECT cnn, exp_date FROM b2_dim_int WHERE current_flag = 0",
        "contains": "SELECT incident_id, report_type_description, contains(report_type_description, 'Supplement') AS v FROM raw",
        "int_add": "SELECT * FROM b2_newsig",
        "reorder_columns": "SELECT * FROM a_sfact",
        "is_null_filter": "SELECT DISTINCT stg_cnn AS cnn FROM b2_sint WHERE stg_cnn NOT IN (SELECT cnn FROM b1_dim_int)",
        "sort_in_aggregate": _signature("a_clean", "incident_id", "incident_code", "codes"),
        "reset_schema": q["staging_tables"],
    })
    return {k: _q(v) for k, v in q.items()}
