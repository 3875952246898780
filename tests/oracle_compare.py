"""Run registered queries against their DuckDB oracle (what the driver does).

    python tests/oracle_compare.py [sf_dir] [name ...]

Prints one line per query: rows, columns and an order-insensitive value
hash for both engines.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]
    return len(rows), sorted(cols), h


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = False) -> dict[str, dict]:
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        rec = {}
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            rec["spark"] = digest(df.columns, rows)
        except Exception as e:  # noqa: BLE001
            rec["spark_error"] = f"{type(e).__name__}: {str(e)[:300]}"
        rec["spark_sec"] = round(time.time() - t, 2)
        if name in sql:
            try:
                cur = con.execute(sql[name])
                cols = [d[0] for d in cur.description]
                rec["duck"] = digest(cols, cur.fetchall())
            except Exception as e:  # noqa: BLE001
                rec["duck_error"] = f"{type(e).__name__}: {str(e)[:300]}"
        rec["match"] = rec.get("spark") is not None and rec.get("spark") == rec.get("duck")
        out[name] = rec
        if verbose:
            _report(name, rec)
    return out


def _report(name: str, r: dict) -> bool:
    status = "OK " if r["match"] else ("n/a" if "duck" not in r and "duck_error" not in r and "spark" in r else "BAD")
    print(f"{status} {name:28s} {r.get('spark_sec')}s spark={r.get('spark') or r.get('spark_error')} "
          f"duck={r.get('duck') or r.get('duck_error')}", flush=True)
    return status == "BAD"


def main() -> None:
    from starloom.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", 8)
    res = compare(spark, sf_dir, names, verbose=True)
    bad = sum(not r["match"] and ("duck" in r or "duck_error" in r or "spark" not in r) for r in res.values())
    print(f"{len(res) - bad}/{len(res)} ok")


if __name__ == "__main__":
    main()
