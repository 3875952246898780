"""Column contents without expanding rows; raw rows joined once; compressed JSON lines."""

from pyspark.sql import functions as F

from starloom import registry as R
from starloom.sources import zones as Z


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contents_expands_no_rows(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (10, "b", None), (2, "b", 0.5), (None, None, 2.0), (2, "b", 0.5)], "k int, s string, x double")
    got = R._contents({"t": df, "empty": df.limit(0)})
    assert "Expand" not in _plan(got)
    rows = {(r["table_name"], r["column_name"]): tuple(r)[1:2] + tuple(r)[3:] for r in got.collect()}
    assert rows == {("t", "k"): (5, 4, 3, "1", "2"), ("t", "s"): (5, 4, 2, "a", "b"), ("t", "x"): (5, 4, 2, None, None),
                    ("empty", "k"): (0, 0, 0, None, None), ("empty", "s"): (0, 0, 0, None, None), ("empty", "x"): (0, 0, 0, None, None)}


def _write_lines(spark, base):
    for name, rows in {"lineitem": [(1, 1, 1, 1, "R", "2000-01-02"), (1, 2, 1, 2, "N", "1999-01-02"), (2, 1, 7, 1, "N", "1998-05-05"), (2, 1, 7, 1, "N", "1998-05-05")],
                       "orders": [(1, "1999-12-31", "O", "1-URGENT"), (2, "1998-05-01", "F", None)],
                       "part": [(1, "Brand#11"), (2, "Brand#25")], "supplier": [(1, "Supplier 1", 10.5), (7, "Supplier 7", None)]}.items():
        kinds = {"lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, d string",
                 "orders": "o_orderkey bigint, d string, o_orderstatus string, o_orderpriority string",
                 "part": "p_partkey bigint, p_brand string", "supplier": "s_suppkey bigint, s_name string, s_acctbal double"}
        df = spark.createDataFrame(rows, kinds[name])
        if "d" in df.columns:
            df = df.withColumn({"lineitem": "l_shipdate", "orders": "o_orderdate"}[name], F.col("d").cast("timestamp_ntz")).drop("d")
        df.write.parquet(f"{base}/{name}.parquet")


def test_raw_rows_are_joined_once(spark, scratch):
    base = scratch("tables")
    _write_lines(spark, base)
    kept, raw = R._raw_kept(spark, base), R._raw(spark, base)
    assert "Join" in _plan(raw) and "Join" not in _plan(kept)
    assert kept.dtypes == raw.dtypes and kept.count() == 4
    assert kept.exceptAll(raw).count() == 0 and raw.exceptAll(kept).count() == 0


def test_compressed_lines_are_cut_into_files(spark, scratch):
    path = scratch("lines")
    rows = spark.range(10).select(F.col("id").cast("string").alias("a"), F.when(F.col("id") % 3 > 0, "x{]\n").alias("b")).coalesce(1)
    Z.write_json(rows, path, compression="gzip", rows_per_file=4)
    files = spark.read.text(path).inputFiles()
    assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)
    assert sorted(map(tuple, Z.read_raw(spark, path, ["a", "b"], multi_line=False).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
