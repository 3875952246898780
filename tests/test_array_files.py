"""Array files are written record by record: one array a file, every record in it once, no page held by a task."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from starloom.sources.zones import read_raw, write_json_arrays

TEXTS = ["plain", "},{", 'say "hi"', "a\nb", "]", "", None]


def frame(spark, n):
    texts = F.array(*[F.lit(t) for t in TEXTS])
    return spark.range(0, n, 1, 8).select(F.col("id").cast("string").alias("a"),
                                          F.element_at(texts, (F.col("id") % len(TEXTS) + 1).cast("int")).alias("b"))


def files(path):
    return [json.loads(open(f, encoding="utf-8").read()) for f in glob.glob(f"{path}/part-*")]


@pytest.fixture()
def apart(spark):
    """Shuffle partitions stay apart, as those of a large table do."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_a_file_holds_one_array_and_every_record_comes_back(spark, tmp_path, apart):
    rows, path = frame(spark, 3000), str(tmp_path / "arrays")
    write_json_arrays(rows, path, rows_per_file=50)
    pages = files(path)
    assert len(pages) == 60 and sum(map(len, pages)) == 3000 and max(map(len, pages)) < 100
    got = read_raw(spark, path, ["a", "b"], damaged=True)
    assert got.filter("_corrupt_record is not null").count() == 0
    got = got.select("a", "b")
    assert got.exceptAll(rows).count() == rows.exceptAll(got).count() == 0


def test_no_row_holds_more_than_a_record(spark, tmp_path):
    path = str(tmp_path / "arrays")
    write_json_arrays(frame(spark, 3000).unionByName(frame(spark, 1).crossJoin(spark.range(500)).drop("id")), path, rows_per_file=1000)
    assert sum(map(len, files(path))) == 3500
    assert spark.read.text(path).agg(F.max(F.length("value"))).first()[0] < 60


def test_empty_and_small_tables_and_a_limit_of_the_session(spark, tmp_path):
    path = str(tmp_path / "arrays")
    write_json_arrays(frame(spark, 0), path)
    assert files(path) == [[]]
    name = "spark.sql.files.maxRecordsPerFile"
    spark.conf.set(name, 3)
    try:
        write_json_arrays(frame(spark, 10), path, rows_per_file=None)
    finally:
        spark.conf.unset(name)
    assert [len(x) for x in files(path)] == [10]


def test_files_that_were_cut_off(spark, tmp_path):
    path = str(tmp_path / "arrays")
    write_json_arrays(frame(spark, 20), path)
    write_json_arrays(frame(spark, 7), path, rows_per_file=None, end=',{"a":"1', append=True)
    write_json_arrays(frame(spark, 5), path, rows_per_file=None, end="", append=True)
    got = read_raw(spark, path, ["a", "b"], damaged=True)
    assert got.filter("_corrupt_record is null").count() == 32
    assert got.filter("_corrupt_record is not null").count() == 2
