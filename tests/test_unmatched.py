"""Unmatched rows are counted per incident before they meet the incident's group."""
import re

from starloom.operators.fact import KEY_COLUMNS, fact_unmatched
from starloom.schemas import PROD_SCHEMAS, STG_SCHEMAS


def _dims(spark):
    def one(table, **values):
        fields = PROD_SCHEMAS[table].fieldNames()
        return spark.createDataFrame([tuple(values.get(f) for f in fields)], PROD_SCHEMAS[table])
    return {"dim_date": one("dim_date", date_id=19980101, full_date="1998-01-01"), "dim_time": one("dim_time", time_id=1, full_time="00:00"),
            "dim_resolution": one("dim_resolution", resolution_id=1, resolution="O"),
            "dim_police_district": one("dim_police_district", police_district_id=1, police_district="P"),
            "dim_intersection": one("dim_intersection", intersection_id=1, cnn=7, current_flag=1)}


def _counts(spark, rows, groups):
    stg = spark.createDataFrame(rows, STG_SCHEMAS["fact_incident"])
    return fact_unmatched(stg, _dims(spark), spark.createDataFrame(groups, "incident_id long, category_group_id long"))


def test_counts_with_missing_and_repeated_incidents(spark):
    def row(i, day="1998-01-01", resolution="O", cnn=7):
        return (day, "00:00", "1998-01-01", "00:00", i, 1, resolution, "P", cnn)
    rows = [row(1), row(1, cnn=8), row(1, day=None), row(2, resolution="x"), row(2), row(None), row(None, cnn=None), row(3)]
    got = {r["dimension"]: r["n_unmatched"] for r in _counts(spark, rows, [(1, 10), (2, 20), (2, 21), (None, 5)]).collect()}
    want = dict.fromkeys(KEY_COLUMNS, 0) | {"incident_date": 1, "resolution": 2, "intersection": 2, "category_group": 3}
    assert got == want
    assert {r["n_unmatched"] for r in _counts(spark, [], []).collect()} == {0}


def test_one_row_of_each_incident_meets_its_group(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _counts(spark, [], [(1, 10)])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = re.search(r"SortMergeJoin \[incident_id#\d+L\]", plan)
    assert join and re.search(r"HashAggregate\(keys=\[incident_id#\d+L\]", plan[join.end():])
