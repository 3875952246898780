"""The raw incidents' joins: small tables are broadcast by their bytes, only the orders are met by a shuffle."""
import datetime as dt
from collections import Counter

import pytest

from starloom.sources.adapter import raw_incidents

DAY = dt.datetime(1998, 1, 1)


@pytest.fixture()
def tables(spark, scratch):
    root = scratch("raw-tables")

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    write("lineitem", [(1, 1, 1, 1, "N", DAY), (1, 2, 1, 2, "R", DAY), (2, 1, 2, 1, "R", DAY), (2, None, 1, 2, "N", DAY),
                       (3, 9, 1, 1, "N", DAY), (None, 1, 1, 1, "N", DAY), (1, 1, None, 3, "N", DAY), (1, 1, 1, 1, "N", DAY)],
          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_shipdate timestamp_ntz")
    write("orders", [(1, DAY, "O", "1-URGENT"), (2, DAY, "F", "4-NOT SPECIFIED"), (2, DAY, "O", "2-HIGH"), (3, DAY, "O", "5-LOW"), (None, DAY, "O", "5-LOW")],
          "o_orderkey long, o_orderdate timestamp_ntz, o_orderstatus string, o_orderpriority string")
    write("part", [(1, "Brand#11"), (1, "Brand#25"), (2, "Brand#32"), (None, "Brand#12")], "p_partkey long, p_brand string")
    write("supplier", [(1, "S1", 100.0), (2, "S2", None), (2, "S2b", 5.0), (None, "S0", 1.0)], "s_suppkey long, s_name string, s_acctbal double")
    return root


def test_repeated_and_missing_keys(spark, tables):
    rows = Counter((r["incident_id"], r["incident_code"], r["intersection"], r["resolution"], r["report_type_description"])
                   for r in raw_incidents(spark, tables).collect())
    assert rows == Counter(
        [(1, 11, "S1", "O", "Initial"), (1, 25, "S1", "O", "Initial")] * 2 + [(1, 32, "S1", "O", "Initial")]
        + [(2, code, name, status, "Vehicle Supplement") for code in (11, 25) for name in ("S2", "S2b") for status in "FO"])
    # collapse: the supplier follows from the order
    rows = Counter((r["incident_id"], r["incident_code"], r["cnn"]) for r in raw_incidents(spark, tables, collapse=True).collect())
    assert rows == Counter([(1, 11, 1), (1, 25, 1)] * 3 + [(1, 32, 1)] + [(2, c, 2) for c in (11, 25) for _ in range(4)])


@pytest.mark.parametrize("collapse", [False, True])
def test_only_the_orders_are_shuffled(spark, tables, collapse):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")        # as for tables above the planner's own bound
    try:
        plan = raw_incidents(spark, tables, collapse)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastHashJoin") == 2
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("Exchange hashpartitioning(") == 2
