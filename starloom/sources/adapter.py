"""Raw incident records derived from the driver's TPC-H-style tables.

An order is an incident and its lines are its categories, which gives the
many-to-many bridge (FIXTURES.md §2).  Everything is a lazy DataFrame over
the Parquet tables, so it grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.keys import checked_broadcast

# Fixed values shared with the SQL oracle (FIXTURES.md §2 and §4).
OUT_OF_DISTRICT = "Out of SF"
SUPPLEMENT_TEXT = "Vehicle Supplement"
NULL_SUBCATEGORY_BRAND = "Brand#25"
SPLIT_DATE = "2000-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), ts)


def untidy(raw: DataFrame) -> DataFrame:
    """The raw records as text, with one id column written in several ways:
    as a decimal, plainly, malformed and missing (by incident id)."""
    from starloom.sources.zones import as_raw_strings
    way = F.col("incident_id") % 4
    cnn = (F.when(way == 0, F.concat(F.col("cnn").cast("string"), F.lit(".0"))).when(way == 1, F.col("cnn").cast("string"))
           .when(way == 2, F.concat(F.col("cnn").cast("string"), F.lit("x"))))
    return as_raw_strings(raw.withColumn("cnn", cnn))


def raw_incidents(spark: SparkSession, sf_dir: str, collapse: bool = False) -> DataFrame:
    """The 14 raw incident columns plus ``created_at`` / ``updated_at``.

    ``collapse=True`` is the variant where report time equals incident time
    and the intersection depends on the order only, so the fact's DISTINCT
    removes rows.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    # The two small tables first, broadcast where their bytes allow it: less is shuffled to meet the orders.
    p = checked_broadcast(table(spark, sf_dir, "part").select("p_partkey", "p_brand"))
    s = checked_broadcast(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"))

    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    incident_ts = _plus_minutes(F.col("o_orderdate"), F.col("o_orderkey") % 1440)
    if collapse:
        j = j.join(s, F.col("s_suppkey") == F.col("o_orderkey") % 10)
        report_ts = incident_ts
        cnn = F.col("s_suppkey").cast("int")
    else:
        j = j.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        report_ts = _plus_minutes(F.col("l_shipdate"),
                                  (F.col("o_orderkey") * 7 + F.col("l_linenumber")) % 1440)
        cnn = F.col("l_suppkey").cast("int")

    code = F.substring("p_brand", 7, 100).cast("int")
    return j.select(
        incident_ts.alias("incident_datetime"),
        report_ts.alias("report_datetime"),
        F.col("l_orderkey").alias("incident_id"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), F.lit(SUPPLEMENT_TEXT))
         .otherwise(F.lit("Initial")).alias("report_type_description"),
        code.alias("incident_code"),
        F.concat(F.lit("CAT-"), (code % 5).cast("string")).alias("incident_category"),
        F.when(F.col("p_brand") != NULL_SUBCATEGORY_BRAND, F.col("p_brand")).alias("incident_subcategory"),
        F.concat(F.lit("about "), F.col("p_brand")).alias("incident_description"),
        F.col("o_orderstatus").alias("resolution"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(OUT_OF_DISTRICT))
         .otherwise(F.col("o_orderpriority")).alias("police_district"),
        F.col("s_name").alias("intersection"),
        cnn.alias("cnn"),
        (F.col("s_acctbal").cast("double") / 100).alias("latitude"),
        (-F.col("s_acctbal").cast("double") / 50).alias("longitude"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
    )


def _in_batch_one():
    return ((F.col("incident_datetime") < F.to_timestamp_ntz(F.lit(SPLIT_DATE)))
            & ~(F.col("incident_code") > 20) & ~(F.col("cnn") >= 90))


def batch_one(raw: DataFrame) -> DataFrame:
    """Full-load batch: incidents before the split date, new keys held back."""
    return raw.filter(_in_batch_one())


def batch_two(raw: DataFrame, changed: bool = True) -> DataFrame:
    """Incremental batch: every row not in batch one (from the split date on,
    plus the held-back rows, which arrive late as new keys), with injected
    dimension changes.  Batches one and two together hold every raw row.

    ``changed=False`` gives the same rows with the original values (the
    A→B→A revert batch).
    """
    b = raw.filter(~F.coalesce(_in_batch_one(), F.lit(False)))
    if not changed:
        return b
    code, cnn = F.col("incident_code"), F.col("cnn")
    return b.withColumns({
        "incident_subcategory": F.when(code % 7 == 0, F.concat(F.col("incident_subcategory"), F.lit(" v2")))
                                 .otherwise(F.col("incident_subcategory")),
        "intersection": F.when(cnn % 10 == 0, F.concat(F.col("intersection"), F.lit(" v2")))
                         .otherwise(F.col("intersection")),
        "incident_description": F.when(code % 7 == 1, F.concat(F.col("incident_description"), F.lit(" (rev)")))
                                 .otherwise(F.col("incident_description")),
        "latitude": F.when(cnn % 10 == 1, F.col("latitude") + 1).otherwise(F.col("latitude")),
    })
