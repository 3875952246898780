"""A co-located layout of the staged fact (G1, G2): no shuffle of it after it is staged.

The staged fact is written in buckets of (incident, salt), and so are the group
ids of its incidents; the fact's distinct and its join on the incident then read
buckets and need no exchange.  An incident with more than ``HOT_ROWS`` rows is
dealt over as many salts as it has multiples of them, by a hash of the columns
that the distinct looks at (equal rows meet in one bucket); its group id is
written once for each salt.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.keys import checked_broadcast

#: Rows of an incident that share a bucket.
HOT_ROWS = 1_000_000
SALT = "salt"
_INCIDENT = "stg_incident_id"
#: Staged columns that only the group id is made of.
_GROUP_ONLY = ("stg_category_code",)


def hot_incidents(clean: DataFrame, incident: str = "incident_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """(incident, salts) of incidents with more than ``hot_rows`` rows: at most one for each ``hot_rows`` rows of the batch.

    Reads one column; counts are combined before they are shuffled.
    """
    counts = clean.groupBy(F.col(incident).alias("hot_incident")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > hot_rows).select("hot_incident", F.ceil(F.col("n") / hot_rows).cast("int").alias("salts"))


def salted(staged: DataFrame, hot: DataFrame) -> DataFrame:
    """The staged fact with its salt (0 but for hot incidents)."""
    same = [c for c in staged.columns if c not in _GROUP_ONLY]
    salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*same), F.col("salts"))).cast("int")
    joined = staged.join(checked_broadcast(hot), staged[_INCIDENT] == F.col("hot_incident"), "left")
    return joined.select(*staged.columns, salt.alias(SALT))


def per_salt(incident_groups: DataFrame, hot: DataFrame) -> DataFrame:
    """(incident_id, category_group_id, salt): each incident's group once for each of its salts."""
    joined = incident_groups.join(checked_broadcast(hot), F.col("incident_id") == F.col("hot_incident"), "left")
    salts: Column = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
    return joined.select("incident_id", "category_group_id", F.explode(salts).alias(SALT))


class Buckets:
    """Bucketed catalog tables of one load over folders of the warehouse; dropped when the load ends (files stay)."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, []
        self.count = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, df: DataFrame, path: str, incident: str) -> DataFrame:
        """``df`` in ``path``, one file a bucket; the one shuffle is the last before the fact."""
        name = f"starloom_buckets_{uuid.uuid4().hex[:12]}"
        (df.repartition(self.count, incident, SALT).write.bucketBy(self.count, incident, SALT).sortBy(incident, SALT)
         .format("parquet").option("path", path).saveAsTable(name))
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []


@contextmanager
def buckets(spark: SparkSession):
    made = Buckets(spark)
    try:
        yield made
    finally:
        made.drop()
