"""Warehouse tables: schema reset (T1, T2, T3) and loads.

A warehouse table is an ordinary Parquet dataset partitioned by ``load_id`` and
``attempt``: every write adds one partition and touches no other.  Which
attempts count is data, too: ``_commits`` is a Parquet table with a partition for
each commit, whose rows are the attempts that make up every table after it.
A read joins the table with the rows of the last commit (broadcast; Spark prunes
the partitions at run time), so a failed attempt, which no commit names, is
never seen.  A commit is one small file that Spark derives from the last one:
appended attempts are added, a truncate load takes the place of a table's rows,
a load written again that of its earlier attempt.

A full load replaces every table, so it forgets all earlier load ids: a batch
that is sent again is a no-op, a batch after a reload of the warehouse is loaded.
"""

from __future__ import annotations

import re
import threading
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.keys import checked_broadcast, row_bytes
from starloom.session import scratch_path

COMMITS = T.StructType([
    T.StructField("zone", T.StringType()), T.StructField("table", T.StringType()), T.StructField("load_id", T.StringType()),
    T.StructField("attempt", T.StringType()), T.StructField("n_rows", T.LongType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("made_by", T.StringType()), T.StructField("commit", T.IntegerType())])
#: The partition columns of every warehouse table.
PARTITION = ["load_id", "attempt"]


@dataclass(frozen=True)
class Attempt:
    """One write of a load: the partition it made."""
    zone: str
    table: str
    load_id: str
    attempt: str
    n_rows: int
    n_bytes: int


def reset_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Drop a catalog schema with all its tables and recreate it
    (optionally at ``location`` on shared storage).

    Destructive; only on explicit call.
    """
    spark.sql(f"DROP SCHEMA IF EXISTS `{name}` CASCADE")
    spark.sql(f"CREATE SCHEMA `{name}`" + (f" LOCATION '{location}'" if location else ""))


def create_tables(spark: SparkSession, database: str, schemas: dict[str, T.StructType],
                  location: str | None = None) -> None:
    """Typed, empty Parquet catalog tables (external under
    ``location/<table>`` when given)."""
    for name, schema in schemas.items():
        kw = {"path": f"{location.rstrip('/')}/{name}"} if location else {}
        spark.catalog.createTable(f"{database}.{name}", schema=schema, source="parquet", **kw)


def conform(df: DataFrame, schema: T.StructType, col_list: list[str] | None = None,
            defaults: dict[str, str] | None = None) -> DataFrame:
    """Select ``col_list`` by name, cast to the declared types, fill
    the other declared columns with their default (or NULL)."""
    cols = col_list if col_list is not None else [f.name for f in schema.fields]
    defaults = defaults or {}
    out = []
    for f in schema.fields:
        if f.name in cols:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            out.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def _folder(spark: SparkSession, path: str):
    """The file system and path of an existing folder, else None."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return (fs, folder) if fs.exists(folder) else None


def _in_path(value: str) -> str:
    """A partition value as Spark spells it in a path."""
    return re.sub(r"[^A-Za-z0-9_.\-\u0080-\uffff]", lambda m: f"%{ord(m[0]):02X}", value)


class Commits:
    """The attempts that count, after the last commit of a root (or after commit ``number``), and what the
    running load has written since.  One writer per root at a time."""

    def __init__(self, spark: SparkSession, root: str, fresh: bool = False, number: int | None = None):
        """``fresh=True``: the root is known to be new, nothing to read."""
        self.spark, self.path = spark, f"{root.rstrip('/')}/_commits"
        self.number = number if number is not None else 0 if fresh else self._last()
        self.appended: list[Attempt] = []
        #: Tables whose rows this load replaced: attempts it wrote, or a stored table of attempts.
        self.replaced: dict[tuple[str, str], list[Attempt] | DataFrame] = {}
        self._sizes: dict | None = None
        self.lock = threading.Lock()                # tables are written by several threads of the driver

    def table(self) -> DataFrame:
        return self.spark.read.schema(COMMITS).parquet(self.path)

    def _last(self, made_by: str | None = None) -> int:
        if not _folder(self.spark, self.path):      # only a missing table means an empty warehouse
            return 0
        rows = self.table() if made_by is None else self.table().filter(F.col("made_by") == made_by)
        return rows.agg(F.max("commit")).first()[0] or 0

    def upto(self, load_id: str) -> "Commits":
        """The state right after the last commit of ``load_id``."""
        return Commits(self.spark, self.path.rsplit("/", 1)[0], number=self._last(load_id))

    def state(self) -> DataFrame:
        """The rows of the commit."""
        if not self.number:
            return self.spark.createDataFrame([], COMMITS)
        return self.table().filter(F.col("commit") == self.number)

    def committed(self, zone: str, table: str) -> DataFrame:
        return self.state().filter((F.col("zone") == zone) & (F.col("table") == table))

    def has_load(self, zone: str, table: str, load_id: str) -> bool:
        return not self.committed(zone, table).filter(F.col("load_id") == load_id).isEmpty()

    def sizes(self) -> dict[tuple[str, str], tuple[int, int]]:
        """Rows and bytes of every table of the commit (one small job for all)."""
        if self._sizes is None:
            per = self.state().groupBy("zone", "table").agg(F.sum("n_rows").alias("r"), F.sum("n_bytes").alias("b"))
            self._sizes = {(x["zone"], x["table"]): (x["r"], x["b"]) for x in per.collect()}       # a row per table
        return self._sizes

    def commit(self) -> None:
        rows = list({(a.zone, a.table, a.load_id): a for a in self.appended}.values())
        for kept in self.replaced.values():
            rows += kept if isinstance(kept, list) else []
        if not rows:
            return
        made_by = rows[-1].load_id
        gone = F.lit(False)
        for zone, table in self.replaced:
            gone = gone | ((F.col("zone") == zone) & (F.col("table") == table))
        for a in self.appended:
            gone = gone | ((F.col("zone") == a.zone) & (F.col("table") == a.table) & (F.col("load_id") == a.load_id))
        names = COMMITS.fieldNames()[:6]
        new = self.spark.createDataFrame([(a.zone, a.table, a.load_id, a.attempt, a.n_rows, a.n_bytes) for a in rows], T.StructType(COMMITS.fields[:6]))
        state = self.state().filter(~gone).select(*names).unionByName(new)
        for kept in self.replaced.values():
            if isinstance(kept, DataFrame):
                state = state.unionByName(kept.select(*names))
        (state.select(*names, F.lit(made_by).alias("made_by")).coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.path}/commit={self.number + 1}"))
        self.number, self.appended, self._sizes = self.number + 1, [], None
        self.replaced = {}


class Warehouse:
    """The tables of one zone."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType],
                 commits: Commits | None = None, zone: str = "default", fresh: bool = False,
                 inner: dict[str, str] | None = None):
        """``inner``: tables whose attempts are partitioned further by an integer column that is not part of their schema."""
        self.inner = inner or {}
        self.spark, self.root, self.schemas, self.zone = spark, root.rstrip("/"), schemas, zone
        self.commits = commits or Commits(spark, root, fresh)

    # -- state ---------------------------------------------------------------
    def _written(self, table: str) -> list[Attempt]:
        """What the running load appended to the table; a load written again counts once, as last written."""
        return list({a.load_id: a for a in self.commits.appended if (a.zone, a.table) == (self.zone, table)}.values())

    def live(self, table: str) -> DataFrame:
        """The attempts that make up the table before what the running load appended to it."""
        kept = self.commits.replaced.get((self.zone, table))
        return kept if isinstance(kept, DataFrame) else self.commits.committed(self.zone, table)

    def load_ids(self, table: str) -> list[str]:
        """The loads whose rows are committed to the table, in order of their names."""
        return sorted(r["load_id"] for r in self.live(table).select("load_id").collect())

    def has_load(self, table: str, load_id: str) -> bool:
        """``load_id`` was committed to the table since the last full load."""
        return self.commits.has_load(self.zone, table, load_id)

    def _size(self, table: str) -> tuple[int, int]:
        kept = self.commits.replaced.get((self.zone, table))
        if kept is None:
            base = self.commits.sizes().get((self.zone, table), (0, 0))
        elif isinstance(kept, list):
            base = (sum(a.n_rows for a in kept), sum(a.n_bytes for a in kept))
        else:
            base = tuple(kept.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first())
        new = self._written(table)
        return base[0] + sum(a.n_rows for a in new), base[1] + sum(a.n_bytes for a in new)

    def row_count(self, table: str) -> int:
        """Rows of the table, from counts observed at write time."""
        return self._size(table)[0]

    def byte_size(self, table: str) -> int:
        return self._size(table)[1]

    def sizes(self) -> dict[str, int]:
        """Bytes per table (uncompressed, as measured by the writes): what broadcast checks go by."""
        return {t: self.byte_size(t) for t in self.schemas}

    # -- reads -----------------------------------------------------------------
    def _stored_schema(self, table: str) -> T.StructType:
        inner = [T.StructField(self.inner[table], T.IntegerType())] if table in self.inner else []
        return T.StructType(self.schemas[table].fields + [T.StructField(c, T.StringType()) for c in PARTITION] + inner)

    def _path(self, a: Attempt) -> str:
        return f"{self.root}/{a.table}/load_id={_in_path(a.load_id)}/attempt={a.attempt}"

    def _attempts(self, table: str, attempts: list[Attempt], extra: list[str]) -> DataFrame:
        """The rows of attempts that this load wrote itself."""
        schema = self._stored_schema(table)
        if not attempts:
            return self.spark.createDataFrame([], schema).select(*self.schemas[table].fieldNames(), *extra)
        read = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return read.parquet(*[self._path(a) for a in attempts]).select(*self.schemas[table].fieldNames(), *extra)

    def _rows(self, table: str, load_id: str | None = None, extra: list[str] = []) -> DataFrame:
        columns = self.schemas[table].fieldNames() + extra
        kept = self.commits.replaced.get((self.zone, table))
        new = self._written(table) + (kept if isinstance(kept, list) else [])
        new = [a for a in new if load_id in (None, a.load_id)]
        if isinstance(kept, list) or not _folder(self.spark, f"{self.root}/{table}"):
            return self._attempts(table, new, extra)
        live = self.live(table).select(*PARTITION)
        if self._written(table):
            live = live.filter(~F.col("load_id").isin([a.load_id for a in self._written(table)]))
        if load_id is not None:
            live = live.filter(F.col("load_id") == load_id)
        schema = self._stored_schema(table)
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        if load_id is not None:
            rows = rows.filter(F.col("load_id") == load_id)
        # One row for each load: bounded by the number of loads, and small beside any of them.
        rows = rows.join(F.broadcast(live), PARTITION, "left_semi").select(*columns)
        return rows.unionByName(self._attempts(table, new, extra)) if new else rows

    def read(self, table: str) -> DataFrame:
        return self._rows(table)

    def read_inner(self, table: str) -> DataFrame:
        """The table with its inner partition column."""
        return self._rows(table, extra=[self.inner[table]])

    def read_load(self, table: str, load_id: str) -> DataFrame:
        """Only the rows one load added to the table."""
        return self._rows(table, load_id)

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.read(t) for t in self.schemas}

    # -- writes ----------------------------------------------------------------
    def _write(self, table: str, df: DataFrame, load_id: str, write=None) -> Attempt:
        """One new partition; ``write(rows, path)`` may lay it out in its own way (with more columns)."""
        obs, attempt = Observation(), uuid.uuid4().hex[:12]
        out = conform(df, self.schemas[table]) if write is None or table in self.inner else df
        made = Attempt(self.zone, table, load_id, attempt, 0, 0)
        out = out.observe(obs, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(out)), F.lit(0)).alias("b"))
        if write is None:
            out.write.mode("errorifexists").parquet(self._path(made))
        else:
            write(out, self._path(made))
        return Attempt(self.zone, table, load_id, attempt, int(obs.get["n"]), int(obs.get["b"]))

    def append(self, table: str, df: DataFrame, load_id: str, write=None) -> None:
        """Add a load's rows (rerunning the same ``load_id`` replaces them)."""
        made, kept = self._write(table, df, load_id, write), self.commits.replaced.get((self.zone, table))
        if isinstance(kept, list):
            self.commits.replaced[self.zone, table] = [a for a in kept if a.load_id != load_id] + [made]
        else:
            with self.commits.lock:
                self.commits.appended.append(made)

    def replace(self, table: str, df: DataFrame, load_id: str, write=None) -> None:
        """Truncate the table and load."""
        made = self._write(table, df, load_id, write)
        self._forget(table)
        self.commits.replaced[self.zone, table] = [made]

    def _forget(self, table: str) -> None:
        with self.commits.lock:
            self.commits.appended = [a for a in self.commits.appended if (a.zone, a.table) != (self.zone, table)]

    def replace_keys(self, table: str, df: DataFrame, key: str, load_id: str) -> None:
        """The rows of ``df`` take the place of all earlier rows with their keys.

        Loads that hold one of the keys get a new attempt without them (one
        write for all), the others stay as they are.
        """
        before, old = self.live(table).select("zone", "table", *PARTITION, "n_rows", "n_bytes"), self._rows(table, extra=["load_id"])
        made = self._write(table, df, load_id)
        keys = self._attempts(table, [made], []).select(key).distinct()
        touched = _stored(old.join(keys, key, "left_semi").select("load_id").distinct(), "touched-loads")
        again, attempt = checked_broadcast(touched), uuid.uuid4().hex[:12]
        rest = old.join(again, "load_id", "left_semi").join(keys, key, "left_anti").withColumn("attempt", F.lit(attempt))
        rest.write.mode("append").partitionBy(*PARTITION).parquet(f"{self.root}/{table}")
        written = self.spark.read.schema(T.StructType(self.schemas[table].fields + [T.StructField(c, T.StringType()) for c in PARTITION])
                                         ).parquet(f"{self.root}/{table}").filter(F.col("attempt") == attempt)
        counts = written.groupBy("load_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(written.drop(*PARTITION))).alias("bytes"))
        counts = touched.join(counts, "load_id", "left").select("load_id", F.lit(True).alias("again"), F.coalesce("rows", F.lit(0)).alias("rows"),
                                                                F.coalesce("bytes", F.lit(0)).alias("bytes"))
        hit = F.col("again").isNotNull()
        state = before.filter(F.col("load_id") != load_id).join(counts, "load_id", "left").select(
            "zone", "table", "load_id", F.when(hit, F.lit(attempt)).otherwise(F.col("attempt")).alias("attempt"),
            F.when(hit, F.col("rows")).otherwise(F.col("n_rows")).alias("n_rows"),
            F.when(hit, F.col("bytes")).otherwise(F.col("n_bytes")).alias("n_bytes"))
        self._forget(table)
        self.commits.replaced[self.zone, table] = _stored(state, "touched-state")
        self.commits.appended.append(made)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def retain(warehouses: list[Warehouse], keep_commits: int) -> list[str]:
    """Delete the partitions that none of the last ``keep_commits`` commits
    names: replaced rows and what failed loads left behind; and older commits.

    Destructive and only on explicit call, while no load is running; history
    views of dropped commits stop working.  Returns the deleted partitions.
    """
    deleted: list[str] = []
    commits = warehouses[0].commits
    spark, oldest = commits.spark, commits.number - keep_commits + 1
    kept = commits.table().filter(F.col("commit").between(oldest, commits.number))
    for wh in warehouses:
        found = []
        for table in wh.schemas:
            folder = _folder(spark, f"{wh.root}/{table}")
            for load in folder[0].listStatus(folder[1]) if folder else []:
                if load.getPath().getName().startswith("load_id="):
                    found += [(wh.zone, table, a.getPath().getName().split("=", 1)[-1], a.getPath().toString())
                              for a in folder[0].listStatus(load.getPath())]
        if not found:
            continue
        listed = spark.createDataFrame(found, "zone string, table string, attempt string, path string")
        for r in listed.join(kept.select("zone", "table", "attempt"), ["zone", "table", "attempt"], "left_anti").collect():
            fs, path = _folder(spark, r["path"])
            fs.delete(path, True)
            deleted.append(r["path"])
    for number in range(max(oldest - 1, 0), 0, -1):
        old = _folder(spark, f"{commits.path}/commit={number}")
        if not old:
            break
        old[0].delete(old[1], True)
    return deleted


def load_table(wh: Warehouse, table: str, df: DataFrame, load_type: str = "append",
               load_id: str = "0", col_list: list[str] | None = None,
               defaults: dict[str, str] | None = None) -> None:
    """``truncate`` or ``append`` a frame into a warehouse table,
    optionally loading only ``col_list`` (other columns take defaults)."""
    if col_list is not None:
        df = conform(df, wh.schemas[table], col_list, defaults)
    if load_type == "truncate":
        wh.replace(table, df, load_id)
    elif load_type == "append":
        wh.append(table, df, load_id)
    else:
        raise ValueError(f"unknown load_type {load_type!r}")
