"""Files that hold one JSON array of records, read by many tasks, damaged parts included.

A text scan cuts the files at every ``}``, wherever byte splits fall, so a large file is read by as many tasks
as it has splits.  A piece between two cuts says how many unescaped quotes it holds and how many braces it opens
outside strings, for either state it may begin in.  One row per split settles the state at the beginning of
every split (inside a string or not, how deep in braces); within a split the states follow from running sums.
Where the depth returns to zero a record ends: braces in strings and nested objects only join pieces.  A
record that crosses splits is joined from its two ends.  Each record's text is then parsed by ``from_json``.

What is not a record is kept apart with its file: records that do not parse, what follows the last whole record of
a truncated file, text between records, and an array that is never closed (an empty text).  After damage that
leaves a string or brace open the rest of the file is no record; records before it are kept.  A stretch
without a record's end is kept in pieces of at most ``MAX_RECORD`` bytes, so a record above that is not read as one.

A value that is an object or array itself becomes its JSON text without spaces between tokens.
Files of one object or of objects without an array are read alike.  The text is scanned twice: for the states of
the splits (only numbers are shuffled, by split), then for the records, which are shuffled by split and
stored in the shared scratch folder, where both whole and cut ones are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.keys import checked_broadcast
from starloom.session import scratch_path

#: Bytes of a record.
MAX_RECORD = 8 << 20
#: Columns that tell damaged input: its text (NULL for a record that was read), and the file.
CORRUPT, SOURCE = "_corrupt_record", "_source_file"

_SPLIT = ["file", "block"]


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def raw_schema(columns: list[str], corrupt: bool = True) -> T.StructType:
    """Every column a string, and where wanted the text of a record that could not be read."""
    names = columns + ([CORRUPT] if corrupt else [])
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def _braces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))


def _pieces(spark: SparkSession, path) -> DataFrame:
    """The text between two ``}``, in file order within each split: quotes, and braces opened outside strings if
    the piece begins outside (``o0``) or inside (``o1``) one."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("pos"), "value")
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    raw = raw.withColumn("parts", parts)

    def outside(odd: int) -> Column:
        return _braces(F.array_join(F.filter("parts", lambda x, i: i % 2 == odd), ""))
    return raw.select("file", "block", "size", "pos", "value", (F.octet_length("value") + 1).alias("bytes"),
                      F.col("value").rlike(r"^\uFEFF?\s*\[").alias("bracket"), (F.size("parts") - 1).alias("quotes"),
                      outside(0).alias("o0"), outside(1).alias("o1"))


def _marked(spark: SparkSession, path) -> DataFrame:
    """Pieces with what they add to the depth in a split that begins outside (``net0``) or inside (``net1``) a string:
    braces they open, less the one that ends them."""
    before = Window.partitionBy(*_SPLIT).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    marked = _pieces(spark, path).withColumn("c", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)

    def net(inside) -> Column:
        opened = F.when((F.col("c") + inside) % 2 == 0, F.col("o0")).otherwise(F.col("o1"))
        return opened - F.when((F.col("c") + F.col("quotes") + inside) % 2 == 0, 1).otherwise(0)
    return marked.withColumns({"net0": net(0), "net1": net(1)})


def _splits(marked: DataFrame) -> DataFrame:
    """One row per split: string state and depth at its beginning, whether it ends the file, and how."""
    per = marked.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("q"), F.sum("net0").alias("d0"), F.sum("net1").alias("d1"), F.max("pos").alias("last_pos"),
        F.sum("bytes").alias("bytes"), F.max("size").alias("size"), F.min_by("bracket", "pos").alias("array"))
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("inside", F.coalesce(F.sum("q").over(before), F.lit(0)) % 2)
    net = F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1"))
    return per.select(*_SPLIT, "last_pos", "inside", F.coalesce(F.sum(net).over(before), F.lit(0)).alias("depth"),
                      (F.col("block") == F.max("block").over(file)).alias("ends"),
                      (F.sum("bytes").over(file) == F.col("size")).alias("closed"),       # the file's last byte is a brace
                      F.first("array").over(file.orderBy("block")).alias("array"))


def _groups(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Pieces joined into records within their split; and the splits."""
    order = Window.partitionBy(*_SPLIT).orderBy("pos")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    splits = _stored(_splits(_marked(spark, path)), "json-splits")
    marked = _marked(spark, path)
    at = marked.join(checked_broadcast(splits), _SPLIT)
    at = at.withColumn("net", F.when(F.col("inside") == 0, F.col("net0")).otherwise(F.col("net1")))
    at = at.withColumns({"deep": F.col("depth") + F.coalesce(F.sum("net").over(before), F.lit(0)),
                         "tail": F.col("ends") & ~F.col("closed") & (F.col("pos") == F.col("last_pos")),
                         "seen": F.coalesce(F.sum("bytes").over(before), F.lit(0))})
    opens = F.col("deep") == 0
    at = at.withColumns({"record": F.last(F.when(opens, F.col("pos")), True).over(upto),
                         "chunk": F.floor((F.col("seen") - F.coalesce(F.last(F.when(opens, F.col("seen")), True).over(upto), F.lit(0)))
                                          / MAX_RECORD)})
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]), "}")
    done = (F.col("deep") + F.col("net") == 0) & ~F.col("tail")
    groups = at.groupBy(*_SPLIT, "record", "chunk").agg(
        F.concat(joined, F.when(F.bool_or("tail"), "").otherwise("}")).alias("text"), F.bool_or(done).alias("done"),
        F.bool_or("tail").alias("tail"), F.min("pos").alias("first_pos"), F.first("array").alias("array"))
    return _stored(groups, "json-records"), splits


def record_texts(spark: SparkSession, path) -> DataFrame:
    """(file, text, whole): the text of every record, and what is not one."""
    groups, splits = _groups(spark, path)
    complete = F.col("record").isNotNull() & (F.col("chunk") == 0) & F.col("done")
    # At most two cut stretches a split where the input is sound.
    cut = groups.filter(~complete)
    place = Window.partitionBy("file").orderBy("block", "first_pos")
    cut = cut.withColumn("owner", F.count("record").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    total = F.sum(F.octet_length("text")).over(Window.partitionBy("file", "owner"))
    cut = cut.withColumn("apart", F.when((total > MAX_RECORD) | (F.col("owner") == 0), F.struct("block", "first_pos")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "first_pos", "text"))), lambda x: x["text"]), "")
    cut = cut.groupBy("file", "owner", "apart").agg(
        joined.alias("text"), (F.bool_or("done") & F.first("apart").isNull()).alias("done"), F.bool_or("tail").alias("tail"),
        F.first("array").alias("array"))
    # The end of a file: the bracket that closes its array, or nothing where none was opened.
    end = F.col("tail") & F.col("text").rlike(r"^\s*(\[\s*)?\]\s*$") | F.col("tail") & ~F.col("array") & F.col("text").rlike(r"^﻿?\s*$")
    rest = cut.filter(~end).select("file", "text", F.col("done").alias("whole"))
    # Cut off right after a record: nothing but the closing bracket is missing.
    unclosed = splits.filter(F.col("ends") & F.col("closed") & F.col("array")).select("file", F.lit("").alias("text"), F.lit(False).alias("whole"))
    return groups.filter(complete).select("file", "text", F.lit(True).alias("whole")).unionByName(rest).unionByName(unclosed)


def read_json_arrays(spark: SparkSession, path, columns: list[str]) -> DataFrame:
    """The columns of all records as strings, ``CORRUPT`` and ``SOURCE``; a row with a text in ``CORRUPT`` is no record."""
    texts = record_texts(spark, path)
    text = F.regexp_replace("text", r"^﻿?\s*[\[,]?\s*(?=\{)", "")
    parsed = F.from_json(text, raw_schema(columns), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = texts.select("file", "text", F.when(F.col("whole") & text.startswith("{"), parsed).alias("row"))
    lost = F.when(F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull(), F.col("text"))
    return rows.select(*[F.when(lost.isNull(), F.col(f"row.`{c}`")).alias(c) for c in columns], lost.alias(CORRUPT), F.col("file").alias(SOURCE))


def parse_lines(lines: DataFrame, columns: list[str]) -> DataFrame:
    """JSON lines (``value``, ``SOURCE``) as ``read_json_arrays`` returns records; a line may hold an array, blank ones are none."""
    texts = lines.filter(F.trim(F.col("value")) != "").select("value", SOURCE, F.from_json(
        "value", T.ArrayType(raw_schema(columns, corrupt=False)), {"mode": "PERMISSIVE"}).alias("rows"))
    rows = texts.select("value", SOURCE, F.explode_outer("rows").alias("row"))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns], F.when(F.col("row").isNull(), F.col("value")).alias(CORRUPT), SOURCE)
