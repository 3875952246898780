"""Operator 3, exact deduplication: an extendible-hash index on shared files.

The key of a text is its 64-bit hash.  A directory of hash prefixes starts with one bucket; as long as
a bucket is overfull (its distinct texts hold more than ``bucket_chars`` characters) the directory
doubles: the bucket splits on one more bit of the key.  A bucket that copies of few keys overfill
cannot be split by key; beyond ``PAGE_BUCKETS`` times a bucket's characters it gets overflow pages, dealt by
a hash of the id, so a text that holds a third of all rows is spread as well.  Owner tasks take whole (bucket, page) ranges: each chains the entries of
a key and compares their bytes.  The index entries are written to the shared folder; entries of buckets
with several pages are then joined across pages, again by bytes, from one representative per page.

Defined results: a null text counts as empty; rows with the same id and text are copies of each other,
of which one stays; a null id stays only if its whole group has null ids; an empty table gives none.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, on_workers, small, stored

BUCKET_CHARS = 16 << 20     # characters of the different texts in a bucket
PAGE_BUCKETS = 4            # a page holds the characters of so many buckets, copies included
MAX_DEPTH = 18              # the directory has at most 2**18 entries
_DECISIONS = ("xd_key", "xd_bucket", "xd_page", "xd_pages", "xd_depth", "xd_rep", "xd_rep_id", "xd_rep_row",
              "xd_size", "xd_first")


def directory(keyed: DataFrame, bucket_chars: int, max_depth: int) -> DataFrame:
    """(xd_prefix at ``max_depth`` bits, bucket, depth, pages) by directory doubling.

    One pass counts each key (map-side combined), one folds keys into the ``max_depth``-bit prefixes;
    the doubling itself works on that table, of at most 2**max_depth rows.
    """
    keys = keyed.groupBy("xd_key").agg(F.max("xd_chars").alias("c"), F.sum("xd_chars").alias("all"))
    prefix = F.shiftrightunsigned("xd_key", 64 - max_depth)
    cells = stored(keys.groupBy(prefix.alias("xd_prefix"))
                   .agg(F.sum("c").alias("c"), F.sum("all").alias("all"), F.count(F.lit(1)).alias("n")),
                   "exact-cells")
    open_, closed, depth = cells, None, 0
    while True:
        bucket = F.shiftright("xd_prefix", max_depth - depth)
        sums = open_.groupBy(bucket.alias("xd_bucket")).agg(
            F.sum("c").alias("bc"), F.sum("all").alias("ba"), F.sum("n").alias("bn"))
        marked = open_.withColumn("xd_bucket", bucket).join(F.broadcast(sums), "xd_bucket")   # at most 2**max_depth rows
        full = (F.col("bc") > bucket_chars) & (F.col("bn") > 1) if depth < max_depth else F.lit(False)
        marked = stored(marked.withColumn("full", full), f"exact-directory-{depth}")
        done = marked.filter(~F.col("full")).select(
            "xd_prefix", "xd_bucket", F.lit(depth).alias("xd_depth"),
            F.greatest(F.lit(1), F.ceil(F.col("ba") / (PAGE_BUCKETS * bucket_chars))).cast("long").alias("xd_pages"))
        closed = done if closed is None else closed.unionByName(done)
        open_ = marked.filter("full").select("xd_prefix", "c", "all", "n")
        if open_.isEmpty():
            return stored(closed, "exact-directory")
        depth += 1


def _own(schema: T.StructType, id_col: str, text_col: str):
    """The owner task of one (bucket, page): chain by key, compare bytes, mark each chain entry."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def own(t: pa.Table) -> pa.Table:
        chains: dict[int, list[list]] = defaultdict(list)       # key -> [text, rows]
        keys, ids = t.column("xd_key").to_pylist(), t.column(id_col).to_pylist()
        for row, (key, text) in enumerate(zip(keys, t.column(text_col))):
            text = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
            for entry in chains[key]:
                if entry[0].equals(text):
                    entry[1].append(row)
                    break
            else:
                chains[key].append([text, [row]])
        n = t.num_rows
        rep, rep_id, size, first = [0] * n, [None] * n, [0] * n, [False] * n
        for chain in chains.values():
            for _, rows in chain:
                best = max(rows, key=lambda r: (ids[r] is not None, ids[r] if ids[r] is not None else 0))
                first[best] = True
                for r in rows:
                    rep[r], rep_id[r], size[r] = best, ids[best], len(rows)
        cols = {"xd_rep": pa.array([f"{t.column('xd_bucket')[0]}.{t.column('xd_depth')[0]}.{t.column('xd_page')[0]}.{r}"
                                    for r in rep], pa.string()),
                "xd_rep_id": pa.array(rep_id, t.schema.field(id_col).type), "xd_size": pa.array(size, pa.int64()),
                "xd_first": pa.array(first, pa.bool_())}
        return pa.table([cols[f.name] if f.name in cols else t.column(f.name) for f in arrow], schema=arrow)

    return own


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep_text: bool = True,
                bucket_chars: int = BUCKET_CHARS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """All rows and columns of ``df`` with keep_id, group_size, kept and text_sha256 (named with
    leading underscores where ``df`` has such a column; ``keep_text=False`` leaves the text out).

    Of equal texts the row with the largest id stays.
    """
    spark = df.sparkSession
    on_workers(spark)
    original = df.columns
    back = {f"c{i}": c for i, c in enumerate(original)}           # inside, names cannot clash
    cid, ctext = (next(k for k, v in back.items() if v.lower() == c.lower()) for c in (id_col, text_col))
    inner = df.toDF(*back)
    text = F.coalesce(F.col(ctext), F.lit(""))
    keyed = inner.withColumns({"xd_key": F.xxhash64(text), "xd_chars": F.length(text).cast("long") + 1})
    entries = directory(keyed.select("xd_key", "xd_chars"), bucket_chars, max_depth)
    dealt = (keyed.withColumn("xd_prefix", F.shiftrightunsigned("xd_key", 64 - max_depth)).drop("xd_chars")
             .join(F.broadcast(entries), "xd_prefix").drop("xd_prefix")               # at most 2**max_depth rows
             .withColumns({"xd_page": F.pmod(F.xxhash64(F.lit(3), cid), F.col("xd_pages")),
                           "xd_sha": F.sha2(F.coalesce(F.col(ctext), F.lit("")), 256)}))
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in dealt.schema.fields])
    schema = T.StructType(plain.fields + [T.StructField("xd_rep", T.StringType()),
                                          T.StructField("xd_rep_id", inner.schema[cid].dataType),
                                          T.StructField("xd_size", T.LongType()), T.StructField("xd_first", T.BooleanType())])
    owned = dealt.groupBy("xd_bucket", "xd_depth", "xd_page").applyInArrow(_own(schema, cid, ctext), schema)
    if not keep_text:      # pages still need a text to compare: that of each page's representative
        owned = owned.withColumn(ctext, F.when(F.col("xd_first") & (F.col("xd_pages") > 1), F.col(ctext)))
    index = stored(owned, "exact-index")
    # Chains of buckets with overflow pages: one representative per page and text, compared by bytes in
    # a map-side combined aggregate; only these few rows move.
    heads = index.filter((F.col("xd_pages") > 1) & F.col("xd_first")).select(
        "xd_key", F.coalesce(ctext, F.lit("")).alias("t"), "xd_rep", "xd_rep_id", "xd_size")
    whole = heads.groupBy("xd_key", "t").agg(F.max(F.struct("xd_rep_id", "xd_rep")).alias("best"),
                                             F.sum("xd_size").alias("total"))
    joined = heads.select("xd_key", "t", "xd_rep").join(whole, ["xd_key", "t"]).select(
        "xd_rep", F.col("best.xd_rep_id").alias("m_id"), F.col("best.xd_rep").alias("m_rep"), "total")
    out = index.join(stored(joined, "exact-chains"), "xd_rep", "left")
    merged = F.col("m_rep").isNotNull()
    made = {"keep_id": F.when(merged, F.col("m_id")).otherwise(F.col("xd_rep_id")),
            "group_size": F.coalesce("total", "xd_size"),
            "kept": F.col("xd_first") & (~merged | (F.col("m_rep") == F.col("xd_rep"))),
            "text_sha256": F.col("xd_sha")}
    cols = [F.col(k).alias(v) for k, v in back.items() if keep_text or k != ctext]
    return out.select(*cols, *[e.alias(free_name(df, n)) for n, e in made.items()])
