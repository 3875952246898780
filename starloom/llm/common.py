"""Helpers shared by the training-data operators: tables in the shared folder, worker imports, and
vectorised word scanning over Arrow string buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D.  UTF-8 never uses those bytes inside a
longer character, so scanning bytes equals scanning characters.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one vectorised pass handles at once (a longer text is handled alone, whole).
CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch: texts are long, and a task holds two batches on either side.
BATCH_ROWS = 2000
#: Byte ranges from this length on are hashed by XXH3.
LONG = 128
#: A side is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 32 << 20


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a cluster that installs
    or ships the package needs nothing; the path is then simply one more entry), and hand them texts in
    small Arrow batches unless the session asks for smaller ones."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, path) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared scratch folder and read it back: lineage is
    cut, and a lost executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a stored table) with a broadcast hint if its measured size allows it; otherwise
    unchanged, and the planner joins by shuffle."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(16) for c, t in df.dtypes),
               F.lit(16)).cast("long")
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= max_bytes else df


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with a key ``row`` of its own for each row, whatever ids and texts repeat; in small row
    groups, as a writer holds one in memory."""
    return stored(df.select(F.monotonically_increasing_id().alias("row"), "*"), name, **{"parquet.block.size": 16 << 20})


def free_name(df: DataFrame, name: str) -> str:
    """``name``, underscored until no column of ``df`` has it (case ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc_bucket(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


# -- Arrow strings as byte buffers --------------------------------------------------------------------

def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n+1 offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]:o[-1]], o - o[0]


def slices(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and for each text its first word's index (n+1 bounds)."""
    is_word = ~_SPACE[data]
    start, end = is_word.copy(), is_word.copy()
    if len(data):
        start[1:] &= ~is_word[:-1]
        end[:-1] &= ~is_word[1:]
        full = offsets[:-1] < offsets[1:]
        first, last = offsets[:-1][full], offsets[1:][full] - 1
        start[first], end[last] = is_word[first], is_word[last]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offsets)


def per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` within each of the consecutive ranges that ``bounds`` marks."""
    c = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return c[bounds[1:]] - c[bounds[:-1]]


# -- Hashing ------------------------------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (fixed constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = []      # of this worker, for up to CHUNK_BYTES + 1 positions


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base modulo 2**64 and of its inverse, for at least ``n`` positions."""
    if _POWERS and n <= len(_POWERS[0]):
        return _POWERS[0], _POWERS[1]
    made = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(max(n, CHUNK_BYTES + 2), b, np.uint64)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if n <= CHUNK_BYTES + 2:
        _POWERS[:] = made
    return made[0], made[1]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ranges [start, end) of a uint64 sequence: a polynomial modulo 2**64 read
    off prefix sums, so a hash depends on the range's content and not on its place."""
    up, down = _powers(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def byte_values(data: np.ndarray, lower: bool = False) -> np.ndarray:
    return _BYTE[LOWER[data] if lower else data]


def text_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte ranges.  Ranges of ``LONG`` bytes and more take XXH3: a polynomial modulo 2**64
    is the same for strings that are easily made from some hundred bytes on (Thue-Morse), whatever its base."""
    h = range_hash(byte_values(data, lower), starts, ends)
    for i in np.flatnonzero(ends - starts >= LONG):
        part = data[starts[i]:ends[i]]
        h[i] = xxhash.xxh3_64_intdigest((LOWER[part] if lower else part).tobytes())
    return h


def gram_starts(bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``k`` consecutive words inside one text, and each one's text."""
    n = np.maximum(np.diff(bounds) - k + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    return np.arange(n.sum()) - first[doc] + bounds[:-1][doc], doc


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Mask over ``n`` words: inside one of the windows [start, start + k)."""
    if not len(starts):
        return np.zeros(n, bool)
    opens = np.bincount(starts, minlength=n + 1)
    closes = np.bincount(starts + k, minlength=n + 1)
    return np.cumsum(opens - closes)[:n] > 0
