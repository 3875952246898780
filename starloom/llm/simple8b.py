"""Operator 6, token-id output in Simple-8b word-aligned coding.

A 64-bit word holds a 4-bit selector (its top bits) and as many ids as fit the selector's width: sixty of
1 bit down to one of 60 bits.  Selector 15 is an escape: its low bits number a value of more than 60 bits
that is stored whole after the block's coded words.  Blocks hold whole documents, about ``BLOCK_IDS`` ids,
with each document's end in the block, so a block decodes by itself and without a loop over words.

Files: Parquet under the given folder, a row per block (part, block, start of the block within its part,
coded ids, coded words, escapes, the documents' ids and ends, the words as little-endian bytes).  Parts
follow ascending document id, so a part's place in the stream is the sum of the parts before it.

Defined results: a null text counts as empty (its end id only); a null id comes first; rows with the same
id follow each other, ordered by text; an empty table gives no block.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path

from .common import on_workers
from .tokens import VOCABULARY, encoder

BLOCK_IDS = 1 << 16
TEXT_BYTES = 2 << 20
#: Fixed values of the format: ids per word for selectors 1 to 14; a selector's width is 60 // count.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15
_STEP = np.array([1, *COUNTS, 1], np.uint8)
#: Bit lengths of numbers of 16 bits; doublings of the steps while coding.
_SHORT = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)
JUMPS = 4


def _bits(ids: np.ndarray) -> np.ndarray:
    """The bit length of every id."""
    out = _SHORT[np.minimum(ids, np.uint64(0xFFFF)).astype(np.int64)]
    wide = np.flatnonzero(ids > np.uint64(0xFFFF))
    for i in range(1, 4) if len(wide) else ():
        part = ids[wide] >> np.uint64(16 * i)
        higher = part > 0
        out[wide[higher]] = _SHORT[np.minimum(part[higher], np.uint64(0xFFFF)).astype(np.int64)] + 16 * i
    return out


def _followed(step: np.ndarray, n: int) -> np.ndarray:
    """The places 0, step[0], ... below ``n``, each found from the one before it.

    Steps are doubled a few times, so that only every ``2 ** JUMPS``-th place is
    found one after another.
    """
    jump = np.full(n + 1, n, np.int64)
    np.minimum(np.arange(n) + step, n, out=jump[:n])
    jumps = [jump]
    for _ in range(JUMPS):
        jumps.append(jumps[-1][jumps[-1]])
    far, places, i = jumps.pop().item, [], 0
    while i < n:
        places.append(i)
        i = far(i)
    places = np.array(places, np.int64)
    for jump in reversed(jumps):
        both = np.empty(2 * len(places), np.int64)
        both[::2], both[1::2] = places, jump[places]
        places = both
    return places[places < n]


def encode(ids: np.ndarray) -> tuple[np.ndarray, int]:
    """The coded words of ``ids`` followed by the escaped values, and the number of these."""
    n = len(ids)
    ids = np.concatenate((ids.astype(np.uint64), np.zeros(60, np.uint64)))      # zeros fill the last word
    bits = _bits(ids)
    big = np.flatnonzero(bits > 60)
    # The widest id among the next ``count``, from windows of half that length.
    choice, widest = np.full(n, len(COUNTS), np.uint8), {1: bits}
    for count in COUNTS[::-1]:
        if count not in widest:
            half = max(c for c in widest if 2 * c >= count)
            widest[count] = np.maximum(widest[half][:n + 60 - count + 1], widest[half][count - half:][:n + 60 - count + 1])
        selector = COUNTS.index(count) + 1
        np.putmask(choice, widest[count][:n] <= 60 // count, selector)
    escapes = ids[big]
    choice[big] = ESCAPE
    ids[big] = np.arange(len(big))
    starts = _followed(_STEP[choice], n)
    chosen = choice[starts] if n else choice
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen).tolist():
        count = int(_STEP[selector])
        at = np.flatnonzero(chosen == selector)
        first, word = starts[at], words[at]
        for k in range(count):
            word |= ids[first + k] << np.uint64(60 // count * k)
        words[at] = word
    return np.concatenate((words, escapes)), len(escapes)


def decode(words: np.ndarray, n: int, n_escapes: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    coded, escapes = words[:len(words) - n_escapes], words[len(words) - n_escapes:]
    selector = (coded >> np.uint64(60)).astype(np.uint8)
    step = _STEP[selector].astype(np.int64)
    first = np.cumsum(step) - step
    out = np.zeros(int(step.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        count = int(_STEP[s])
        width = np.uint64(60 // count)
        at = np.flatnonzero(selector == s)
        shift = np.arange(count, dtype=np.uint64) * width
        values = (coded[at][:, None] >> shift) & np.uint64((1 << int(width)) - 1)
        out[first[at][:, None] + np.arange(count)] = escapes[values.astype(np.int64)] if s == ESCAPE else values
    return out[:n]


def write_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = 1,
                 vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text (with ``end_id`` after it) in ascending id order to files under ``path``."""
    on_workers(df.sparkSession)
    kind = df.schema[id_col].dataType

    def encode_part(batches):
        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        block, start, held, sizes, docs = 0, 0, [], [], []

        def flush():
            nonlocal block, start, held, sizes, docs
            ids = np.concatenate(held)
            words, n_escapes = encode(ids)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([len(words)], pa.int64()), pa.array([n_escapes], pa.int64()),
                 pa.array([docs], pa.list_(id_type)), pa.array([np.cumsum(sizes)], pa.list_(pa.int64())),
                 pa.array([words.astype("<u8").tobytes()], pa.binary())],
                names=["part", "block", "start", "n_ids", "n_words", "n_escapes", "docs", "ends", "words"])
            block, start, held, sizes, docs = block + 1, start + len(ids), [], [], []
            return row

        end, waiting = np.array([end_id], np.uint32), 0
        for b in batches:
            id_type = b.schema.field(0).type
            texts, row = b.column(1).cast(pa.binary()), 0
            while row < len(texts):
                take, size = [], 0
                while row + len(take) < len(texts) and (not take or size < TEXT_BYTES):
                    t = texts[row + len(take)].as_py()
                    take.append(t)
                    size += len(t or b"")
                ids, bounds = enc.encode(take)
                names = b.column(0).slice(row, len(take)).to_pylist()
                row += len(take)
                for k, name in enumerate(names):
                    held += [ids[bounds[k]:bounds[k + 1]], end]
                    sizes.append(int(bounds[k + 1] - bounds[k]) + 1)
                    docs.append(name)
                    waiting += sizes[-1]
                    if waiting >= block_ids:
                        yield flush()
                        waiting = 0
        if docs:
            yield flush()

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(encode_part, "part int, block int, start long, n_ids long, n_words long, n_escapes long, "
                       f"docs array<{kind.simpleString()}>, ends array<long>, words binary").write.parquet(path)


def read_tokens(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) per document, decoded from the files under ``path``."""
    on_workers(spark)
    blocks = spark.read.parquet(path)
    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    # A row per part: where it starts in the whole stream.  Parts are bounded by the job's tasks.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def decode_blocks(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = decode(np.frombuffer(r["words"], "<u8"), r["n_ids"], r["n_escapes"]).astype("<u4")
                ends = np.array(r["ends"])
                begins = np.concatenate(([0], ends[:-1]))
                cols = [pa.array(r["docs"], id_type(b)), pa.array(r["base"] + r["start"] + begins), pa.array(ends - begins),
                        pa.array([zlib.crc32(ids[x:y]) for x, y in zip(begins, ends)], pa.int64())]
                if with_ids:
                    cols.append(pa.array([ids[x:y].astype(np.int64) for x, y in zip(begins, ends)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=["id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    def id_type(b):
        return b.schema.field(b.schema.get_field_index("docs")).type.value_type

    return blocks.join(F.broadcast(parts), "part").mapInArrow(
        decode_blocks, f"id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def token_files(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Write the files to a fresh shared folder and return what reading them back gives."""
    path = scratch_path(df.sparkSession, "simple8b")
    write_tokens(df, path, id_col, text_col, **how)
    return read_tokens(df.sparkSession, path).withColumnRenamed("id", id_col)
