"""Operator 9, packing: vector bin packing with the dot-product heuristic.

A sequence has three limits: tokens, segments (pieces) and loss-bearing tokens.  An example's demand is a
vector of the three, each as a share of its limit.  A sequence is filled by the waiting example whose
demand has the largest dot product with what is left (weighted by how scarce each resource is among the
waiting examples); when none fits whole, the best one is cut to fill the sequence, its rest waits on.
Examples of a whole sequence's length or more fill sequences of their own first.

Every task packs the examples of its partition: no shuffle.  At most ``WAITING`` rests are in memory, or as many
as hold the tokens of one sequence (very short examples).  What is
left at a task's end, less than one sequence, goes into sequences whose lengths are powers of two, which
need no padding.  So does a sequence whose segments or loss tokens run out before its tokens: it ends at the last
power of two, what it holds beyond that waits on.  Sequence ids are the task's number (high bits) and a count.

Defined results: a null text counts as empty (its end id only); rows with the same id are packed each on
their own; a null prompt has no tokens; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import on_workers
from .tokens import VOCABULARY, encoder

MAX_TOKENS, MAX_SEGMENTS = 4096, 128
WAITING = 1024
TEXT_BYTES = 2 << 20


@dataclass
class Piece:
    """``length`` tokens of example ``key`` from ``start`` on, at ``offset`` of a sequence."""
    key: int
    start: int
    length: int
    sequence: int
    offset: int


class Packer:
    """Streaming vector bin packing; ``add`` and ``finish`` yield the pieces of finished sequences.

    Loss-bearing tokens of an example are those from its ``prompt`` length on.
    """

    def __init__(self, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None,
                 waiting: int = WAITING):
        self.limits = np.array([max_tokens, max_segments, max_loss or max_tokens], float)
        self.most = waiting
        self.rows = np.zeros((4 * waiting + 8, 5), np.int64)    # key, start, tokens, loss, prompt
        self.n = 0
        self.tokens = 0             # of all waiting rests
        self.sequence = 0

    def _put(self, key: int, start: int, tokens: int, prompt: int) -> None:
        if self.n == len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        self.rows[self.n] = key, start, tokens, max(0, start + tokens - max(start, prompt)), prompt
        self.n += 1
        self.tokens += tokens

    def _drop(self, i: int) -> None:
        self.n -= 1
        self.tokens -= int(self.rows[i, 2])
        self.rows[i] = self.rows[self.n]

    def add(self, key: int, tokens: int, prompt: int = 0) -> Iterator[Piece]:
        start = 0
        most, loss = int(self.limits[0]), int(self.limits[2])
        while tokens - start >= most and start + most - max(start, prompt) <= loss:
            yield Piece(key, start, most, self.sequence, 0)
            self.sequence += 1
            start += most
        if tokens > start:
            self._put(key, start, tokens - start, prompt)
        while self.n >= self.most and self.tokens >= most:
            yield from self._fill(most)

    def finish(self) -> Iterator[Piece]:
        most = int(self.limits[0])
        while self.n:
            yield from self._fill(most if self.tokens >= most else 1 << self.tokens.bit_length() - 1)

    def _fill(self, size: int) -> Iterator[Piece]:
        """One sequence of ``size`` tokens, or where segments or loss tokens run out of a power of two."""
        left = self.limits.copy()
        left[0] = size
        offset = 0
        taken: list[tuple[int, int, int, int]] = []     # key, start, length, prompt
        while self.n and left[0] >= 1 and left[1] >= 1:
            rows = self.rows[:self.n]
            demand = np.stack((rows[:, 2], np.ones(self.n), rows[:, 3]), axis=1) / self.limits
            scarce = demand.sum(axis=0)
            score = demand @ (left / self.limits * scarce / scarce.max())
            fits = (rows[:, 2] <= left[0]) & (rows[:, 3] <= left[2])
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1.0)))
                take = int(rows[i, 2])
            else:
                # How much of each could come in: its tokens before the loss limit bites.
                quiet = rows[:, 2] - rows[:, 3]
                room = np.minimum(left[0], quiet + left[2])
                i = int(np.argmax(room))
                take = int(room[i])
                if take < 1:
                    break
            key, start, tokens, _, prompt = (int(x) for x in rows[i])
            loss = max(0, start + take - max(start, prompt))
            taken.append((key, start, take, prompt))
            offset += take
            left -= (take, 1, loss)
            self._drop(i)
            if take < tokens:
                self._put(key, start + take, tokens - take, prompt)
        over = 0 if offset == size else offset - (1 << offset.bit_length() - 1)
        while over:
            key, start, take, prompt = taken.pop()
            back = min(take, over)
            self._put(key, start + take - back, back, prompt)
            if back < take:
                taken.append((key, start, take - back, prompt))
            over -= back
        offset = 0
        for key, start, take, _ in taken:
            yield Piece(key, start, take, self.sequence, offset)
            offset += take
        self.sequence += 1


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, prompt_col: str | None = None,
         end_id: int = 2, vocabulary: str = VOCABULARY, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
         max_loss: int | None = None, with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset[, ids]) per piece.

    An example's ids are those of its prompt (``prompt_col``, bearing no loss), its text and ``end_id``.
    """
    on_workers(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def pack_part(batches):
        enc = encoder(vocabulary)
        packer = Packer(max_tokens, max_segments, max_loss)
        base = TaskContext.get().partitionId() << 33
        held: dict[int, list] = {}                      # key -> [id, ids, prompt length, tokens not yet placed]
        end, key = np.array([end_id], np.uint32), 0
        rows: list[tuple] = []

        def place(pieces):
            for p in pieces:
                doc = held[p.key]
                part = doc[1][p.start:p.start + p.length].astype("<u4")
                loss = max(0, p.start + p.length - max(p.start, doc[2]))
                rows.append((doc[0], p.start, p.length, zlib.crc32(part), len(doc[1]), loss, base + p.sequence, p.offset, part))
                doc[3] -= p.length
                if not doc[3]:
                    del held[p.key]

        def out(id_type):
            cols = list(zip(*rows))
            made = [pa.array(cols[0], id_type), *[pa.array(c, pa.int64()) for c in cols[1:8]]]
            if with_ids:
                made.append(pa.array([x.astype(np.int64) for x in cols[8]], pa.list_(pa.int64())))
            rows.clear()
            return pa.RecordBatch.from_arrays(made, names=names[:len(made)])

        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset", "ids"]
        id_type = None
        for b in batches:
            id_type = b.schema.field(0).type
            texts, prompts = b.column(1).cast(pa.binary()), b.column(2).cast(pa.binary())
            row = 0
            while row < len(texts):
                take, size = [], 0
                while row < len(texts) and (not take or size < TEXT_BYTES):
                    take += [prompts[row].as_py(), texts[row].as_py()]
                    size += len(take[-2] or b"") + len(take[-1] or b"")
                    row += 1
                ids, bounds = enc.encode(take)
                for k, name in enumerate(b.column(0).slice(row - len(take) // 2, len(take) // 2).to_pylist()):
                    a, m, z = bounds[2 * k:2 * k + 3]
                    whole = np.concatenate((ids[a:z], end))
                    held[key] = [name, whole, int(m - a), len(whole)]
                    place(packer.add(key, len(whole), int(m - a)))
                    key += 1
                if len(rows) > 2000 or with_ids and rows:
                    yield out(id_type)
        place(packer.finish())
        if rows:
            yield out(id_type)

    prompt = F.col(prompt_col) if prompt_col else F.lit(None)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), prompt.cast("string").alias("prompt"))
    return rows.mapInArrow(pack_part, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, "
                           "sequence_id long, offset long" + ", ids array<long>" * with_ids).withColumnRenamed("id", id_col)
