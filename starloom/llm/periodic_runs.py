"""Periodic run detection by recompression.

A run is a stretch of consecutive words whose smallest period is q (words q apart are identical), of at least
max(``LEAST``, ``TIMES`` q) words, that no neighbouring word extends keeping period q.

* **Grammar.** The words of a slice of texts become numbers (equal numbers mean equal bytes; no hashing).
  Then blocks of one symbol and pairs of neighbouring symbols are replaced by new symbols in turn, until
  each text is one symbol: a run-length grammar whose rounds are kept as levels.  Which symbols open and
  which close a pair is dealt anew each round; the same sequence is parsed alike wherever it stands, but
  for its edges.
* **Extensions.** How far two places agree, forwards or backwards, is found by climbing the levels while
  both places are at edges of symbols, and descending from where they differ: a few steps a level, whole
  blocks at once, for many pairs of places together.
* **Candidates.** A run of period p agrees with itself p words on for at least m = max(LEAST, TIMES p) - p
  words, so one of the places 0, m, 2m, ... lies among them: n/m places for every p up to n/TIMES, a
  harmonic sum.  Places that agree are extended both ways exactly; stretches that are long enough are runs,
  and the smallest p that found a stretch is its smallest period (a smaller period would divide p and have
  found it, too).

A text is handled whole, in one row of one task, so nothing is shuffled.  Memory follows the slice: many small
texts of ``CHUNK_BYTES`` together, a longer one alone, candidates ``CANDIDATES`` at a time.

Defined results: a null text has no words, thus no runs and an empty collapsed text; so has a text without
words.  Ids play no part, equal rows give equal rows, an empty table gives none, other columns keep names and values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, buffers, free_name, mix64, on_workers, slices, spans

#: A run has at least LEAST words, and TIMES its period.
LEAST, TIMES = 24, 3
#: Pairs of places that are extended together.
CANDIDATES = 1 << 20


def word_numbers(data: np.ndarray, ws: np.ndarray, we: np.ndarray) -> np.ndarray:
    """A number for each word [ws, we) of the bytes, equal for equal words."""
    size = we - ws
    inside = np.zeros(len(data) + 1, np.int8)
    inside[ws] = 1
    inside[we] -= 1
    packed = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    bounds = np.concatenate(([0], np.cumsum(size)))
    words = pa.Array.from_buffers(pa.large_binary(), len(ws), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int32)


class Level:
    """One round: symbols (separators are negative), their lengths in words, and how they join into the next."""

    def __init__(self, symbols: np.ndarray, size: np.ndarray):
        self.symbols, self.size = symbols, size
        self.parent = self.first = None           # symbol of the next level; first symbol here of each of those
        self.blocks = False                       # the next level joins blocks (else pairs)

    def join(self, opens: np.ndarray, blocks: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next level's symbols begin at ``opens``; returns their old first symbols, counts and lengths."""
        self.blocks = blocks
        self.first = np.append(opens, len(self.symbols)).astype(np.int32)
        starts = np.zeros(len(self.symbols), np.int32)
        starts[opens] = 1
        self.parent = np.cumsum(starts, dtype=np.int32) - 1
        total = np.concatenate(([0], np.cumsum(self.size, dtype=np.int64)))
        return self.symbols[opens], np.diff(self.first), (total[self.first[1:]] - total[self.first[:-1]]).astype(np.int32)


def _named(symbols: np.ndarray, joined: np.ndarray, other: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """New names, from ``free`` on, for the marked symbols, equal where symbol and ``other`` are equal."""
    keys = symbols[joined].astype(np.int64) << 32 | other[joined].astype(np.int64)
    kinds, names = np.unique(keys, return_inverse=True)
    out = symbols.copy()
    out[joined] = names.astype(np.int32) + free
    return out, free + len(kinds)


def recompress(symbols: np.ndarray) -> list[Level]:
    """The levels of the grammar.  Words are numbers from 0; a text begins and ends with a separator, a
    negative number that occurs once."""
    free = int(symbols.max(initial=-1)) + 1
    levels = [Level(symbols.astype(np.int32), np.ones(len(symbols), np.int32))]
    turn = 0
    while True:
        top = levels[-1]
        s = top.symbols
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        if not new.all():
            symbols, count, size = top.join(np.flatnonzero(new), True)
            named, free = _named(symbols, count > 1, count, free)
            top = Level(named, size)
            levels.append(top)
            s = named
        near = (s[:-1] >= 0) & (s[1:] >= 0)
        if not near.any():
            return levels
        while True:
            turn += 1
            side = (mix64(s.astype(np.int64).view(np.uint64) + (np.uint64(turn) << np.uint64(40))) & np.uint64(1)).astype(bool)
            up, down = near & ~side[:-1] & side[1:], near & side[:-1] & ~side[1:]
            pair = up if np.count_nonzero(up) >= np.count_nonzero(down) else down
            if pair.any():
                break
        opens = np.ones(len(s), bool)
        opens[1:] = ~pair
        opens = np.flatnonzero(opens)
        symbols, count, size = top.join(opens, False)
        named, free = _named(symbols, count > 1, s[np.minimum(opens + 1, len(s) - 1)], free)
        levels.append(Level(named, size))


def extend(levels: list[Level], x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from places x and y on (of one text each, x < y), forwards (step 1) or
    backwards (step -1), the places themselves included."""
    n = len(x)
    total, stop = np.zeros(n, np.int64), np.full(n, len(levels) - 1)
    at_x, at_y = x.astype(np.int64), y.astype(np.int64)

    def advance(level, who):
        """Move those whose symbols agree past them; returns those that moved."""
        a, b = at_x[who], at_y[who]
        same = level.symbols[a] == level.symbols[b]
        who, a, b = who[same], a[same], b[same]
        if level.blocks:                    # what is left of both blocks, at once
            pa_, pb = level.parent[a], level.parent[b]
            if step > 0:
                k = np.minimum(level.first[pa_ + 1] - a, level.first[pb + 1] - b)
            else:
                k = np.minimum(a - level.first[pa_], b - level.first[pb]) + 1
        else:
            k = 1
        total[who] += level.size[a].astype(np.int64) * k
        at_x[who], at_y[who] = a + step * k, b + step * k
        return who

    climbing = np.arange(n)
    for depth, level in enumerate(levels[:-1]):
        up, moving = [], climbing
        while len(moving):
            a, b = at_x[moving], at_y[moving]
            pa_, pb = level.parent[a], level.parent[b]
            shift = 0 if step > 0 else 1
            edge = ((level.first[pa_ + shift] - shift == a) & (level.first[pb + shift] - shift == b))
            up.append(moving[edge])
            rest = moving[~edge]
            moving = advance(level, rest)
            stop[np.setdiff1d(rest, moving, assume_unique=True)] = depth
        climbing = np.concatenate(up) if up else climbing[:0]
        at_x[climbing], at_y[climbing] = level.parent[at_x[climbing]], level.parent[at_y[climbing]]
    for depth in range(len(levels) - 1, -1, -1):
        level, who = levels[depth], np.flatnonzero(stop >= depth)
        moving = who
        while len(moving):
            moving = advance(level, moving)
        if depth:
            below = levels[depth - 1]
            if step > 0:
                at_x[who], at_y[who] = below.first[at_x[who]], below.first[at_y[who]]
            else:
                at_x[who], at_y[who] = below.first[at_x[who] + 1] - 1, below.first[at_y[who] + 1] - 1
    return total


def find_runs(numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs, by text, start and period; text k has the words
    ``numbers[first[k]:first[k + 1]]``."""
    none = np.zeros(0, np.int64)
    n = np.diff(first)
    texts = np.flatnonzero(n >= LEAST)
    if not len(texts):
        return none, none, none, none
    # Texts that can hold a run, each between separators.
    n = n[texts]
    begin = np.cumsum(n + 1) - n                     # place of a text's first word
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    seq = np.empty(int(n.sum() + len(n) + 1), np.int64)
    cut = np.append(begin - 1, len(seq) - 1)
    seq[cut] = -1 - np.arange(len(cut))
    seq[np.repeat(begin, n) + inner] = numbers[np.repeat(first[texts], n) + inner]
    levels = recompress(seq)
    periods = n // TIMES
    owner = np.repeat(np.arange(len(n)), periods)
    p = np.arange(len(owner)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    gap = np.maximum(LEAST, TIMES * p) - p
    places = -(-(n[owner] - p) // gap)
    ends = np.cumsum(places)
    found, lo = [], 0
    while lo < len(p):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + CANDIDATES, side="right")))
        many = places[lo:hi]
        k = np.repeat(np.arange(lo, hi), many)
        grid = (np.arange(len(k)) - np.repeat(ends[lo:hi] - many - done, many)) * gap[k]
        x, q = begin[owner[k]] + grid, p[k]
        # One of the two neighbours agrees as well, as m > 1.
        near = (seq[x] == seq[x + q])
        k, x, q = k[near], x[near], q[near]
        near = (seq[x + 1] == seq[x + q + 1]) | (seq[x - 1] == seq[x + q - 1])
        k, x, q = k[near], x[near], q[near]
        back = extend(levels, x - 1, x + q - 1, -1)
        length = back + extend(levels, x, x + q, 1) + q
        run = length >= np.maximum(LEAST, TIMES * q)
        text = owner[k[run]]
        rows = np.stack([text, (x - back)[run] - begin[text], length[run], q[run]], axis=1)
        found.append(np.unique(rows, axis=0))
        lo = hi
    rows = np.unique(np.concatenate(found), axis=0)
    fresh = np.ones(len(rows), bool)                 # the smallest period of each stretch comes first
    fresh[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[fresh]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return texts[rows[:, 0]], rows[:, 1], rows[:, 2], rows[:, 3]


def join_words(data: np.ndarray, ws: np.ndarray, we: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """For each text its kept words, joined by one space."""
    n = np.concatenate(([0], np.cumsum(keep)))[first]
    ws, size = ws[keep], (we - ws)[keep]
    stretch = size + 1
    at = np.cumsum(stretch) - stretch
    place = np.repeat(ws - at, stretch) + np.arange(stretch.sum())
    out = np.append(data, np.uint8(0x20))[np.minimum(place, len(data))]
    out[at + size] = 0x20
    keep_space = np.ones(len(out), bool)
    last = n[1:][n[1:] > n[:-1]] - 1                  # no space after a text's last word
    keep_space[(at + size)[last]] = False
    bounds = np.concatenate(([0], np.cumsum(stretch)))[n] - np.concatenate(([0], np.cumsum(n[1:] > n[:-1])))
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out[keep_space])])


def _run_batches(n_columns: int, names: list[str]):
    fields = [pa.field(x, pa.int64()) for x in ("start", "length", "period")]

    def runs_of(data, offsets):
        ws, we, first = spans(data, offsets)
        numbers = word_numbers(data, ws, we)
        text, start, length, period = find_runs(numbers, first)
        opens = np.bincount(first[text] + start + period, minlength=len(ws) + 1)
        closes = np.bincount(first[text] + start + length, minlength=len(ws) + 1)
        keep = np.cumsum(opens - closes)[:len(ws)] == 0
        structs = pa.StructArray.from_arrays([pa.array(v.astype(np.int64)) for v in (start, length, period)], fields=fields)
        bounds = np.searchsorted(text, np.arange(len(offsets))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), structs), join_words(data, ws, we, first, keep), np.diff(first)

    def run(batches):
        for b in batches:
            data, offsets = buffers(b.column(n_columns))
            for i, j in slices(offsets):
                found, left, n = runs_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(i, j - i) for c in b.columns[:n_columns]], pa.array(n.astype(np.int64)), found, left.cast(pa.string())],
                    names=names)
    return run


RUNS = T.ArrayType(T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")]))


def periodic_runs(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``n_words``, ``runs`` (start word, length and period of every run, by start, then period) and
    ``collapsed_text`` (words that no run contains after its first period, joined by one space); names that
    ``df`` has are underscored."""
    on_workers(df.sparkSession)
    columns = df.columns if keep is None else keep
    inner = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col(text_col).alias("t"))
    schema = inner.drop("t").schema.add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    added = [free_name(df, c) for c in ("n_words", "runs", "collapsed_text")]
    return inner.mapInArrow(_run_batches(len(columns), schema.names), schema).toDF(*columns, *added)


# -- The query's texts and digests ----------------------------------------------------------------------

def with_planted_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts as the contract changes them: with h = crc32(id as text), g = h div 10 and n > 0 words, a text whose
    h ends in 0 repeats its words a ... a + p - 1 from word a = g % n on, p = 1 + (n - a) div (3 + g % 8).  A
    row without an id stays as it is."""
    n_col, w_col = free_name(df, "n"), free_name(df, "w")
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)))
    held = df.withColumn(w_col, words).withColumn(n_col, F.size(w_col).cast("bigint"))
    n, w = F.col(n_col), F.col(w_col)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
    place = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1),
                        lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    changed = F.when(n > 0, F.array_join(place, " ")).otherwise(F.col(text_col))
    return held.withColumn(text_col, changed).drop(w_col, n_col)


def run_digests(runs: Column, collapsed: Column) -> list[Column]:
    """n_runs; start, length, period and exponent (in thousandths) of the run with the greatest exponent, then
    smallest start and period; digests of all runs and of the collapsed text."""
    def better(best, r):
        left, right = r["length"] * best["period"], best["length"] * r["period"]
        wins = (left > right) | ((left == right) & ((r["start"] < best["start"]) | ((r["start"] == best["start"]) & (r["period"] < best["period"]))))
        return F.when(best["period"].isNull() | wins, r).otherwise(best)
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate(runs, none, better)
    rows = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(rows, "\n"), F.when(F.size(runs) > 0, F.lit("\n")).otherwise(F.lit("")))
    return [F.size(runs).cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
            best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).cast("bigint").alias("exponent_milli"),
            F.sha2(text, 256).alias("runs_sha256"), F.sha2(collapsed, 256).alias("collapsed_sha256")]
