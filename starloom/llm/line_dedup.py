"""Operator 7, line deduplication: winnowing over line hashes.

The lines of a text are its \\n-split lines that hold a word.  A run of consecutive lines is long enough
to be a repeat with ``RUN`` lines or ``MIN_WORDS`` words.  From every shortest such run, begun at each line,
the line with the smallest hash is selected; so whatever longer run occurs twice, both places have a
selected line, the same one, at the same place in the run.

1. One pass stores each text's line hashes and word counts, and its selected lines (the fingerprints).
2. Fingerprints that occur once are left behind; the positions of the others are joined to their texts.
3. Around each repeated fingerprint the match is extended over the stored line hashes: forward from each
   line to the shortest run that is long enough, and back from each line likewise.  Every line of a longer
   run lies in one of these, so extension by them reaches exactly as far as the match itself.
4. Runs are joined on (fingerprint, hash of the run).  Of equal runs the first stays (by id, then text hash,
   row and line); the others are later repeats, merge where they overlap or touch, and are deleted.

So a line goes if it lies in a run of ``RUN`` lines or ``MIN_WORDS`` words that also stands at an earlier
position.  A text too short for any run is one fingerprint and one run as a whole, and goes if an earlier
text consists of the same lines.  Fingerprints and runs are counted by aggregates, one row per task for a hot
line; positions are never paired with each other.

Lines without a word are not counted and stay.  Defined results: null counts as empty; rows are positions
of their own, also with the same id (or none) and text, and then all but one are repeats; a null id comes
before all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, mix64, numbered, on_workers, per_text, range_hash, slices, spans, stored, text_hash

RUN, MIN_WORDS = 3, 8
WHOLE = np.uint64(0x5851F42D4C957F2D)       # sets whole short texts apart from runs of longer ones


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines with a word, and each text's first line (n+1 bounds)."""
    s, e, _, first = counted_lines(data, offsets)
    return s, e, first


def counted_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``lines`` with the number of words in each as third."""
    word = spans(data, offsets)[0]
    breaks = np.flatnonzero(data == 0x0A)
    full = offsets[:-1] < offsets[1:]
    s = np.unique(np.concatenate((offsets[:-1][full], breaks + 1)))
    s = s[s < len(data)]
    e = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, s)],
                   offsets[np.minimum(np.searchsorted(offsets, s, side="right"), len(offsets) - 1)])
    n = np.searchsorted(word, e) - np.searchsorted(word, s)
    s, e, n = s[n > 0], e[n > 0], n[n > 0]
    return s, e, n, np.searchsorted(s, offsets)


def shortest_runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each line the end of the shortest run from it that is long enough (0: none in its text), and for
    each line the start of the shortest such run that ends with it (-1: none)."""
    at = np.arange(len(words))
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    before = np.concatenate(([0], np.cumsum(words)))                    # strictly ascending: every line has a word
    end = np.minimum(at + RUN, np.searchsorted(before, before[:-1] + MIN_WORDS))
    start = np.maximum(at + 1 - RUN, np.searchsorted(before, before[1:] - MIN_WORDS, side="right") - 1)
    return np.where(end <= bounds[1:][text], end, 0), np.where(start >= bounds[:-1][text], start, -1)


def fingerprints(h: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The line that each line's shortest run selects (the leftmost smallest hash; -1: no run), and whether a
    text is too short for any run."""
    at = np.arange(len(h))
    chosen = at.copy()
    for step in range(1, RUN):
        other = np.minimum(at + step, len(h) - 1)
        chosen = np.where((other < end) & (h[other] < h[chosen]), other, chosen)
    some = per_text(end > 0, bounds) > 0
    return np.where(end > 0, chosen, -1), ~some & (np.diff(bounds) > 0)


def _line_batches(batches):
    """Of (row, id, text): the line hashes, word counts and different fingerprints of each text."""
    for b in batches:
        data, offsets = buffers(b.column(2))
        for i, j in slices(offsets):
            d, o = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            s, e, n, bounds = counted_lines(d, o)
            h = text_hash(d, s, e)
            chosen, short = fingerprints(h, shortest_runs(n, bounds)[0], bounds)
            # A selected line is one fingerprint, however many runs select it.
            picked = np.unique(chosen[chosen >= 0])
            mark, text = h[picked], np.searchsorted(bounds, picked, side="right") - 1
            whole = np.flatnonzero(short)
            mark = np.concatenate((mark, range_hash(h, bounds[whole], bounds[whole + 1]) ^ WHOLE))
            text = np.concatenate((text, whole))
            order = np.argsort(text, kind="stable")
            cuts = np.searchsorted(text[order], np.arange(j - i + 1))

            def lists(values, at):
                return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values))

            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), b.column(3).slice(i, j - i),
                 lists(h.view(np.int64), bounds), lists(n.astype(np.int32), bounds), lists(mark[order].view(np.int64), cuts)],
                names=["row", "id", "th", "hashes", "words", "marks"])


def _pair(text: np.ndarray, mark: np.ndarray) -> np.ndarray:
    return mix64(mark + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _run_batches(batches):
    """Of texts with their repeated fingerprints: the runs that hold one of these, extended both ways."""
    for b in batches:
        if not b.num_rows:
            continue
        o = b.column(3).offsets.to_numpy().astype(np.int64)
        bounds = o - o[0]
        h = b.column(3).flatten().to_numpy().view(np.uint64)
        words = b.column(4).flatten().to_numpy()
        want = b.column(5).flatten().to_numpy().view(np.uint64)
        w = b.column(5).offsets.to_numpy().astype(np.int64)
        end, start = shortest_runs(words, bounds)
        chosen, short = fingerprints(h, end, bounds)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        forward = np.flatnonzero(end > 0)
        back = np.flatnonzero(start >= 0)
        lo, hi = np.concatenate((forward, start[back])), np.concatenate((end[forward], back + 1))
        # A run's fingerprint is that of the shortest run from its first line, which lies within it.
        lo, hi = np.unique(np.stack((lo, hi)), axis=1) if len(lo) else (lo, hi)
        doc, mark, run = text[lo], h[chosen[lo]], range_hash(h, lo, hi)
        whole = np.flatnonzero(short)
        of_text = range_hash(h, bounds[whole], bounds[whole + 1]) ^ WHOLE
        lo, hi = np.concatenate((lo, bounds[whole])), np.concatenate((hi, bounds[whole + 1]))
        doc, mark, run = np.concatenate((doc, whole)), np.concatenate((mark, of_text)), np.concatenate((run, of_text))
        wanted = np.repeat(np.arange(len(w) - 1), np.diff(w))
        keep = np.isin(_pair(doc, mark), _pair(wanted, want))           # one taken in vain would only be a run found once
        doc, mark, run, lo, hi = doc[keep], mark[keep], run[keep], lo[keep], hi[keep]
        rows = pa.array(doc)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(rows), b.column(1).take(rows), b.column(2).take(rows), pa.array(mark.view(np.int64)),
             pa.array(run.view(np.int64)), pa.array((lo - bounds[doc]).astype(np.int32)), pa.array((hi - lo).astype(np.int32))],
            names=["row", "id", "th", "mark", "run", "line", "n"])


def _cut_batches(batches):
    for b in batches:
        n_lines, n_removed, sha, left = [], [], [], []
        for row, text in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
            parts = (text or b"").split(b"\n")
            real = [k for k, x in enumerate(parts) if x.split()]
            gone: set[int] = set()
            if b.column(2)[row].is_valid:
                lo, n = np.asarray(b.column(2)[row].values), np.asarray(b.column(3)[row].values)
                d = np.bincount(lo, minlength=len(real) + 1) - np.bincount(lo + n, minlength=len(real) + 1)
                gone = {real[k] for k in np.flatnonzero(np.cumsum(d)[:len(real)])}
            rest = b"\n".join(x for k, x in enumerate(parts) if k not in gone)
            n_lines.append(len(real))
            n_removed.append(len(gone))
            left.append(rest)
            sha.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()),
             pa.array(left, pa.binary()).cast(pa.string())], names=["id", "n_lines", "n_removed", "kept_sha256", "kept_text"])


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_removed, kept_sha256, kept_text) per document; the rest joined by newlines again."""
    on_workers(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    docs = numbered(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "winnow-documents")
    hashed = stored(docs.select("row", "id", "text", F.xxhash64("text").alias("th")).mapInArrow(
        _line_batches, f"row long, id {kind}, th long, hashes array<long>, words array<int>, marks array<long>"), "winnow-lines")
    marks = hashed.select("row", F.explode("marks").alias("mark"))
    often = stored(marks.groupBy("mark").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("mark"), "winnow-often")
    mine = marks.join(often, "mark", "left_semi").groupBy("row").agg(F.collect_set("mark").alias("want"))
    runs = stored(hashed.drop("marks").join(mine, "row").select("row", "id", "th", "hashes", "words", "want").mapInArrow(
        _run_batches, f"row long, id {kind}, th long, mark long, run long, line int, n int"), "winnow-runs")
    place = F.struct("id", "th", "row", "line")
    first = runs.groupBy("mark", "run").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = stored(first.filter("first <> last").select("mark", "run", "first"), "winnow-repeated")
    later = runs.join(repeated, ["mark", "run"]).filter(place > F.col("first"))
    cuts = later.groupBy("row").agg(F.collect_list(F.struct("line", "n")).alias("cut"))
    return docs.join(cuts, "row", "left").select("id", "text", "cut.line", "cut.n").mapInArrow(
        _cut_batches, f"id {kind}, n_lines long, n_removed long, kept_sha256 string, kept_text string"
    ).withColumnRenamed("id", id_col)
