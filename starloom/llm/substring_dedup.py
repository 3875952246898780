"""Operator 4, substring deduplication: de Bruijn compaction of token windows.

Edges of the graph are all windows (k-mers) of ``WINDOW`` = 35 words.  Every window is anchored at the
smallest-hash ``ANCHOR``-word gram inside it; the windows of a document that share an anchor occurrence
are consecutive and form one path of up to 28 edges.  Equal windows have equal anchors, so:

1. anchors are counted over the corpus (one hash per path, about 1/14 of the windows); only documents'
   paths at an anchor that occurs twice or more go on (joined back to their document);
2. paths are joined on (anchor, hash of the whole path): where all paths at an anchor are the same, the
   path does not branch and is settled as a whole, with one row for all its edges;
3. where an anchor branches (copies that begin, end or were edited there), one path of each kind is
   opened into its edges, which are joined on (anchor, hash of the window);
4. the source coordinates of all repeated edges merge into spans; every span is one window long at
   least, and the words under it are removed.

An edge is known by two 64-bit hashes (anchor and window).  Counts are map-side combined aggregates, so
a passage in a third of all documents is one row per task and path.

Rows are numbered once in a stored table, and spans are told apart by that number, not by id or text.

Defined results: null, empty and shorter texts have no window and lose nothing; rows with the same id
(or none) and text repeat each other; windows are judged on the input, not on what is left; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, gram_starts, numbered, on_workers, range_hash, slices, spans, stored, text_hash

WINDOW, ANCHOR = 35, 8


def _anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each position the leftmost smallest of the ``width`` grams that start there."""
    value, at, have = grams, np.arange(len(grams)), 1

    def later(x, step):
        return np.concatenate((x[step:], np.repeat(x[-1:], min(step, len(x)))))[:len(x)]

    while have < width:
        step = min(have, width - have)
        v, a = later(value, step), later(at, step)
        left = value <= v
        value, at = np.where(left, value, v), np.where(left, at, a)
        have += step
    return at


def paths(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> dict[str, np.ndarray]:
    """The paths of the texts in one buffer: text, first window (as a word of the text), number of
    windows, anchor hash, and the index of the first window among all windows; and the word hashes."""
    s, e, first = spans(data, offsets)
    words = text_hash(data, s, e)
    starts, doc = gram_starts(first, window)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return {"doc": z, "lo": z, "n": z, "anchor": z.astype(np.uint64), "at": z, "starts": z, "words": words}
    p = np.arange(len(words))
    grams = range_hash(words, p, np.minimum(p + anchor, len(words)))
    pos = _anchors(grams, window - anchor + 1)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (pos[1:] != pos[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return {"doc": doc[at], "lo": starts[at] - first[doc[at]], "n": np.diff(np.append(at, len(starts))),
            "anchor": grams[pos[at]], "at": at, "starts": starts, "words": words}


def _anchor_batches(batches):
    for b in batches:
        data, offsets = buffers(b.column(1))
        for i, j in slices(offsets):
            got = paths(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(got["doc"] + i)),
                                              pa.array(got["anchor"].view(np.int64))], names=["row", "anchor"])


def _path_batches(batches):
    """Of documents with their repeated anchors: the paths at those, and the hashes of their windows."""
    for b in batches:
        data, offsets = buffers(b.column(1))
        want = b.column(2)
        flat, bounds = np.asarray(want.flatten()), np.concatenate(([0], np.cumsum([len(x) if x.is_valid else 0 for x in want])))
        for i, j in slices(offsets):
            got = paths(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            anchors = got["anchor"].view(np.int64)
            keep = np.flatnonzero(np.isin(anchors, flat[bounds[i]:bounds[j]]))
            lo, n = got["starts"][got["at"][keep]], got["n"][keep]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            edge = range_hash(got["words"], np.repeat(lo, n) + inner, np.repeat(lo, n) + inner + WINDOW)
            binary = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(
                np.concatenate(([0], np.cumsum(n) * 8)).astype(np.int32)), pa.py_buffer(edge)])
            rows = pa.array(got["doc"][keep] + i)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), pa.array(anchors[keep]),
                 pa.array(range_hash(got["words"], lo, lo + n + WINDOW - 1).view(np.int64)),
                 pa.array(got["lo"][keep].astype(np.int32)), pa.array(n.astype(np.int32)), binary],
                names=["row", "anchor", "path", "lo", "n", "edges"])


def _edge_batches(batches):
    """Opened paths: a row for each edge, with the coordinates of its (single) source."""
    for b in batches:
        n = b.column(4).to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        edge = np.frombuffer(b"".join(b.column(5).to_pylist()), np.int64) if len(n) else np.zeros(0, np.int64)
        rows = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(rows), b.column(1).take(rows), pa.array(edge),
             pa.array((b.column(3).to_numpy()[row] + inner).astype(np.int32)), b.column(6).take(rows)],
            names=["row", "anchor", "edge", "lo", "times"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(row, lo, n): runs of ``n`` repeated windows from word ``lo`` on, in the row with that key of the stored
    table ``docs`` (row, text).  Runs may touch."""
    seen = stored(docs.select("row", "text").mapInArrow(_anchor_batches, "row long, anchor long"), "debruijn-anchors")
    # Sets of keys are stored before they are joined: both sides of the join are then shuffles of their own,
    # and a hot anchor's rows can be split over tasks.
    often = stored(seen.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("anchor"), "debruijn-often")
    mine = seen.join(often, "anchor", "left_semi").groupBy("row").agg(F.collect_set("anchor").alias("want"))
    found = docs.join(mine, "row").select("row", "text", "want")
    path = stored(found.mapInArrow(_path_batches, "row long, anchor long, path long, lo int, n int, edges binary"),
                  "debruijn-paths")
    kinds = stored(path.groupBy("anchor", "path").agg(F.count(F.lit(1)).cast("int").alias("times")), "debruijn-kinds")
    whole = path.select("row", "anchor", "path", "lo", "n").join(
        kinds.filter("times > 1").select("anchor", "path"), ["anchor", "path"], "left_semi")
    branching = stored(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("anchor"),
                       "debruijn-branching")
    at_branch = stored(kinds.join(branching, "anchor", "left_semi"), "debruijn-branches")
    names = ["row", "anchor", "path", "lo", "n", "edges"]
    once = path.join(at_branch.filter("times = 1"), ["anchor", "path"]).select(*names, "times")
    # Of paths that occur often one source is enough: their edges are settled, they only answer for others.
    often = (path.select("anchor", "path", "n", "edges").join(at_branch.filter("times > 1"), ["anchor", "path"])
             .groupBy("anchor", "path").agg(F.first("n").alias("n"), F.first("edges").alias("edges"), F.first("times").alias("times"))
             .select(F.lit(None).cast("long").alias("row"), "anchor", "path", F.lit(-1).alias("lo"), "n", "edges", "times"))
    edges = stored(once.unionByName(often).mapInArrow(
        _edge_batches, "row long, anchor long, edge long, lo int, times int"), "debruijn-edges")
    shared = stored(edges.groupBy("anchor", "edge").agg(F.sum("times").alias("k")).filter("k > 1").select("anchor", "edge"),
                    "debruijn-shared")
    single = edges.filter("times = 1").join(shared, ["anchor", "edge"], "left_semi")
    return whole.select("row", "lo", "n").unionByName(single.select("row", "lo", F.lit(1).alias("n")))


def _cut_batches(batches):
    for b in batches:
        ids, los, ns = [], b.column(2), b.column(3)
        n_words, n_removed, sha, left = [], [], [], []
        for row, text in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
            words = (text or b"").split()            # ASCII white space only
            removed = 0
            if los[row].is_valid:
                lo, n = np.asarray(los[row].values), np.asarray(ns[row].values)
                d = np.bincount(lo, minlength=len(words) + 1) - np.bincount(lo + n + WINDOW - 1, minlength=len(words) + 1)
                keep = np.cumsum(d)[:len(words)] == 0
                removed = int(len(words) - keep.sum())
                n_words.append(len(words))
                words = list(compress(words, keep.tolist()))
            else:
                n_words.append(len(words))
            n_removed.append(removed)
            rest = b" ".join(words)
            left.append(rest)
            sha.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()),
             pa.array(left, pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept_text): each document without the words covered by a
    window of ``WINDOW`` words whose sequence also starts anywhere else; kept words joined by one space."""
    on_workers(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    docs = numbered(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "debruijn-documents")
    runs = stored(repeated_spans(docs), "debruijn-spans")
    of_row = runs.groupBy("row").agg(F.collect_list(F.struct("lo", "n")).alias("r"))
    out = docs.join(of_row, "row", "left").select("id", "text", F.col("r.lo").alias("lo"), F.col("r.n").alias("n")).mapInArrow(
        _cut_batches, f"id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out.withColumnRenamed("id", id_col)
