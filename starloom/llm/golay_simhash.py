"""Operator 10, SimHash near-duplicates by Golay-code fuzzy hashing.

The 64 bits of a fingerprint are three segments (22, 21 and 21 bits), each filled up to the 23 bits of
the perfect Golay code.  A 23-bit word lies within 3 bits of exactly one codeword; decoding the word and
its 23 one-bit neighbours gives one to six codewords (index 0-4095) near it, and two words at most 2 bits
apart share one of them (that of the word halfway).  Two fingerprints at most 2 bits apart agree wholly
in one of the three segments (pigeonhole), so they meet under a key made of that segment and a codeword
near the next one.  Keys are joined by dealing them to partitions, every meeting is verified by its
number of differing bits, and links become components by label propagation in Spark.

Distinct fingerprints only go through the index, so any number of exact copies costs one row; within a
key, fingerprints are compared by neighbour look-up when they are many, and only the links of a spanning
forest leave the task.  Nothing is capped.

Defined results: null or word-less texts have fingerprint zero and are linked like any other; components
go by fingerprint, so rows with the same id and different texts can lie in different ones; a null id never
names a component unless all ids in it are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, free_name, on_workers, slices, stored

SHINGLE, MAX_BITS, SEED = 3, 2, 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))        # first bit and width of each segment
GOLAY = 0b101011100011                          # fixed value: generator polynomial of the (23, 12) code
_FLIPS = np.concatenate(([np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)))
#: A key with more fingerprints than this is searched by neighbour look-up instead of by pairs.
DENSE = 64


# -- Fingerprints -------------------------------------------------------------------------------------

def shingle_hashes(text: bytes, k: int = SHINGLE, seed: int = SEED) -> list[int]:
    """XXH64 of each shingle of ``k`` words (A-Z lower-cased, space-joined), repeats included."""
    words = text.lower().split()        # bytes.lower and bytes.split know ASCII only
    if not words:
        return []
    h = xxhash.xxh64_intdigest
    if len(words) <= k:
        return [h(b" ".join(words), seed)]
    if k == 3:
        return [h(b"%b %b %b" % w, seed) for w in zip(words, words[1:], words[2:])]
    return [h(b" ".join(words[i:i + k]), seed) for i in range(len(words) - k + 1)]


_LANES = np.uint64(0x0001000100010001)


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per range of hashes the word whose bits are set in over half of them (zero for an empty range).

    Bits are counted four at a time in 16-bit lanes, over runs of at most 65,535 hashes.
    """
    n = len(bounds) - 1
    out = np.zeros(n, np.uint64)
    if not len(hashes):
        return out
    size = np.diff(bounds)
    cuts = np.unique(np.concatenate([bounds[:-1][size > 0], *[np.arange(a, b, 65535) for a, b in
                                                             zip(bounds[:-1], bounds[1:]) if b - a > 65535]]))
    owner = np.searchsorted(bounds, cuts, side="right") - 1
    # An empty range repeats its neighbour's bound; the last of equal bounds owns the cut.
    for j in range(16):
        lanes = np.add.reduceat((hashes >> np.uint64(j)) & _LANES, cuts)
        for lane in range(4):
            c = np.bincount(owner, weights=((lanes >> np.uint64(16 * lane)) & np.uint64(0xFFFF)).astype(np.float64), minlength=n)
            out |= (2 * c > size).astype(np.uint64) << np.uint64(16 * lane + j)
    return out


def fingerprints(col: pa.Array, k: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprints of a column of texts."""
    data, offsets = buffers(col)
    out = np.zeros(len(offsets) - 1, np.uint64)
    for i, j in slices(offsets):
        hashes, sizes = [], [0]
        for d in range(i, j):
            hashes += shingle_hashes(data[offsets[d]:offsets[d + 1]].tobytes(), k, seed)
            sizes.append(len(hashes))
        out[i:j] = majority(np.array(hashes, np.uint64), np.array(sizes))
    return out


def with_fingerprint(df: DataFrame, text_col: str, out: str, k: int = SHINGLE, seed: int = SEED,
                     columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``df`` (all of them) with the fingerprint as a signed 64-bit long ``out``."""
    on_workers(df.sparkSession)
    columns = df.columns if columns is None else columns
    inner = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(text_col).alias("t"))
    n = len(columns)

    def add(batches):
        for b in batches:
            fp = fingerprints(b.column(n), k, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(fp)], names=[*b.schema.names[:n], "fp"])

    schema = inner.drop("t").schema.add("fp", "long")
    return inner.mapInArrow(add, schema).toDF(*columns, out)


# -- The code -----------------------------------------------------------------------------------------

def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each 23-bit word the index of its codeword; the error patterns behind it, by syndrome."""
    def rest(x: np.ndarray) -> np.ndarray:      # remainder modulo the generator: the syndrome
        x = x.copy()
        for bit in range(22, 10, -1):
            x ^= np.where((x >> bit) & 1, GOLAY << (bit - 11), 0)
        return x
    e = [0]
    for a in range(23):
        e.append(1 << a)
        for b in range(a):
            e.append(1 << a | 1 << b)
            e += [1 << a | 1 << b | 1 << c for c in range(b)]
    e = np.array(e, np.int64)
    error = np.zeros(2048, np.int64)
    error[rest(e)] = e                          # 1 + 23 + 253 + 1771 patterns, one for each syndrome
    words = np.arange(1 << 23, dtype=np.int64)
    return ((words ^ error[rest(words)]) >> 11).astype(np.uint16), error


_NEAR: list[np.ndarray] = []


def near_codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, codeword index) for each of the one to six codewords near each 23-bit word."""
    if not _NEAR:
        _NEAR.append(_golay_tables()[0])        # 16 MB per Python worker
    flips = np.concatenate(([0], 1 << np.arange(23)))
    got = np.sort(_NEAR[0][words[:, None] ^ flips[None, :]], axis=1)
    new = np.ones(got.shape, bool)
    new[:, 1:] = got[:, 1:] != got[:, :-1]
    row = np.nonzero(new)[0]
    return row, got[new]


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of fingerprints: segment number, that segment whole, a codeword near the next one."""
    rows, keys = [], []
    for i, (first, width) in enumerate(SEGMENTS):
        exact = (fp >> np.uint64(first)) & np.uint64((1 << width) - 1)
        f, w = SEGMENTS[(i + 1) % 3]
        row, code = near_codewords(((fp >> np.uint64(f)) & np.uint64((1 << w) - 1)).astype(np.int64))
        rows.append(row)
        keys.append((np.uint64(i) << np.uint64(40)) | (exact[row] << np.uint64(12)) | code.astype(np.uint64))
    return np.concatenate(rows), np.concatenate(keys)


def _emit_keys(batches):
    for b in batches:
        fp = b.column(0).to_numpy().view(np.uint64)
        for i in range(0, len(fp), 20_000):
            part = fp[i:i + 20_000]
            row, key = keys_of(part)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(part[row].view(np.int64))],
                                             names=["key", "fp"])


# -- Links --------------------------------------------------------------------------------------------

def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes under the links a-b."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        lo, hi = np.minimum(la, lb), np.maximum(la, lb)
        if not (open_ := lo != hi).any():
            break
        np.minimum.at(label, hi[open_], lo[open_])
        while not np.array_equal(up := label[label], label):
            label = up
        a, b = a[open_], b[open_]
    return label


def link_sorted(key: np.ndarray, fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between the distinct fingerprints that share a key; ``key`` is sorted."""
    n = len(key)
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    at = np.repeat(start, size)
    left, right = [], []
    sparse = np.repeat(size <= DENSE, size)
    for step in range(1, min(DENSE, int(size.max(initial=0)))):
        i = np.flatnonzero((np.arange(n) + step < at + np.repeat(size, size)) & sparse)
        i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= max_bits]
        left.append(i)
        right.append(i + step)
    for s, m in zip(start[size > DENSE], size[size > DENSE]):
        order = np.argsort(fp[s:s + m], kind="stable")
        group = fp[s:s + m][order]
        for x in range(65):                     # each pair of flipped bits once; x = 0 flips one at most
            for y in range(x + 1 if x else 0, 65):
                want = group ^ _FLIPS[x] ^ _FLIPS[y]
                j = np.minimum(np.searchsorted(group, want), m - 1)
                hit = np.flatnonzero(group[j] == want)
                left.append(s + order[hit])
                right.append(s + order[j[hit]])
    a = np.concatenate(left) if left else np.zeros(0, np.int64)
    b = np.concatenate(right) if right else np.zeros(0, np.int64)
    label = _forest(n, a, b)
    linked = np.flatnonzero(label != np.arange(n))
    return fp[label[linked]], fp[linked]


def _link_batches(batches):
    """Whole keys of a partition sorted by key; a key cut by a batch's end waits for the next batch."""
    key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def out(k, f):
        a, b = link_sorted(k, f)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for b in batches:
        key = np.concatenate((key, b.column(0).to_numpy()))
        fp = np.concatenate((fp, b.column(1).to_numpy().view(np.uint64)))
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield out(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
    if len(key):
        yield out(key, fp)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node: large-star / small-star rounds until nothing changes, each
    round written to the shared folder.  A hub costs no more than its links: minima are map-side combined."""
    edges, rounds = stored(links.filter("a <> b").select("a", "b").distinct(), "golay-edges"), 0
    seen = None
    while True:
        # Large star: every larger neighbour points to the smallest neighbour (or itself).
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: every smaller neighbour and the node itself point to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small_ = large.join(low, "u")
        nxt = small_.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small_.select("u", "m"))
        nxt = nxt.filter("u <> v").distinct()
        edges = stored(nxt.select(F.col("v").alias("a"), F.col("u").alias("b")), f"golay-star-{rounds}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        rounds += 1
        if state == seen:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = state


def rooted(nodes: DataFrame) -> DataFrame:
    """``nodes`` (a stored table, one row per fingerprint ``fp``) with the ``root`` of each one's component."""
    met = nodes.select("fp").mapInArrow(_emit_keys, "key long, fp long")
    n = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    links = (met.repartition(n, "key").sortWithinPartitions("key")
             .mapInArrow(_link_batches, "a long, b long"))
    root = components(links)
    return nodes.join(root, nodes.fp == root.node, "left").select(*nodes.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = SHINGLE,
                    seed: int = SEED) -> DataFrame:
    """(id, fp long, component_id): documents whose fingerprints are linked, directly or through
    others, by ``MAX_BITS`` differing bits or fewer; the component is named by its smallest id."""
    docs = stored(with_fingerprint(df, text_col, "fp", k, seed, [id_col]).toDF("id", "fp"), "golay-documents")
    named = rooted(stored(docs.groupBy("fp").agg(F.min("id").alias("low")), "golay-nodes"))
    label = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = named.join(label, "root").select("fp", "component_id")
    return docs.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, one per component: that with the smallest id (nulls last), of rows with the
    same id that with the smallest SHA-256 of its text, of rows equal in both any one."""
    digest = F.sha2(text_col, 256)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), digest.alias("digest"))
    docs = with_fingerprint(docs, "text", "fp", columns=["id", "digest"])
    low = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")).alias("low")
    nodes = stored(docs.groupBy("fp").agg(low), "golay-nodes")
    winners = rooted(nodes).groupBy("root").agg(F.min("low").alias("low")).select(
        F.col("low.id").alias("w_id"), F.col("low.digest").alias("w_digest"))
    own = free_name(df, "digest")
    marked = df.withColumn(own, digest)
    # A text has one fingerprint and so one component: id and text name the winning row.
    kept = marked.join(winners, marked[id_col].eqNullSafe(winners.w_id) & marked[own].eqNullSafe(winners.w_digest), "left_semi")
    return kept.dropDuplicates([id_col, own]).drop(own)
