"""Operator 2, quality classifier: a linear-chain conditional random field over lines.

Every line with a word is good or bad.  Its features (length, shares of character classes and word shapes,
repetition) and those of its two neighbours feed one linear score; a 2 x 2 table scores neighbouring
labels.  Forward-backward gives each line's probability of being good, and a document's score is their
mean weighted by line length, calibrated by a logistic curve (monotone, fitted on the same sample) so that
0.5 lies between the classes.

Fitting: at most ``SAMPLE`` labelled documents (those with the smallest id hashes of either class, up to
``SAMPLE_LINES`` lines each), whose lines take the document's label; maximum likelihood with an L2
penalty in numpy on the driver.  Only bounded tables reach the driver or are broadcast: the sample's ids,
its line features, the weights.  Scoring is one pass over the documents without a shuffle.

Defined results: null and empty texts have no line and get the sample's smoothed share of good documents
among those without lines; rows with the same id are scored each on their own text; without any label
every score is 0.5 for such texts and close to it otherwise; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (buffers, byte_values, covered, crc_bucket, gram_starts, mix64, on_workers, range_hash, slices, spans)
from .line_dedup import lines

SAMPLE = 4000           # labelled documents to fit on, half of them of either class where there are enough
SAMPLE_LINES = 256      # a document with more lines is scored, but not fitted on
STEPS, RATE, PENALTY = 250, 0.05, 1e-3
GRAM = 4

_BYTES = np.arange(256)


def _class(chars: str) -> np.ndarray:
    return np.isin(_BYTES, [ord(c) for c in chars])


_UPPER, _LOWER, _DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("abcdefghijklmnopqrstuvwxyz"), _class("0123456789")
_SYMBOL, _SHOUT, _STOP, _COMMA = _class("#*$%&|<>{}[]=_^~\\@+/"), _class("!?"), _class("."), _class(",;:")
_WIDE = _BYTES >= 0x80


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes) of each line with a word, and each text's first line (n+1 bounds)."""
    s, e, first = lines(data, offsets)
    ws, we, wfirst = spans(data, offsets)
    n = len(s)
    size = (e - s).astype(np.float64)

    def share(table):
        c = np.concatenate(([0], np.cumsum(table[data], dtype=np.int64)))
        return (c[e] - c[s]) / np.maximum(size, 1)

    w0, w1 = np.searchsorted(ws, s), np.searchsorted(ws, e)       # the words of each line
    words = np.maximum(w1 - w0, 1).astype(np.float64)

    def of_words(mask):
        c = np.concatenate(([0.0], np.cumsum(mask, dtype=np.float64)))
        return (c[w1] - c[w0]) / words

    length = we - ws
    last = data[we - 1] if len(we) else np.zeros(0, np.uint8)
    head = data[ws] if len(ws) else np.zeros(0, np.uint8)
    second = data[np.minimum(ws + 1, len(data) - 1)] if len(ws) else head
    values = byte_values(data)
    wh = range_hash(values, ws, we)
    doc_of_word = np.repeat(np.arange(len(offsets) - 1), np.diff(wfirst))
    p, pdoc = gram_starts(wfirst, GRAM)
    key = mix64(range_hash(wh, p, p + GRAM) + pdoc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    again = covered(p[count[inverse] > 1], GRAM, len(ws))
    doc = np.searchsorted(offsets, s, side="right") - 1
    lkey = mix64(range_hash(values, s, e) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, linv, lcount = np.unique(lkey, return_inverse=True, return_counts=True)
    same = np.zeros(len(ws))
    same[1:] = (wh[1:] == wh[:-1]) & (doc_of_word[1:] == doc_of_word[:-1])
    single = (length == 1) & (_SYMBOL[last] | _DIGIT[last])
    shares = [share(_UPPER), share(_DIGIT), share(_SYMBOL), share(_SHOUT), share(_STOP), share(_COMMA), share(_WIDE),
              of_words(_SYMBOL[last]), of_words(_SHOUT[last]), of_words(single), of_words(length <= 3), of_words(length >= 9),
              of_words(_UPPER[head]), of_words(_UPPER[head] & _UPPER[second]), of_words(again), of_words(same),
              (lcount[linv] > 1).astype(float) if n else np.zeros(0)]
    x = np.stack([np.log1p(size) / 5, np.log1p(w1 - w0) / 5, of_words(length) / 10, *shares,
                  *[np.minimum(1.0, 10 * v) for v in shares[1:4]]], axis=1) if n else np.zeros((0, N_FEATURES))
    return x, size, first


N_FEATURES = 23


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after it in its text, and three marks."""
    n = len(x)
    begins, ends = np.zeros(n, bool), np.zeros(n, bool)
    full = first[:-1] < first[1:]
    begins[first[:-1][full]], ends[first[1:][full] - 1] = True, True
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[begins], after[ends] = 0, 0
    return np.concatenate((x, before, after, begins[:, None], ends[:, None], np.ones((n, 1))), axis=1)


@dataclass
class Model:
    weights: np.ndarray     # per feature, for good against bad
    pairs: np.ndarray       # [label, next label]
    empty: float            # score of a text without lines
    slope: float = 1.0      # of the calibration, on the log-odds of the weighted mean
    shift: float = 0.0

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-odds of each line being good, given all lines of its text."""
        a, b, _ = forward_backward(x @ self.weights, first, self.pairs)
        return np.clip(a + b, -30, 30)

    def log_odds(self, x: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-odds of the length-weighted mean of a text's line probabilities; nan without lines."""
        good = size / (1 + np.exp(-self.marginals(x, first)))
        c, w = np.concatenate(([0], np.cumsum(good))), np.concatenate(([0], np.cumsum(size)))
        total, weight = c[first[1:]] - c[first[:-1]], w[first[1:]] - w[first[:-1]]
        mean = np.clip(total / np.maximum(weight, 1e-9), 1e-6, 1 - 1e-6)
        return np.where(weight > 0, np.log(mean / (1 - mean)), np.nan)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, size, first = line_features(data, offsets)
        if not len(x):
            return np.full(len(offsets) - 1, self.empty)
        odds = self.log_odds(with_neighbours(x, first), size, first)
        score = 1 / (1 + np.exp(-(self.slope * odds + self.shift)))
        return np.where(np.isnan(odds), self.empty, score)


def forward_backward(u: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log-odds of each line, and the order of texts (longest first) used.

    Texts step together, longest first, so the texts still running are always a prefix.
    """
    u = np.clip(u, -30, 30)
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    at, size = first[:-1][order], size[order]
    a, b = u.copy(), np.zeros_like(u)
    e = np.exp(pairs - pairs.max())
    longest = int(size[0]) if len(size) else 0
    running = np.searchsorted(-size, -np.arange(longest + 1), side="left")     # texts with more than t lines
    for t in range(1, longest):
        i = at[:running[t]] + t
        odds = np.exp(np.clip(a[i - 1], -30, 30))
        a[i] += np.log((e[1, 1] * odds + e[0, 1]) / (e[1, 0] * odds + e[0, 0]))
    for t in range(longest - 1, 0, -1):
        i = at[:running[t]] + t
        odds = np.exp(np.clip(u[i] + b[i], -30, 30))
        b[i - 1] = np.log((e[1, 1] * odds + e[1, 0]) / (e[0, 1] * odds + e[0, 0]))
    return a, b, order


def fit_crf(x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray, empty: float) -> Model:
    """Weights by Adam on the penalised likelihood of the labels ``y`` of the lines; ``weight`` per line
    (constant within a text) balances the texts."""
    theta, pairs = np.zeros(x.shape[1]), np.zeros((2, 2))
    n = max(weight.sum(), 1e-9)
    inside = np.ones(len(x), bool)                                   # lines that have a line before them
    inside[first[:-1][first[:-1] < first[1:]]] = False
    nxt = np.flatnonzero(inside)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[nxt - 1], y[nxt]), weight[nxt])
    m, v = np.zeros(len(theta) + 4), np.zeros(len(theta) + 4)
    for step in range(1, STEPS + 1):
        u = x @ theta
        a, b, _ = forward_backward(u, first, pairs)
        p = 1 / (1 + np.exp(-np.clip(a + b, -30, 30)))
        left = np.exp(np.clip(a[nxt - 1], -30, 30))
        right = np.exp(np.clip(u[nxt] + b[nxt], -30, 30))
        e = np.exp(pairs - pairs.max())
        joint = np.stack((np.full(len(nxt), e[0, 0]), e[0, 1] * right, e[1, 0] * left, e[1, 1] * left * right))
        joint = (joint / joint.sum(axis=0) * weight[nxt]).sum(axis=1).reshape(2, 2)
        g = np.concatenate((x.T @ (weight * (y - p)) / n - PENALTY * theta, ((seen - joint) / n - PENALTY * pairs).ravel()))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        theta += move[:-4]
        pairs += move[-4:].reshape(2, 2)
    return Model(theta, pairs, empty)


def calibrate(model: Model, odds: np.ndarray, y: np.ndarray) -> Model:
    """Fit slope and shift by penalised logistic regression (Newton steps)."""
    ok = ~np.isnan(odds)
    z, y = np.stack((odds[ok], np.ones(ok.sum())), axis=1), y[ok]
    b = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.5 * np.eye(2)
        b = b + np.linalg.solve(h, z.T @ (y - p) - 0.5 * (b - [1.0, 0.0]))
    return Model(model.weights, model.pairs, model.empty, max(float(b[0]), 0.1), float(b[1]))


def _feature_batches(batches):
    for b in batches:
        data, offsets = buffers(b.column(0))
        for i, j in slices(offsets):
            x, size, first = line_features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            sized = np.concatenate((x, size[:, None]), axis=1).astype("<f4")
            rows = [None if first[k + 1] - first[k] > SAMPLE_LINES else sized[first[k]:first[k + 1]].tobytes()
                    for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([b.column(1).slice(i, j - i), pa.array(rows, pa.binary())], names=["y", "x"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          folds: int = 5) -> Model:
    """Fit on labelled rows whose crc32(id as text) modulo ``folds`` is not 0."""
    on_workers(docs.sparkSession)
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (crc_bucket(id_col, folds) != 0))
    ids = None
    for y in (0, 1):
        part = (usable.filter(F.col(label_col) == y).select(F.col(id_col).alias("label_id"), F.lit(y).alias("y"))
                .orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE // 2))
        ids = part if ids is None else ids.unionByName(part)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), F.col("id") == F.col("label_id"))                            # at most SAMPLE ids
    rows = chosen.select("text", "y").mapInArrow(_feature_batches, "y int, x binary").filter("x is not null").limit(4 * SAMPLE)
    rows = sorted((r["y"], bytes(r["x"])) for r in rows.collect())
    xs = [np.frombuffer(x, "<f4").reshape(-1, N_FEATURES + 1).astype(np.float64) for _, x in rows]
    ys = np.array([y for y, _ in rows], np.int64)
    sizes = np.array([len(x) for x in xs], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    prior = (ys.sum() + 1) / (len(ys) + 2)
    empty = float((ys[sizes == 0].sum() + prior) / ((sizes == 0).sum() + 1))
    if not sizes.sum():
        return Model(np.zeros(3 * N_FEATURES + 3), np.zeros((2, 2)), empty)
    lines_ = np.concatenate(xs)
    x = with_neighbours(lines_[:, :-1], first)
    per_text = 1 / np.maximum(sizes, 1) ** 0.5
    model = fit_crf(x, first, np.repeat(ys, sizes), np.repeat(per_text, sizes), empty)
    return calibrate(model, model.log_odds(x, lines_[:, -1], first), ys)


def score(df: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the quality score of every text (a pass without a shuffle; columns keep their values)."""
    on_workers(df.sparkSession)
    columns = df.columns
    n = len(columns)
    inner = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col(text_col).alias("t"))
    weights = model

    def add(batches):
        for b in batches:
            data, offsets = buffers(b.column(n))
            made = [weights.scores(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in slices(offsets)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(np.concatenate(made) if made else np.zeros(0))],
                                             names=[*b.schema.names[:n], "score"])

    return inner.mapInArrow(add, inner.drop("t").schema.add("score", "double")).toDF(*columns, out)
