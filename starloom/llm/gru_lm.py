"""Operator 5, language-model scoring: a gated recurrent network in numpy.

Tokens are lower-cased words and one end.  All training words of the corpus are counted (pre-aggregated
per batch, then map-side combined).  The network's vocabulary is the ``MODEL_WORDS`` most frequent words
and ``TAILS`` groups that share the last two bytes' hash and hold all other words; a word of a group has
the group's probability times its smoothed share of the group's count, so every text has a probability.
Output is a softmax over ``CLASSES`` classes times one within the class.

Training: truncated backpropagation (windows of ``SPAN`` tokens, state carried over within stretches of
``STRETCH``, so that a very long text fills many lanes instead of running alone) with Adam on all training documents.  Their token ids are stored, dealt to files of about ``TASK_TOKENS`` tokens and to ``ROUNDS``
rounds by hash.  In each round tasks train in parallel from common weights on the round's documents, one slice
of ``SLICE_TOKENS`` after another, then an aggregate averages the weights and Adam's moments; after the last
round every training document has been trained on once.  Scoring carries the state across windows from a
document's first token to its end; documents run side by side in lanes.

Counts of the ``HEAD`` most frequent words at most are broadcast; all other tokens find their counts by a
shuffle join on the word's 64-bit hash.

Defined results: a null text counts as empty and is one end token; rows with the same id are scored each
on their own; no training rows give counts of zero and the uniform start of the network; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, buffers, crc_bucket, mix64, on_workers, slices, spans, stored, text_hash

HEAD = 1 << 18
COUNT_WORDS = 2_000_000         # entries that a counting task gathers before it merges and sends them on
CLASSES, PER_CLASS = 64, 64
TAILS = 256                     # the last byte of a word's hash
MODEL_WORDS = CLASSES * PER_CLASS - TAILS - 1       # and the end token
HIDDEN, EMBED = 16, 16
SPAN, LANES = 16, 192
STRETCH = 512                   # tokens over which training carries the state (scoring: the whole text)
TASK_TOKENS, ROUNDS = 1_000_000, 4
SLICE_TOKENS = 1_000_000        # tokens that a training task holds at once
SCORE_SPAN, SCORE_LANES, SCORE_BYTES = 64, 256, 6 << 20
HASH_BYTES, COUNT_BYTES = 1 << 17, 4 << 20
LAST = np.uint64(TAILS - 1)
END = np.uint64(1)                                  # the end token's place among word hashes


# -- Words --------------------------------------------------------------------------------------------

def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token (each text's words, then its end); n+1 bounds of the texts.  The last eight bits
    of a word's hash are its tail group, from the word's last two bytes."""
    s, e, first = spans(data, offsets)
    h = text_hash(data, s, e, lower=True)
    if len(e):
        a = LOWER[data[e - 1]].astype(np.uint64)
        b = np.where(e - s > 1, LOWER[data[np.maximum(e - 2, 0)]], 0).astype(np.uint64)
        h = h & ~LAST | mix64(a + b * np.uint64(256) + np.uint64(7)) & LAST
    return np.insert(h, first[1:], END), first + np.arange(len(offsets))


def hashed_batch(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``hashed_words`` of many texts, in slices, so that the bytes' hashing arrays stay in a core's cache."""
    parts = [hashed_words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in slices(offsets, HASH_BYTES)]
    sizes = np.concatenate([np.diff(x[1]) for x in parts])
    return np.concatenate([x[0] for x in parts]), np.concatenate(([0], np.cumsum(sizes)))


def _count_batches(batches):
    def merged(parts):
        h, c = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(np.add.reduceat(c, at))], names=["word", "n"])

    parts, held = [], 0
    for b in batches:
        data, offsets = buffers(b.column(0))
        for i, j in slices(offsets, COUNT_BYTES):
            u, c = np.unique(hashed_batch(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])[0], return_counts=True)
            parts.append((u, c))
            held += len(u)
            if held > COUNT_WORDS:
                yield merged(parts)
                parts, held = [], 0
    if parts:
        yield merged(parts)


def count_words(texts: DataFrame) -> DataFrame:
    """(word hash, n) over a one-column frame of texts."""
    return texts.mapInArrow(_count_batches, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


# -- The network --------------------------------------------------------------------------------------

def _sizes() -> list[tuple[str, tuple[int, ...]]]:
    v = CLASSES * PER_CLASS
    return [("embed", (v, EMBED)), ("inp", (EMBED, 3 * HIDDEN)), ("rec", (HIDDEN, 3 * HIDDEN)), ("bias", (3 * HIDDEN,)),
            ("cls", (HIDDEN, CLASSES)), ("cls_bias", (CLASSES,)), ("out", (CLASSES, HIDDEN, PER_CLASS)),
            ("out_bias", (CLASSES, PER_CLASS))]


N_WEIGHTS = sum(int(np.prod(s)) for _, s in _sizes())


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _sizes():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def start_weights(counts: np.ndarray, seed: int = 1) -> np.ndarray:
    """Small random weights; output biases such that the untrained network is the unigram model."""
    rng = np.random.default_rng(seed)
    flat = (rng.standard_normal(N_WEIGHTS) * 0.08).astype(np.float32)
    w = unpack(flat)
    grid = (counts + 0.5).reshape(CLASSES, PER_CLASS)
    w["bias"][:] = 0
    w["out"][:] *= 0.2
    w["cls"][:] *= 0.2
    w["cls_bias"][:] = np.log(grid.sum(axis=1) / grid.sum())
    w["out_bias"][:] = np.log(grid / grid.sum(axis=1, keepdims=True))
    return flat


def _half() -> np.ndarray:
    """Factors of the three gates' inputs: sigmoid(x) = (tanh(x / 2) + 1) / 2."""
    return np.where(np.arange(3 * HIDDEN) < 2 * HIDDEN, 0.5, 1).astype(np.float32)


def _softmax_at(logits: np.ndarray, at: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability at ``at`` and, if ``whole``, all probabilities (in place)."""
    if logits.size and (logits.max() > 80 or logits.min() < -80):       # else exp can neither overflow nor vanish
        logits -= logits.max(axis=1, keepdims=True)
    own = logits[np.arange(len(at)), at]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    if whole:
        logits *= (1 / total)[:, None]
    return own - np.log(total), logits


def log_probability(w: dict[str, np.ndarray], states: np.ndarray, tokens: np.ndarray, grad: dict | None = None):
    """Natural log-probability of each token given the state before it; with ``grad``, also adds the
    gradient of their negative sum to it and returns the gradient with respect to the states."""
    cls, word = tokens // PER_CLASS, tokens % PER_CLASS
    logits = states @ w["cls"]
    logits += w["cls_bias"]
    got, p = _softmax_at(logits, cls, grad is not None)
    back = None
    if grad is not None:
        p[np.arange(len(cls)), cls] -= 1
        grad["cls"] += states.T @ p
        grad["cls_bias"] += np.ones(len(p), p.dtype) @ p
        back = p @ w["cls"].T
    order = np.argsort(cls.astype(np.int8), kind="stable")          # one byte: a radix sort
    cls, word, h = cls[order], word[order], states[order]
    cuts = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
    some = [(c, slice(i, j)) for c, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]
    logits = np.empty((len(cls), PER_CLASS), np.result_type(h, w["out"]))
    for c, rows in some:
        part = np.matmul(h[rows], w["out"][c], out=logits[rows])
        part += w["out_bias"][c]
    own, p = _softmax_at(logits, word, grad is not None)
    got[order] += own
    if grad is not None:
        p[np.arange(len(cls)), word] -= 1
        more = np.empty_like(h)
        with_one = np.concatenate((h, np.ones((len(h), 1), h.dtype)), axis=1).T
        for c, rows in some:
            both = with_one[:, rows] @ p[rows]
            grad["out"][c] += both[:-1]
            grad["out_bias"][c] += both[-1]
            np.matmul(p[rows], w["out"][c].T, out=more[rows])
        back[order] += more
    return got, back


def stretches(bounds: np.ndarray, most: int) -> np.ndarray:
    """The bounds of texts cut into stretches of at most ``most`` tokens."""
    size = np.diff(bounds)
    k = np.maximum(1, -(-size // most))
    inner = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
    return np.append(np.repeat(bounds[:-1], k) + inner * most, bounds[-1:])


def lanes_of(bounds: np.ndarray, lanes: int) -> list[list[int]]:
    """Texts dealt to lanes, longest first to the shortest lane; longest lane first."""
    size = np.diff(bounds)
    heap = [(0, k) for k in range(min(lanes, len(size)))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-size, kind="stable").tolist():
        n, k = heapq.heappop(heap)
        out[k].append(d)
        heapq.heappush(heap, (n + int(size[d]), k))
    return sorted(out, key=lambda ds: -sum(int(size[d]) for d in ds))


def _laid_out(tokens: np.ndarray, bounds: np.ndarray, lanes: int):
    """Tokens in lanes, one after another: flat sequence, lane starts and lengths, text begins, owners."""
    dealt = lanes_of(bounds, lanes)
    order = np.array([d for ds in dealt for d in ds], np.int64)
    size = np.diff(bounds)[order]
    lane_len = np.array([sum(int(bounds[d + 1] - bounds[d]) for d in ds) for ds in dealt], np.int64)
    after = np.cumsum(size)
    begin = after - size
    seq = np.repeat(bounds[order] - begin, size) + np.arange(int(size.sum()))
    fresh = np.zeros(len(seq), bool)
    fresh[begin] = True
    return tokens[seq], np.cumsum(lane_len) - lane_len, lane_len, fresh, np.repeat(order, size)


def score_texts(flat: np.ndarray, tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log-probability of each text (its state carried over windows from first token to end)."""
    w = unpack(flat)
    two = 2 * HIDDEN
    half = _half()
    table, rec = ((w["embed"] @ w["inp"] + w["bias"]) * half).astype(np.float32), w["rec"] * half
    seq, start, length, fresh, owner = _laid_out(tokens, bounds, SCORE_LANES)
    out = np.zeros(len(bounds) - 1)
    h = np.zeros((len(start), HIDDEN), np.float32)
    for t0 in range(0, int(length.max(initial=0)), SCORE_SPAN):
        live = int(np.searchsorted(-length, -t0, side="left"))
        steps = int(min(SCORE_SPAN, length[0] - t0))
        states = np.empty((steps, live, HIDDEN), np.float32)
        place = start[:live] + t0 + np.arange(steps)[:, None]
        valid = np.arange(t0, t0 + steps)[:, None] < length[:live]
        place = np.where(valid, place, 0)
        tok, new = seq[place], fresh[place] & valid
        x, any_new = table[tok], new.any(axis=1).tolist()
        hh = h[:live]
        for t in range(steps):
            if any_new[t]:
                hh = hh * ~new[t][:, None]
            states[t] = hh
            r, xt = hh @ rec, x[t]
            zr = r[:, :two] + xt[:, :two]
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            n = zr[:, HIDDEN:] * r[:, two:]
            n += xt[:, two:]
            np.tanh(n, out=n)
            hh = hh - n
            hh *= zr[:, :HIDDEN]
            hh += n
        h[:live] = hh
        got, _ = log_probability(w, states[valid], tok[valid])
        out += np.bincount(owner[place[valid]], weights=got, minlength=len(out))
    return out


@dataclass
class Adam:
    """Adam's moments and number of steps, carried over slices and rounds."""
    m: np.ndarray
    v: np.ndarray
    step: int = 0


def add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``out[at] += rows``, with repeats."""
    order = np.argsort(at.astype(np.int16), kind="stable")         # two bytes hold a token: a radix sort
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    out[at[first]] += np.add.reduceat(rows[order], first, axis=0)


def train(flat: np.ndarray, tokens: np.ndarray, bounds: np.ndarray, rate: float = 0.01, adam: Adam | None = None,
          part: tuple[float, float] = (0.0, 1.0)) -> np.ndarray:
    """One pass of truncated backpropagation with Adam over the texts; the new weights.  ``adam`` is
    carried on in place; ``part`` is the part of the whole training, for the falling rate."""
    flat = flat.copy()
    w = unpack(flat)
    g_flat = np.zeros_like(flat)
    g = unpack(g_flat)
    adam = adam or Adam(np.zeros_like(flat), np.zeros_like(flat))
    m, v, a, b = adam.m, adam.v, np.empty_like(flat), np.empty_like(flat)
    seq, start, length, fresh, _ = _laid_out(tokens, stretches(bounds, STRETCH), LANES)
    h = np.zeros((len(start), HIDDEN), np.float32)
    two, half = 2 * HIDDEN, _half()
    total = int(length.max(initial=0))
    for t0 in range(0, total, SPAN):
        live = int(np.searchsorted(-length, -t0, side="left"))
        steps = int(min(SPAN, length[0] - t0))
        place = start[:live] + t0 + np.arange(steps)[:, None]
        valid = np.arange(t0, t0 + steps)[:, None] < length[:live]
        place = np.where(valid, place, 0)
        tok, old = seq[place], ~(fresh[place] & valid)[:, :, None]
        g_flat[:] = 0
        emb = w["embed"][tok.ravel()]
        x = ((emb @ w["inp"] + w["bias"]) * half).reshape(steps, live, -1)
        rec = w["rec"] * half
        hh = h[:live]
        states, zrs, ns, rns = (np.empty((steps, live, k), np.float32) for k in (HIDDEN, two, HIDDEN, HIDDEN))
        for t in range(steps):
            state, zr, n = np.multiply(hh, old[t], out=states[t]), zrs[t], ns[t]
            r = state @ rec
            np.add(x[t, :, :two], r[:, :two], out=zr)
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            rns[t] = r[:, two:]
            np.multiply(zr[:, HIDDEN:], rns[t], out=n)
            n += x[t, :, two:]
            np.tanh(n, out=n)
            hh = state - n
            hh *= zr[:, :HIDDEN]
            hh += n
        h = hh
        if valid.all():
            d_states = log_probability(w, states.reshape(-1, HIDDEN), tok.ravel(), g)[1].reshape(states.shape)
        else:
            d_states = np.zeros_like(states)
            d_states[valid] = log_probability(w, states[valid], tok[valid], g)[1]
        carry = np.zeros((live, HIDDEN), np.float32)
        # What of the backward steps doesn't depend on the carried gradient, for the window at once.
        z, r = zrs[:, :, :HIDDEN], zrs[:, :, HIDDEN:]
        to_n = (1 - z) * (1 - ns * ns)
        to_z = (states - ns) * z * (1 - z)
        to_r = rns * r * (1 - r)
        drec = np.empty((steps, live, 3 * HIDDEN), np.float32)
        dn = np.empty_like(states)
        rec_t = np.ascontiguousarray(w["rec"].T)
        for t in range(steps - 1, -1, -1):
            d = np.multiply(carry, to_n[t], out=dn[t])
            at = drec[t]
            np.multiply(carry, to_z[t], out=at[:, :HIDDEN])
            np.multiply(d, to_r[t], out=at[:, HIDDEN:two])
            np.multiply(d, r[t], out=at[:, two:])
            carry = (carry * z[t] + at @ rec_t + d_states[t]) * old[t]
        drec = drec.reshape(-1, 3 * HIDDEN)
        dx = drec.copy()
        dx[:, two:] = dn.reshape(-1, HIDDEN)
        g["inp"] += emb.T @ dx
        g["bias"] += dx.sum(axis=0)
        g["rec"] += states.reshape(-1, HIDDEN).T @ drec
        add_rows(g["embed"], tok.ravel(), dx @ w["inp"].T)
        g_flat /= max(1, int(valid.sum()))
        norm = float(np.sqrt(np.dot(g_flat, g_flat)))
        if norm > 1:
            g_flat /= norm
        adam.step += 1
        m *= 0.9
        m += np.multiply(g_flat, 0.1, out=a)
        v *= 0.99
        v += np.multiply(np.multiply(g_flat, g_flat, out=a), 0.01, out=a)
        now = rate * max(0.05, 1 - part[0] - (part[1] - part[0]) * t0 / max(total, 1))
        np.sqrt(np.multiply(v, 1 / (1 - 0.99 ** adam.step), out=a), out=a)
        a += 1e-8
        flat -= np.divide(np.multiply(m, now / (1 - 0.9 ** adam.step), out=b), a, out=b)
    return flat


# -- The corpus ---------------------------------------------------------------------------------------

@dataclass
class Vocabulary:
    """What tasks need to know: bounded by ``HEAD`` words and the network's size."""
    hashes: np.ndarray          # frequent words, sorted
    counts: np.ndarray
    token: np.ndarray           # the network's token of each, -1 where it is its tail group
    tail_mass: np.ndarray       # per tail group: counts + words + 1
    n: int
    v: int

    def __post_init__(self):
        """Where the words of each slot (the first 20 bits of a hash) begin among the sorted hashes."""
        self.slot = np.searchsorted(self.hashes, np.arange((1 << 20) + 1, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        self.slot[-1] = len(self.hashes)

    def look_up(self, hashes: np.ndarray):
        """(place in the head or -1, the network's token) of each word."""
        tails = MODEL_WORDS + 1 + (hashes & LAST).astype(np.int64)
        if not len(self.hashes):
            return np.full(len(hashes), -1), tails
        slot = (hashes >> np.uint64(44)).astype(np.int32)
        at = np.minimum(self.slot[slot], len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        # A slot's other words: most slots hold one at most.
        more = np.flatnonzero(~known)
        more = more[self.slot[slot[more] + 1] - at[more] > 1]
        at[more] = np.minimum(np.searchsorted(self.hashes, hashes[more]), len(self.hashes) - 1)
        known[more] = self.hashes[at[more]] == hashes[more]
        token = np.where(known, self.token[at], -1)
        return np.where(known, at, -1), np.where(token >= 0, token, tails)


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """The bounded part of the stored counts, and the counts of the network's tokens."""
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # A count so high that at most HEAD words reach it, from a histogram of at most 64 * 64 steps.
    level = F.floor(F.log2("n") * 64).cast("int")
    steps = sorted(counts.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True)
    reach, least = 0, None
    for r in steps:
        if reach + r["k"] > HEAD:
            break
        reach, least = reach + r["k"], r["l"]
    head = counts.filter(level >= least).toArrow() if least is not None else pa.table({"word": [], "n": []})
    hashes = head.column("word").to_numpy().astype(np.int64).view(np.uint64)
    c = head.column("n").to_numpy().astype(np.int64)
    order = np.lexsort((hashes, -c))
    token = np.full(len(hashes), -1, np.int64)
    frequent = order[hashes[order] != END][:MODEL_WORDS]
    token[frequent] = np.arange(1, len(frequent) + 1)
    token[hashes == END] = 0
    # Tail groups: all words that are not tokens of their own.
    own = counts.sparkSession.createDataFrame(pa.table({"word": pa.array(hashes[token >= 0].view(np.int64), pa.int64())}))
    groups = counts.join(F.broadcast(own), "word", "left_anti").groupBy(F.col("word").bitwiseAND(TAILS - 1).alias("tail")).agg(     # MODEL_WORDS + 1 rows at most
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()
    tail_n, tail_k = np.zeros(TAILS), np.zeros(TAILS)
    for r in groups:
        tail_n[r["tail"]], tail_k[r["tail"]] = r["n"], r["k"]
    weight = np.zeros(CLASSES * PER_CLASS)
    weight[token[token >= 0]] = c[token >= 0]
    weight[MODEL_WORDS + 1:] = tail_n
    by = np.argsort(hashes)
    return Vocabulary(hashes[by], c[by], token[by], tail_n + tail_k + 1, int(n), int(v)), weight


def token_ids(texts: DataFrame, words: Broadcast[Vocabulary]) -> DataFrame:
    """(order, tokens) of every row of ``texts`` (columns order, text): the network's tokens."""
    def run(batches):
        for b in batches:
            data, offsets = buffers(b.column(1))
            for i, j in slices(offsets):
                h, first = hashed_batch(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                tokens = pa.array(words.value.look_up(h)[1].astype(np.int16))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), tokens)],
                                                 names=["order", "tokens"])

    return texts.mapInArrow(run, "order long, tokens array<short>")


def token_slices(batches, most: int = SLICE_TOKENS):
    """(tokens, bounds) of consecutive rows, about ``most`` tokens at once (a longer row alone)."""
    held, sizes, n = [], [], 0
    for b in batches:
        col = b.column(0)
        size = np.diff(col.offsets.to_numpy())
        flat, ends = col.flatten().to_numpy(), np.cumsum(size)
        i = 0
        while i < len(size):
            done = int(ends[i - 1]) if i else 0
            j = max(int(np.searchsorted(ends, done + most - n, side="right")), i if held else i + 1)
            if j > i:
                held.append(flat[done:ends[j - 1]])
                sizes.append(size[i:j])
                n += int(ends[j - 1]) - done
            if j < len(size):
                yield np.concatenate(held).astype(np.int64), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
                held, sizes, n = [], [], 0
            i = j
    if held:
        yield np.concatenate(held).astype(np.int64), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))


def fit(texts: DataFrame, words: Vocabulary, weight: np.ndarray) -> np.ndarray:
    """Weights of the network, trained on all ``texts`` (columns order, text) in each round."""
    flat = start_weights(weight)
    if not words.n:
        return flat
    spark = texts.sparkSession
    tasks = max(2, round(words.n / TASK_TOKENS))
    ids = token_ids(texts, spark.sparkContext.broadcast(words))
    turn = F.pmod(F.xxhash64(F.lit(6), "order"), F.lit(ROUNDS)).alias("turn")
    dealt = stored(ids.repartition(tasks, "order").sortWithinPartitions("order").select("tokens", turn), "gru-tokens")
    share = words.n / ROUNDS / max(1, dealt.rdd.getNumPartitions())         # expected tokens of a task in a round
    adam = Adam(np.zeros_like(flat), np.zeros_like(flat))
    for k in range(ROUNDS):
        now = spark.sparkContext.broadcast((flat, adam, k))

        def run(batches, now=now):
            flat, adam, k = now.value
            adam = Adam(adam.m.copy(), adam.v.copy(), adam.step)
            n = 0
            for tokens, bounds in token_slices(batches):
                part = tuple((k + min(1.0, x / share)) / ROUNDS for x in (n, n + len(tokens)))
                flat = train(flat, tokens, bounds, adam=adam, part=part)
                n += len(tokens)
            if n:
                size = len(flat)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(size, dtype=np.int32)), *[pa.array(x.astype(np.float64) * n) for x in (flat, adam.m, adam.v)],
                     pa.array(np.full(size, float(n))), pa.array(np.full(size, adam.step, np.int32))], names=["i", "x", "m", "v", "n", "step"])

        got = dealt.filter(F.col("turn") == k).select("tokens").mapInArrow(run, "i int, x double, m double, v double, n double, step int").groupBy("i").agg(
            *[(F.sum(c) / F.sum("n")).alias(c) for c in ("x", "m", "v")], F.max("step").alias("step")).toArrow()    # N_WEIGHTS rows
        at = got.column("i").to_numpy()
        flat, m, v = (np.zeros(N_WEIGHTS, np.float32) for _ in range(3))
        for own, c in ((flat, "x"), (m, "m"), (v, "v")):
            own[at] = got.column(c).to_numpy().astype(np.float32)
        adam = Adam(m, v, int(got.column("step").to_numpy().max()))
    return flat


def language_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, folds: int = 7, held: int = 2) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): log10 probabilities of every
    text under the add-one unigram model and under the network, both learnt from the rows whose crc32(id
    as text) modulo ``folds`` is not ``held``."""
    spark = df.sparkSession
    on_workers(spark)
    kind = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (crc_bucket(id_col, folds) == held).alias("held"))
    training = docs.filter(~F.col("held"))
    counts = stored(count_words(training.select("text")), "gru-counts")
    words, weight = vocabulary(counts)
    texts = training.select(F.xxhash64(F.lit(5), "id", F.length("text")).alias("order"), "text")
    flat = fit(texts, words, weight)
    shared, net = spark.sparkContext.broadcast(words), spark.sparkContext.broadcast(flat)

    def run(batches):
        words, flat = shared.value, net.value
        log_mass, log_count = np.log10(words.tail_mass), np.log10(words.counts + 1.0)
        part, row = TaskContext.get().partitionId() << 33, 0
        for b in batches:
            data, offsets = buffers(b.column(1))
            for i, j in slices(offsets, SCORE_BYTES):
                h, first = hashed_batch(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                at, token = words.look_up(h)
                n = j - i
                doc = np.repeat(np.arange(n), np.diff(first))
                frequent = at >= 0
                score = score_texts(flat, token, first) / np.log(10)
                grouped = token > MODEL_WORDS
                score -= np.bincount(doc[grouped], weights=log_mass[token[grouped] - MODEL_WORDS - 1], minlength=n)
                log_c = log_count[at[frequent]] if frequent.any() else np.zeros(0)
                base = np.bincount(doc[frequent], weights=log_c, minlength=n)
                here = grouped[frequent]
                score += np.bincount(doc[frequent][here], weights=log_c[here], minlength=n)
                # Tokens whose counts are not here: each text's, with repeats; they meet their counts by join.
                far = np.flatnonzero(~frequent)
                far_bounds = np.searchsorted(far, first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part + row + np.arange(n)), b.column(0).slice(i, n), b.column(2).slice(i, n), pa.array(np.diff(first)),
                     pa.array(np.bincount(doc[frequent], minlength=n)), pa.array(base), pa.array(score),
                     pa.ListArray.from_arrays(pa.array(far_bounds.astype(np.int32)), pa.array(h[far].view(np.int64)))],
                    names=["row", "id", "held", "n_tokens", "n_known", "base", "score", "far"])
                row += n

    scored = stored(docs.select("id", "text", "held").mapInArrow(
        run, f"row long, id {kind}, held boolean, n_tokens long, n_known long, base double, score double, far array<long>"), "gru-scored")
    far = scored.select("row", F.explode("far").alias("word"))
    found = far.join(counts.select("word", "n"), "word").groupBy("row").agg(
        F.sum(F.log10(F.col("n") + 1)).alias("more"), F.count(F.lit(1)).alias("known"))
    out = scored.drop("far").join(found, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    log_all = F.log10(F.lit(float(words.n + words.v + 1)))
    return out.select(F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens",
                      (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(words.n).cast("long").alias("train_tokens"),
                      (F.col("base") + more - F.col("n_tokens") * log_all).alias("base_score"), (F.col("score") + more).alias("score"))
