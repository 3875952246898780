"""Toxicity by weak supervision.

* **Vocabulary.** Terms are words, beginnings of words (their first 4 to 7 bytes), and beginnings and inner parts (4 to
  7 bytes anywhere in a word) that are dense in a text: different words there have it, and at least one word in
  ``DENSE`` (ASCII letters are lower-cased; a word is a maximal run of letters and non-ASCII bytes).  Those that labelled training texts link to toxicity most
  strongly (likelihood ratio) are counted on Spark; at most ``VOCABULARY`` of them leave it.  Further terms are words of
  fewer than 4 bytes, pairs of neighbouring words, words that are frequent in a text, and tokens with signs or
  digits among their letters; words in disguise (other signs for letters, letters apart, stretched or of other
  alphabets) also count as the words and beginnings that they stand for.  At most ``OTHERS`` of the further terms leave Spark.
* **Voters.** Lexicon voters are terms picked so that every toxic training text is covered twice where it can be;
  pattern voters look for masked words, stretched letters, shouting and rows of exclamation marks.  The given
  label is one more voter: it may be wrong.
* **Label model.** A generative model of all votes: a hidden class, and for each voter its rates in either class
  given at most one other voter, along the maximum spanning tree of the voters' conditional mutual
  information (so voters that repeat each other count once).  Rates, tree and class are estimated by
  expectation maximisation; ``accuracies`` and ``correlations`` of the model tell what it found.
* **Classifier.** A sparse logistic regression over vocabulary and patterns learns the posterior labels; its
  score is one pass over whole texts, without a shuffle.

Training reads a bounded sample: at most ``SAMPLE`` labelled rows of the training folds, half of them toxic, those
with the smallest hashes of their ids, with texts of at most ``SAMPLE_BYTES``; where an id has several texts, the one
with the smallest hash.  Class weights undo the balance for the label model; in the classifier both classes weigh the
same, so a score is the chance among as many toxic as clean texts, and one or two terms of the lexicon are enough where
toxic texts are rare.  Scores are of all rows and whole texts.

Defined results: a null or word-less text scores as one without any term; equal texts score alike, whatever their ids;
a null id is no training row; labels other than 0 and 1 are ignored; without labels every score is 0.5 and
without a toxic label near 0; an empty table gives an empty one; other columns keep names and values.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, buffers, byte_values, crc_bucket, free_name, mix64, on_workers, per_text, range_hash, slices, spans, stored

SAMPLE, SAMPLE_BYTES = 8000, 1 << 15
VOCABULARY, OTHERS, VOTERS = 1024, 512, 48
#: Toxic training texts that a term must be in.
LEAST_TEXTS = 2
PREFIXES = (4, 5, 6, 7)
DENSE = 200
#: Inner parts have this in their kind.
_INNER = 0x10
PATTERNS = ("masked_word", "stretched_letters", "shouting", "exclamations")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 256)]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A"):ord("Z") + 1] = True
_MASK = np.zeros(256, bool)
_MASK[[ord(c) for c in "*#@$%"]] = True
_TEXT = np.where(_LETTER, LOWER, np.uint8(0x20)).astype(np.uint8)


#: Kinds of the terms that are hashes.
_WORD, _SHORT, _PAIR, _OFTEN, _TOKEN = 0xFF, 0xF8, 0xF9, 0xFA, 0xFB
_HASHED = {_WORD: "word", _SHORT: "short word", _PAIR: "pair", _OFTEN: "frequent word", _TOKEN: "token"}
_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in ".,;:!?()[]{}'\"-"]] = True
_SIGNS = str.maketrans("013457@$!|+¡€абвеікмнорстухѕјαεικνορτυχ", "oieastasiitieabbeikmhopctyxsjaeikvoptux")


def terms(data: np.ndarray, offsets: np.ndarray, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the words, beginnings and inner parts in all texts (of inner parts, only those in the sorted codes
    ``base`` if given), each one's text and word, and the words of each text; repeats included.

    The top byte of a code tells its kind; parts and short words are spelt out in the others, a word of
    more than seven bytes is a hash.
    """
    plain = _TEXT[data]
    s, e, first = spans(plain, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    size = e - s
    long_enough = size >= PREFIXES[0]
    s, e, text, size = s[long_enough], e[long_enough], text[long_enough], size[long_enough]
    starts, head, word = [], np.zeros(len(s), np.uint64), np.zeros(len(s), np.uint64)
    wide = np.append(plain, np.zeros(8, np.uint8)).astype(np.uint64)
    for k in range(PREFIXES[-1]):
        here = size > k
        head[here] |= wide[s[here] + k] << np.uint64(8 * k)
        if k + 1 in PREFIXES:
            starts.append((here, head[here] | np.uint64((k + 1) << 56)))
            short = size == k + 1
            word[short] = head[short] | np.uint64((0x80 | k + 1) << 56)
    many = size > PREFIXES[-1]
    if many.any():
        word[many] = _kind(range_hash(byte_values(plain), s[many], e[many]), _WORD)
    codes, at = _inner(wide, s, e, base)
    return (np.concatenate([word, *[c for _, c in starts], codes]), np.concatenate([text, *[text[h] for h, _ in starts], text[at]]),
            np.concatenate([word, *[word[h] for h, _ in starts], word[at]]), np.diff(first))


def _inner(wide: np.ndarray, s: np.ndarray, e: np.ndarray, base: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the parts of words from ``s`` to ``e``, and each one's word."""
    out, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    kinds = range(PREFIXES[0], PREFIXES[-1] + 1)
    if base is not None:
        kinds = [k for k in kinds if (base >> np.uint64(56) == (_INNER | k)).any()]
    if len(kinds):
        n = len(wide) - 8
        left = np.zeros(n + 1, np.int32)                    # bytes of a word from here on
        size = e - s
        at = np.repeat(s - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        of = np.repeat(np.arange(len(s)), size)
        left[at] = e[of] - at
        code = np.zeros(n, np.uint64)
        for k in range(kinds[-1]):
            code |= wide[k:n + k] << np.uint64(8 * k)
            if k + 1 not in kinds:
                continue
            fits = left[at] > k
            here = code[at[fits]] | np.uint64((_INNER | k + 1) << 56)
            whose = of[fits]
            if base is not None:
                known = base[base >> np.uint64(56) == (_INNER | k + 1)]
                maybe = np.zeros(1 << 16, bool)
                maybe[_short(known)] = True
                likely = maybe[_short(here)]
                here, whose = here[likely], whose[likely]
                hit, _ = _place(here, known)
                here, whose = here[hit], whose[hit]
            out.append(here)
            owner.append(whose)
    return np.concatenate(out), np.concatenate(owner)


def _short(codes: np.ndarray) -> np.ndarray:
    """Sixteen mixed bits of every code."""
    return (codes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64)


_DENSE_BIT = np.uint64(0x40 << 56)


def in_texts(codes: np.ndarray, text: np.ndarray, word: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, text), each pair once, with those of dense beginnings and inner parts after the others."""
    order = np.lexsort((word, codes, text))
    codes, text, word = codes[order], text[order], word[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(codes)))
    other = np.zeros(len(codes), np.int64)
    other[1:] = (word[1:] != word[:-1]) & ~new[1:]
    varied = np.add.reduceat(other, at) > 0 if len(at) else np.zeros(0, bool)
    codes, text = codes[at], text[at]
    dense = (codes >> np.uint64(56) < 0x40) & varied & (times * DENSE >= n_words[text])
    alone = codes >> np.uint64(60) != _INNER >> 4           # an inner part is a term only where it is dense
    return np.concatenate((codes[alone], codes[dense] | _DENSE_BIT)), np.concatenate((text[alone], text[dense]))


def _kind(hashes: np.ndarray, kind: int) -> np.ndarray:
    return hashes >> np.uint64(8) | np.uint64(kind << 56)


def other_terms(data: np.ndarray, offsets: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(code, text), each pair once, of short words, pairs of neighbours, frequent words, tokens with signs, and what
    words in disguise stand for (only those in the sorted codes ``known`` if given)."""
    plain = _TEXT[data]
    s, e, first = spans(plain, offsets)
    text, n_words = np.repeat(np.arange(len(offsets) - 1), np.diff(first)), np.diff(first)
    whole = range_hash(byte_values(plain), s, e)
    short = e - s < PREFIXES[0]
    beside = np.flatnonzero(text[1:] == text[:-1])
    pair = whole[beside] * np.uint64(0x9E3779B97F4A7C15) ^ whole[beside + 1]
    token, at, seen, where = _tokens(data, offsets)
    found = []
    for codes, of in ((_kind(whole[short], _SHORT), text[short]), (_kind(mix64(pair), _PAIR), text[beside]), (_kind(whole, _OFTEN), text),
                      (_kind(token, _TOKEN), at), (seen, where)):
        if known is not None and len(codes):
            maybe = np.zeros(1 << 16, bool)
            maybe[_short(known)] = True
            likely = maybe[_short(codes)]
            codes, of = codes[likely], of[likely]
            hit, _ = _place(codes, known)
            codes, of = codes[hit], of[hit]
        order = np.lexsort((codes, of))
        codes, of = codes[order], of[order]
        new = np.ones(len(codes), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (of[1:] != of[:-1])
        begin = np.flatnonzero(new)
        times, codes, of = np.diff(np.append(begin, len(codes))), codes[begin], of[begin]
        enough = (codes >> np.uint64(56) != _OFTEN) | (times > 1) & (times * DENSE >= n_words[of])
        found.append((codes[enough], of[enough]))
    return np.concatenate([c for c, _ in found]), np.concatenate([t for _, t in found])


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the tokens with other signs than letters inside, each one's text, codes of the words and beginnings
    that words in disguise stand for, and each one's text."""
    s, e, first = spans(data, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    inside = np.flatnonzero(~_EDGE[data])                   # signs at a token's edges do not belong to it
    low, high = np.searchsorted(inside, s), np.searchsorted(inside, e)
    some = low < high
    s, e, text = inside[low[some]], inside[high[some] - 1] + 1, text[some]
    small = LOWER[data]
    letter = _LETTER[data]
    letters, far = (np.concatenate(([0], np.cumsum(m))) for m in (letter, data >= 0xCC))
    again = np.zeros(len(data), bool)
    again[2:] = letter[2:] & (small[2:] == small[1:-1]) & (small[1:-1] == small[:-2])
    stretched = np.concatenate(([0], np.cumsum(again)))
    size, n = e - s, letters[e] - letters[s]
    odd = n < size
    hashes = range_hash(byte_values(small), s[odd], e[odd])
    guise = (odd | (far[e] > far[s]) | (stretched[e] > stretched[s])) & (n >= 2) & (size >= PREFIXES[0]) & (size <= 80)
    raw = [(data[i:j].tobytes(), t) for i, j, t in zip(s[guise].tolist(), e[guise].tolist(), text[guise].tolist())]
    one = (size == 1) & (n == 1)                            # letters apart
    cut = np.flatnonzero(np.diff(np.concatenate(([0], (one[:-1] & one[1:] & (text[:-1] == text[1:])).astype(np.int8), [0]))))
    for i, j in zip(cut[::2].tolist(), cut[1::2].tolist()):
        if 3 <= j - i < 40:
            raw.append((small[s[i:j + 1]].tobytes(), int(text[i])))
    forms = [(w, t) for r, t in raw for w in _undisguised(r)]
    if not forms:
        return hashes, text[odd], np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words, of = buffers(pa.array([w for w, _ in forms], pa.string()))
    codes, at, _, _ = terms(words, of)
    alone = codes >> np.uint64(60) != _INNER >> 4
    return hashes, text[odd], codes[alone], np.array([t for _, t in forms])[at[alone]]


@lru_cache(1 << 16)
def _undisguised(token: bytes) -> tuple[str, ...]:
    """Words that a token may stand for: signs and foreign letters read as letters, marks and signs between them left
    out, letters that come three times or more in a row read once."""
    raw = unicodedata.normalize("NFKC", token.decode("utf-8", "ignore")).lower()
    bare = "".join(c for c in unicodedata.normalize("NFKD", raw) if unicodedata.category(c) != "Mn")
    out = {}
    for form in (raw, bare):
        for one in "il":
            word = "".join(c for c in form.replace("1", one).translate(_SIGNS) if c.isalpha())
            out[re.sub(r"(.)\1\1+", r"\1", word)] = out[re.sub(r"(.)\1\1+", r"\1\1", word)] = None
            out["".join(c for c in form if c.isalpha())] = None
    return tuple(w for w in out if len(w) >= PREFIXES[0])


def patterns(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, pattern): whether each pattern is in the text."""
    s, e, first = spans(data, offsets)
    n = len(data)
    capital, letter = np.concatenate(([0], np.cumsum(_CAPITAL[data]))), np.concatenate(([0], np.cumsum(_LETTER[data])))
    loud = (letter[e] - letter[s] >= 4) & (capital[e] - capital[s] == letter[e] - letter[s])
    out = np.zeros((len(offsets) - 1, len(PATTERNS)), bool)

    def mark(k, places, width):
        row = np.searchsorted(offsets, places, side="right") - 1
        row = row[places + width <= offsets[row + 1]]
        out[row, k] = True
    if n >= 4:
        mask, let = _MASK[data], _LETTER[data]
        mark(0, np.flatnonzero(let[:-3] & mask[1:-2] & mask[2:-1] & let[3:]), 4)
        same = data[1:] == data[:-1]
        mark(1, np.flatnonzero(let[:-3] & same[:-2] & same[1:-1] & same[2:]), 4)
        bang = data == ord("!")
        mark(3, np.flatnonzero(bang[:-2] & bang[1:-1] & bang[2:]), 3)
    out[:, 2] = per_text(loud, first) >= np.maximum(3, np.diff(first) // 4)
    return out


def _base(codes: np.ndarray) -> np.ndarray:
    """Codes of the words and beginnings that terms are made of."""
    return np.unique(np.where(codes >> np.uint64(63) == 0, codes & ~_DENSE_BIT, codes))


def _place(codes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which codes are known, and the places of these in the sorted codes ``known``."""
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    hit = known[at] == codes
    return hit, at[hit]


def _hits(data: np.ndarray, offsets: np.ndarray, known: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in the sorted codes ``known``) of the terms of each text that are known, each pair once, by text."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, text, word, n_words = terms(data, offsets, base)
    hit, _ = _place(codes, base)
    codes, text = in_texts(codes[hit], text[hit], word[hit], n_words)
    hit, at = _place(codes, known)
    text = text[hit]
    other, whose = other_terms(data, offsets, known)
    at, text = np.concatenate((at, _place(other, known)[1])), np.concatenate((text, whose))
    pairs = np.unique(text * len(known) + at)
    return pairs // len(known), pairs % len(known)


# -- Label model ------------------------------------------------------------------------------------------

@dataclass
class LabelModel:
    """Rates of every voter in either class, given the vote of its parent in the tree (-1: none)."""
    names: list[str]
    prior: float
    parent: np.ndarray
    rates: np.ndarray                       # (voter, class, parent's vote)
    accuracies: dict[str, tuple[float, float]] = field(default_factory=dict)      # votes if toxic, stays silent if not
    correlations: dict[tuple[str, str], float] = field(default_factory=dict)      # conditional mutual information

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of the toxic class for rows of votes."""
        odds = np.full(len(votes), np.log(self.prior) - np.log1p(-self.prior))
        for j, up in enumerate(self.parent):
            given = votes[:, up].astype(int) if up >= 0 else np.zeros(len(votes), int)
            one, zero = self.rates[j, 1, given], self.rates[j, 0, given]
            odds += np.where(votes[:, j], np.log(one) - np.log(zero), np.log1p(-one) - np.log1p(-zero))
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def _information(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Mutual information of each two voters given the class; ``weight`` is (class, row) and sums to 1."""
    v, out = votes.astype(np.float64), np.zeros((votes.shape[1],) * 2)
    for w in weight:
        total = max(w.sum(), 1e-12)
        both, one = (v * w[:, None]).T @ v / total, w @ v / total
        for a, pa_ in ((both, np.outer(one, one)), (one[:, None] - both, np.outer(one, 1 - one)),
                       (one[None] - both, np.outer(1 - one, one)), (1 - one[:, None] - one[None] + both, np.outer(1 - one, 1 - one))):
            a = np.maximum(a, 0)
            out += total * np.where(a > 1e-12, a * np.log(np.maximum(a, 1e-12) / np.maximum(pa_, 1e-12)), 0)
    np.fill_diagonal(out, 0)
    return out


def fit_label_model(votes: np.ndarray, weight: np.ndarray, start: np.ndarray, names: list[str], rounds: int = 15,
                    least_information: float = 1e-3) -> LabelModel:
    """Expectation maximisation from the class probabilities ``start``; ``weight`` counts rows."""
    n, k = votes.shape
    r, scale = start.copy(), weight.sum()
    for turn in range(rounds):
        by_class = np.stack([(1 - r) * weight, r * weight])
        if turn % 5 == 0:                   # the tree: each voter's strongest link to one already in it
            info = _information(votes, by_class / scale)
            parent, best, link = np.full(k, -1), info[0].copy(), np.zeros(k, int)
            left = np.arange(k) > 0
            while left.any():
                j = int(np.argmax(np.where(left, best, -1)))
                if best[j] > least_information:
                    parent[j] = link[j]
                left[j] = False
                closer = info[j] > best
                best, link = np.where(closer, info[j], best), np.where(closer, j, link)
        rates = np.zeros((k, 2, 2))
        for j, up in enumerate(parent):
            given = votes[:, up] if up >= 0 else np.zeros(n, bool)
            for t in (0, 1):
                alone = (by_class[t] @ votes[:, j] + 0.1) / (by_class[t].sum() + 1)
                for v in (0, 1):
                    w = by_class[t] * (given == v)
                    rates[j, t, v] = (w @ votes[:, j] + alone) / (w.sum() + 1)
        prior = float(np.clip((by_class[1].sum() + 0.5) / (scale + 1), 1e-4, 1 - 1e-4))
        model = LabelModel(names, prior, parent, np.clip(rates, 1e-5, 1 - 1e-5))
        r = model.posterior(votes)
    by_class = np.stack([(1 - r) * weight, r * weight])
    sums = np.maximum(by_class.sum(axis=1), 1e-9)
    model.accuracies = {m: (float(by_class[1] @ votes[:, j] / sums[1]), float(by_class[0] @ ~votes[:, j] / sums[0]))
                        for j, m in enumerate(names)}
    model.correlations = {(names[j], names[up]): float(info[j, up]) for j, up in enumerate(parent) if up >= 0}
    return model


def pick_voters(x: np.ndarray, toxic: np.ndarray, most: int = VOTERS) -> list[int]:
    """Columns that, one after another, cover most toxic rows not yet covered twice; a clean row costs as three."""
    cover, chosen, cost = np.zeros(len(x), int), [], 3 * (x[~toxic].sum(axis=0))
    while len(chosen) < most:
        gain = x[toxic & (cover < 2)].sum(axis=0) - cost
        gain[chosen] = -1
        j = int(np.argmax(gain)) if len(gain) else 0
        if not len(gain) or gain[j] <= 0:
            break
        chosen.append(j)
        cover += x[:, j]
    return chosen


# -- Classifier ---------------------------------------------------------------------------------------------

def even_weights(target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``weight`` scaled so that the rows that are likelier toxic weigh as much as the others."""
    toxic = target > 0.5
    return weight * np.where(toxic, 0.5 / max(weight[toxic].sum(), 1e-9), 0.5 / max(weight[~toxic].sum(), 1e-9))


def fit_logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, l1: float = 5e-5, rounds: int = 3000) -> tuple[np.ndarray, float]:
    """Weights and intercept of the logistic regression on soft targets with an L1 penalty on the weights, by
    accelerated proximal gradient steps."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    w = weight / weight.sum()
    mean = np.clip(w @ target, 1e-4, 1 - 1e-4)
    beta = np.zeros(x.shape[1])
    beta[-1] = np.log(mean / (1 - mean))
    v = np.ones(x.shape[1])
    for _ in range(30):                    # the largest curvature
        v = x.T @ (w * (x @ v))
        v /= max(np.linalg.norm(v), 1e-12)
    step = 3.0 / max(float(v @ (x.T @ (w * (x @ v)))), 1e-6)
    at, t = beta.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -60, 60)))
        new = at - step * (x.T @ (w * (p - target)))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * l1, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if (new - beta) @ (at - new) > 0:  # the momentum points the wrong way
            t2 = 1.0
        at, beta, t = new + (t - 1) / t2 * (new - beta) if t2 > 1 else new.copy(), new, t2
    return beta[:-1], float(beta[-1])


@dataclass
class Model:
    """Sorted term codes with their weights, the patterns' weights, the intercept, and the label model."""
    codes: np.ndarray
    weights: np.ndarray
    pattern_weights: np.ndarray
    intercept: float
    label_model: LabelModel | None = None

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, which = _hits(data, offsets, self.codes, _base(self.codes))
        odds = self.intercept + np.bincount(row, self.weights[which], len(offsets) - 1)
        if self.pattern_weights.any():
            odds = odds + patterns(data, offsets) @ self.pattern_weights
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def _count_batches(batches):
    for b in batches:
        data, offsets = buffers(b.column(1))
        y = b.column(0).to_numpy()
        for i, j in slices(offsets):
            part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            pairs = [np.concatenate(x) for x in zip(in_texts(*terms(part, own)), other_terms(part, own))]
            order = np.lexsort(pairs)
            codes, text = (x[order] for x in pairs)
            new = np.ones(len(codes), bool)                 # a word may come in plain and in disguise
            new[1:] = (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
            codes, text = codes[new], text[new]
            toxic = y[i:j][text]
            kinds, inverse = np.unique(codes, return_inverse=True)
            pos = np.bincount(inverse, toxic, len(kinds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds.view(np.int64)), pa.array(pos), pa.array(np.bincount(inverse, minlength=len(kinds)) - pos)],
                names=["code", "pos", "neg"])


def _vote_batches(known: np.ndarray):
    def run(batches):
        for b in batches:
            data, offsets = buffers(b.column(1))
            for i, j in slices(offsets):
                part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                row, which = _hits(part, own, known, _base(known))
                cut = np.searchsorted(row, np.arange(j - i + 1))
                which = which.astype("<i2")
                marks = patterns(part, own) @ (1 << np.arange(len(PATTERNS)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([which[cut[k]:cut[k + 1]].tobytes() for k in range(j - i)], pa.binary()),
                     pa.array(marks.astype(np.int32))], names=["y", "hits", "marks"])
    return run


def _association(n_pos: float, n_neg: float) -> Column:
    """Likelihood ratio of a term's texts in the two classes; null where toxic texts have it no more often."""
    pos, neg, n = F.col("pos").cast("double"), F.col("neg").cast("double"), n_pos + n_neg
    share = (pos + neg) / n

    def part(k, m):
        return F.when(k > 0, k * F.log(k / (m * share))).otherwise(0.0) + F.when(m - k > 0, (m - k) * F.log((m - k) / (m * (1 - share)))).otherwise(0.0)
    return F.when(pos * n_neg > neg * n_pos, F.when(share < 1, part(pos, F.lit(n_pos)) + part(neg, F.lit(n_neg))))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, fold: int) -> tuple[DataFrame, dict]:
    """(y, text): the bounded training sample, stored; and the number of usable labels of either class."""
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (crc_bucket(id_col, folds) != fold))
    usable = usable.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("y")).distinct()
    sizes = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    halves = [usable.filter(F.col("y") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(SAMPLE // 2) for y in (0, 1)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(halves[0].unionByName(halves[1])), F.col("id") == F.col("label_id"))             # at most SAMPLE ids
    rows = rows.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_BYTES)
    one = rows.groupBy("label_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return stored(one.select("y", "text"), "toxicity-sample"), sizes


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          folds: int = 3, fold: int = 1) -> Model:
    """Fit on labelled rows whose crc32(id as text) modulo ``folds`` is not ``fold``."""
    on_workers(docs.sparkSession)
    rows, sizes = sample(docs, labels, id_col, text_col, label_col, folds, fold)
    have = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    none = np.zeros(0)
    if not have.get(0) or not have.get(1):
        odds = 0.0 if not have else (-5.0 if have.get(0) else 5.0)
        return Model(none.astype(np.uint64), none, np.zeros(len(PATTERNS)), odds)
    counted = rows.mapInArrow(_count_batches, "code long, pos long, neg long").groupBy("code").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter(F.col("pos") >= LEAST_TEXTS)
    ranked = counted.withColumn("link", _association(have[1], have[0])).filter("link is not null")
    other = F.shiftrightunsigned("code", 56).isin([k for k in _HASHED if k != _WORD])
    top = [r for own, most in ((~other, VOCABULARY), (other, OTHERS))
           for r in ranked.filter(own).orderBy(F.desc("link"), "code").limit(most).collect()]
    known = np.sort(np.array([r["code"] for r in top], np.int64).view(np.uint64))
    made = sorted((r["y"], bytes(r["hits"]), r["marks"])
                  for r in rows.mapInArrow(_vote_batches(known), "y int, hits binary, marks int").collect())
    x = np.zeros((len(made), len(known)), bool)
    for i, (_, hits, _) in enumerate(made):
        x[i, np.frombuffer(hits, "<i2")] = True
    marks = (np.array([m for _, _, m in made])[:, None] >> np.arange(len(PATTERNS)) & 1).astype(bool)
    y = np.array([y for y, _, _ in made]) == 1
    weight = np.where(y, sizes[1] / have[1], sizes[0] / have[0])
    weight *= len(y) / weight.sum()
    voters = pick_voters(x, y)
    votes = np.column_stack([x[:, voters], marks, y])
    names = [_spell(int(known[j])) for j in voters] + list(PATTERNS) + ["label"]
    truth = fit_label_model(votes, weight, np.where(y, 0.98, 0.02), names)
    target = truth.posterior(votes)
    beta, intercept = fit_logistic(np.column_stack([x, marks]), target, even_weights(target, weight))
    used = np.flatnonzero(beta[:len(known)])
    return Model(known[used], beta[used], beta[len(known):], intercept, truth)


def _spell(code: int) -> str:
    """A voter's name: its word, or the beginning of its words."""
    kind = code >> 56
    if kind in _HASHED:
        return f"{_HASHED[kind]} {code:016x}"
    text = code.to_bytes(8, "little")[:kind & 0x0F].decode("utf-8", "replace")
    return text if kind & 0x80 else f"many ...{text}..." if kind & _INNER else f"many {text}..." if kind & 0x40 else f"{text}..."


def score(df: DataFrame, model: Model, text_col: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the toxicity score of every whole text in ``out`` (underscored where
    ``df`` has that name)."""
    on_workers(df.sparkSession)
    columns = df.columns if keep is None else keep
    n = len(columns)
    inner = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col(text_col).alias("t"))

    def add(batches):
        for b in batches:
            data, offsets = buffers(b.column(n))
            made = [model.scores(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in slices(offsets)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(np.concatenate(made) if made else np.zeros(0))],
                                             names=[*b.schema.names[:n], "score"])

    return inner.mapInArrow(add, inner.drop("t").schema.add("score", "double")).toDF(*columns, free_name(df.select(*columns), out))
