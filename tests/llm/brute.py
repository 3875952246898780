"""Plain-Python versions of the operators' definitions, for small tables."""

import hashlib
import re
import zlib
from fractions import Fraction
from itertools import permutations

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text):
    w = [x.translate(LOWER) for x in words(text)]
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(fps, ids):
    """Smallest id reachable over fingerprints at most two bits apart."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    f = np.array(fps, np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= 2) + i + 1:
            root[find(int(j))] = find(i)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return [low.get(find(i)) for i in range(len(f))]


def substring(rows, k=35):
    """(id, n_words, n_removed, sha) of rows (id, text): words under windows found twice or more go."""
    seen = {}
    docs = [words(t) for _, t in rows]
    for w in docs:
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (d, _), w in zip(rows, docs):
        gone = set()
        for p in range(len(w) - k + 1):
            if seen[tuple(w[p:p + k])] > 1:
                gone.update(range(p, p + k))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def lines(rows, run=3, least=8):
    """(id, n_lines, n_removed, sha): rows in order of id and text hash; runs of ``run`` lines or ``least`` words, and
    whole texts shorter than these, that stand at an earlier position go."""
    def order(i):
        d, t = rows[i]
        h = xxhash.xxh64_intdigest((t or "").encode(), 42)
        return d is not None, d or 0, h - (1 << 64) * (h >> 63), i

    seen, out = set(), {}
    for i in sorted(range(len(rows)), key=order):
        d, t = rows[i]
        parts = (t or "").split("\n")
        real = [k for k, x in enumerate(parts) if words(x)]
        size = [len(words(parts[k])) for k in real]
        gone = set()
        for p in range(len(real)):
            for n in range(1, 6):
                if p + n <= len(real) and (n >= run or sum(size[p:p + n]) >= least):
                    key = tuple(parts[k] for k in real[p:p + n])
                    if key in seen:
                        gone.update(real[p:p + n])
                    seen.add(key)
        if real and len(real) < run and sum(size) < least:
            key = ("whole", *(parts[k] for k in real))
            if key in seen:
                gone.update(real)
            seen.add(key)
        out[i] = (d, len(real), len(gone), sha("\n".join(x for k, x in enumerate(parts) if k not in gone)))
    return [out[i] for i in range(len(rows))]


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    real = [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[p:p + 8]) for p in range(len(w) - 7)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    cover = {i for p, g in enumerate(grams) if count[g] > 1 for i in range(p, p + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(real) - len(set(real)), len(cover)


def targets(sizes, weights, most=3):
    """Shares of the sum by weight, none above ``most`` times its source."""
    total, full = sum(sizes), set()
    while True:
        left = [i for i in range(len(sizes)) if i not in full]
        level = (total - sum(most * sizes[i] for i in full)) / max(1, sum(weights[i] for i in left))
        new = {i for i in left if level * weights[i] > most * sizes[i]}
        if not new:
            return [most * s if i in full else level * weights[i] for i, s in enumerate(sizes)]
        full |= new


def planted(doc_id, text):
    """The words of a text after the contract of operator 11 changed them."""
    w, h = words(text), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def runs(w, least=24, times=3):
    """(start, length, period) of all runs, by trying every period at every place."""
    found = {}
    for p in range(1, len(w) // times + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, times * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def run_digests(w):
    """The digest columns of operator 11 for the words of a text."""
    found = runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    milli = 1000 * best[1] // best[2] if found else None
    return (len(found), *best, milli, sha("".join("%d,%d,%d\n" % r for r in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def filter_audit(rows, labels):
    """Rows (part, order, step, ...) of operator 12, counted by applying the filters in every order."""
    first, flags, out = {}, {}, []
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, good, bad in labels:
        old = flags.get(d, (0, 0))
        flags[d] = (max(old[0], int(good == 1)), max(old[1], int(bad == 1)))
    parts = {}
    for d, t, part in rows:
        t, w = t or "", words(t)
        upper = sum("A" <= c <= "Z" for c in t)
        fails = {f for f, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * upper > 2 * len(t),
                                             bool(re.search(r"[#$%&*|]", t)), d is not None and d > first[t])) if x}
        parts.setdefault(part or "", []).append((fails, flags.get(d, (0, 0)) if d is not None else (0, 0)))
    for part, docs in parts.items():
        seen, sums = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                removed, left = [x for x in left if f in x[0]], [x for x in left if f not in x[0]]
                sums[f] += len(removed)
                seen.append((order, step, f, len(left), len(removed), sum(f in x[0] for x in docs) - len(removed),
                             sum(x[0] == {f} for x in docs), sum(x[1][0] for x in removed), sum(x[1][1] for x in removed)))
        out += [(part, order, step, *rest, sums[f]) for order, step, f, *rest in seen]
    return sorted(out)
