"""Exact, substring, line and SimHash deduplication against brute force."""

import brute
import numpy as np
import samples
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import golay_simhash as G
from starloom.llm.exact_dedup import exact_dedup
from starloom.llm.line_dedup import fingerprints, line_dedup, shortest_runs
from starloom.llm.substring_dedup import substring_dedup

DECIDED = ("_keep_id", "group_size", "_kept", "text_sha256")


def exact_expected(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for t, ids in groups.items():
        best = max((d for d in ids if d is not None), default=None)
        stays = [True] + [False] * (len(ids) - 1)
        for d, kept in zip(sorted(ids, key=lambda d: d != best), stays):
            out.append((d, best, len(ids), kept, brute.sha(t)))
    return sorted(out, key=str)


def test_exact_dedup_of_odd_rows_keeps_all_columns(spark):
    df = samples.odd(spark)
    got = exact_dedup(df)
    assert got.columns == [*df.columns, *DECIDED]
    rows = got.collect()
    assert sorted([(r.doc_id, r._keep_id, r.group_size, r._kept, r.text_sha256) for r in rows], key=str) == exact_expected(samples.ODD)
    assert all(r.Kept == "clash" and r.fp == 1.5 and r.score == [1] for r in rows)
    assert exact_dedup(samples.empty(spark)).count() == 0


def test_exact_dedup_splits_buckets_and_pages(spark):
    rows = samples.prose(200) + [(1000 + i, "hot text " * 5) for i in range(300)] + [(5000, samples.long_text())]
    df = samples.frame(spark, rows)
    for chars, depth in ((400, 12), (2000, 3)):         # many splits and pages; a directory that may not grow enough
        got = exact_dedup(df, keep_text=False, bucket_chars=chars, max_depth=depth).collect()
        assert sorted([tuple(r) for r in got], key=str) == exact_expected(rows)


def test_substring_dedup(spark):
    rows = samples.prose(150) + [(900, "same " * 100), (901, " ".join("abcdefghij" * 12)), (902, None), (903, "")]
    rows += [(904, samples.long_text(20_000)), (905, "x " + samples.long_text(20_000)[:3000])]
    got = substring_dedup(samples.frame(spark, rows)).drop("kept_text").collect()
    assert sorted(map(tuple, got)) == sorted(brute.substring(rows))
    assert any(r.n_removed for r in got) and any(not r.n_removed and r.n_words > 40 for r in got)


def test_substring_dedup_of_odd_rows(spark):
    got = substring_dedup(samples.odd(spark)).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.substring(samples.ODD), key=str)
    assert substring_dedup(samples.empty(spark)).count() == 0


def test_rows_that_share_an_id_and_text_repeat_each_other(spark):
    text = " ".join(f"u{i}" for i in range(50))
    rows = [(1, text), (1, text), (2, "other " + text[::-1]), (2, "short")]
    got = substring_dedup(samples.frame(spark, rows, 2)).drop("kept_text").collect()
    assert sorted(map(tuple, got)) == sorted(brute.substring(rows))


def test_line_dedup(spark):
    rows = samples.prose(200, lines=True) + [(900, "a\nb\nc\na\nb\nc\na\nb"), (901, "z\n\nb\n c\nc\na\nb\nc"), (902, None),
                                             (903, "\n\n"), (904, "q\n" * 50), (905, samples.long_text().replace(" ", "\n"))]
    got = line_dedup(samples.frame(spark, rows)).drop("kept_text").collect()
    assert sorted(map(tuple, got)) == sorted(brute.lines(rows))
    assert sum(r.n_removed for r in got) > 50
    odd = line_dedup(samples.odd(spark)).drop("kept_text").collect()
    assert sorted(map(tuple, odd), key=str) == sorted(brute.lines(samples.ODD), key=str)
    assert line_dedup(samples.empty(spark)).count() == 0


def test_short_repeats_of_lines(spark):
    one, two = "a line of eight words or a few more", "four words are here\nand four are there"
    rows = [(1, f"x\n{one}\ny"), (2, f"z\n{one}"), (3, two), (4, f"p\n{two}\nq"), (5, "too short"), (6, "too short"), (7, "too short\nto go"),
            (8, "one two\nthree four five six seven eight nine\nten"), (9, "h\none two\nthree four five six seven eight nine\nten\nt"),
            (10, "four words are here"), (11, f"{one}\n{one}"), (None, one), (None, one)]
    got = line_dedup(samples.frame(spark, rows)).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.lines(rows), key=str)
    removed = {r.doc_id: r.n_removed for r in got if r.doc_id is not None}
    assert [removed[d] for d in range(1, 12)] == [1, 1, 0, 2, 0, 1, 0, 0, 3, 0, 2]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 9), max_size=9), min_size=1, max_size=4))
def test_shortest_runs_hold_a_selected_line(sizes):
    words = np.array([x for s in sizes for x in s], np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sizes])))
    end, start = shortest_runs(words, bounds)
    h = np.random.default_rng(len(words)).integers(0, 50, len(words)).astype(np.uint64)
    chosen, short = fingerprints(h, end, bounds)
    for t, s in enumerate(sizes):
        def enough(a, b):
            return a >= 0 and b <= len(s) and (b - a >= 3 or sum(s[a:b]) >= 8)
        for i in range(len(s)):
            own = bounds[t]
            onward = next((b for b in range(i + 1, len(s) + 1) if enough(i, b)), None)
            back = next((a for a in range(i, -1, -1) if enough(a, i + 1)), None)
            assert end[own + i] == (0 if onward is None else own + onward) and start[own + i] == (-1 if back is None else own + back)
            if onward is not None:
                assert h[chosen[own + i]] == h[own + i:own + onward].min() and own + i <= chosen[own + i] < own + onward
        assert short[t] == (bool(s) and not enough(0, len(s)))


def many_alike(n=1500):
    """Rows that share ids or have none: equal texts, different texts, and one passage in all of them."""
    passage = " ".join(f"v{i}" for i in range(40))
    rows = [(None, passage + "\nnine words of a line that all rows have")] * n
    rows += [(None if i % 2 else 7, f"{passage}\nrow {i} has words of its own to keep {i}") for i in range(n // 2)]
    return rows + [(8, None), (None, ""), (7, passage), (9, samples.long_text(300))]


def test_rows_without_or_with_equal_ids_are_told_apart(spark):
    rows = many_alike()
    df = samples.frame(spark, rows)
    got = substring_dedup(df).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.substring(rows), key=str)
    got = line_dedup(df).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.lines(rows), key=str)


def test_texts_with_equal_32_bit_hashes_keep_their_own_spans(spark):
    """Rows without id whose texts Spark's 32-bit hash cannot tell apart."""
    passage = " ".join(f"v{i}" for i in range(40))
    numbers = spark.range(160_000).select(F.concat(F.lit(passage + " "), F.repeat(F.lit("pad "), (F.col("id") % 40).cast("int")),
                                                   F.col("id").cast("string")).alias("text"))
    pair = numbers.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t")).filter("size(t) > 1").first()
    rows = [(None, t) for t in pair["t"]]
    got = substring_dedup(samples.frame(spark, rows)).drop("kept_text").collect()
    assert len(rows) > 1 and sorted(map(tuple, got), key=str) == sorted(brute.substring(rows), key=str)


def test_strings_that_collide_in_a_polynomial_hash_are_told_apart(spark):
    rows = []
    for n in (512, 1024, 2048):
        a, b = samples.thue_morse(n)
        filler = [f"u{n}x{i}" for i in range(34)]
        rows += [(n, " ".join([a, *filler])), (n + 1, " ".join([b, *filler])), (n + 2, f"{a} {n}\n{a}\n{a}"), (n + 3, f"{b} {n}\n{b}\n{b}")]
    df = samples.frame(spark, rows)
    assert sorted(map(tuple, substring_dedup(df).drop("kept_text").collect())) == sorted(brute.substring(rows))
    assert sorted(map(tuple, line_dedup(df).drop("kept_text").collect())) == sorted(brute.lines(rows))


def test_golay_code_is_perfect_and_words_within_two_bits_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 400)
    row, _ = G.near_codewords(words)
    assert set(np.bincount(row)) <= {1, 2, 3, 4, 5, 6}
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    for bits in range(3):
        near = fps.copy()
        for i in range(len(near)):
            for b in rng.choice(64, bits, replace=False):
                near[i] ^= np.uint64(1) << np.uint64(b)
        (ra, ka), (rb, kb) = G.keys_of(fps), G.keys_of(near)
        assert all(set(ka[ra == i]) & set(kb[rb == i]) for i in range(len(fps)))


def test_dense_and_sparse_keys_link_alike():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base:
        for _ in range(150):
            x = int(b)
            for k in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(k)
            fps.add(x)
    fps = np.array(sorted(fps), np.uint64)
    a, b = G.link_sorted(np.zeros(len(fps), np.int64), fps)
    place = {int(f): i for i, f in enumerate(fps)}
    label = G._forest(len(fps), np.array([place[int(x)] for x in a]), np.array([place[int(x)] for x in b]))
    expected = brute.components(fps.tolist(), list(range(len(fps))))
    assert label.tolist() == expected and len(a) == len(fps) - len(set(expected))


def test_near_duplicates(spark):
    rows = samples.prose(250) + [(i, t) for i, t in samples.ODD] + [(700 + i, samples.long_text(5000, 9) + f" tail{i % 7}") for i in range(40)]
    got = G.near_duplicates(samples.frame(spark, rows))
    assert got.columns == ["doc_id", "fp", "component_id"]
    fps = [brute.fingerprint(t) for _, t in rows]
    named = brute.components(fps, [d for d, _ in rows])
    expected = sorted([(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, named)], key=str)
    have = got.select("doc_id", G.hex_fingerprint(F.col("fp")), "component_id").collect()
    assert sorted(map(tuple, have), key=str) == expected
    assert G.near_duplicates(samples.empty(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    df = samples.odd(spark)
    kept = G.keep_one(df)
    assert kept.columns == df.columns
    fps = [brute.fingerprint(t) for _, t in samples.ODD]
    named = brute.components(fps, [d for d, _ in samples.ODD])
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for c in named if c is not None})
    assert G.keep_one(samples.empty(spark)).count() == 0


def test_one_row_of_each_component_stays_whatever_its_id(spark):
    texts = [samples.long_text(300, seed) for seed in range(20, 27)]
    rows = [(None, t) for t in texts[:5]] + [(1, texts[5]), (2, texts[5]), (2, texts[6]), (None, texts[5]), (None, texts[0])]
    for parts in (1, 4):
        kept = G.keep_one(samples.frame(spark, rows, parts)).collect()
        assert sorted(map(tuple, kept), key=str) == sorted([*rows[:6], (2, texts[6])], key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2 ** 64 - 1), max_size=9), max_size=12))
def test_majority_counts_bits(groups):
    flat = np.array([h for g in groups for h in g], np.uint64)
    bounds = np.concatenate(([0], np.cumsum([len(g) for g in groups]))).astype(np.int64)
    got = G.majority(flat, bounds)
    assert got.tolist() == [sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in g) > len(g)) for g in groups]


def test_majority_of_very_many_hashes():
    h = np.random.default_rng(0).integers(0, 1 << 63, 200_003, dtype=np.uint64)
    got = int(G.majority(h, np.array([0, 0, len(h), len(h)]))[1])
    assert got == sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))
