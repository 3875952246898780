"""Quality classifier and language model: held-out accuracy, gradients, exact counts; rules and mixing."""

import math
import zlib

import brute
import numpy as np
import pytest
import samples
from pyspark.sql import functions as F

from starloom.llm import gru_lm, mixing, quality_crf, quality_rules
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_quality_separates_held_out_documents(spark):
    got = QUERIES["op2_quality_crf"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_quality_of_odd_rows_and_without_labels(spark):
    df = samples.odd(spark)
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (4, 0, 1)],
                                   "doc_id bigint, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        model = quality_crf.learn(df, lab)
        got = quality_crf.score(df, model, out="q")
        rows = got.collect()
        assert got.columns == [*df.columns, "q"] and len(rows) == len(samples.ODD)
        assert all(0 <= r.q <= 1 for r in rows)
    assert quality_crf.score(samples.empty(spark), model).count() == 0


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 4, 4, 5, 11])
    u, pairs = rng.normal(size=11), rng.normal(size=(2, 2))
    a, b, _ = quality_crf.forward_backward(u, first, pairs)
    for lo, hi in zip(first[:-1], first[1:]):
        n = hi - lo
        mass = np.zeros((n, 2))
        for bits in range(1 << n if n else 0):
            y = [bits >> k & 1 for k in range(n)]
            w = math.exp(sum(u[lo + k] * y[k] for k in range(n)) + sum(pairs[y[k], y[k + 1]] for k in range(n - 1)))
            for k in range(n):
                mass[k, y[k]] += w
        if n:
            assert np.allclose(a[lo:hi] + b[lo:hi], np.log(mass[:, 1] / mass[:, 0]))


def test_network_gradient_and_distribution():
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 50, gru_lm.CLASSES * gru_lm.PER_CLASS).astype(float)
    flat = gru_lm.start_weights(counts).astype(np.float64)
    w = gru_lm.unpack(flat)
    states = rng.normal(size=(1, gru_lm.HIDDEN))
    every = np.arange(gru_lm.CLASSES * gru_lm.PER_CLASS)
    got, _ = gru_lm.log_probability(w, np.repeat(states, len(every), axis=0), every)
    assert abs(np.exp(got).sum() - 1) < 1e-9                         # a distribution over all tokens
    tokens = rng.integers(0, len(every), 5)
    states = rng.normal(size=(5, gru_lm.HIDDEN))
    grad = gru_lm.unpack(np.zeros_like(flat))
    _, back = gru_lm.log_probability(w, states, tokens, grad)
    step = np.zeros_like(states)
    step[2, 3] = 1e-5
    up, down = (-gru_lm.log_probability(w, states + s, tokens)[0].sum() for s in (step, -step))
    assert abs((up - down) / 2e-5 - back[2, 3]) < 1e-5


def test_training_lowers_the_loss_and_state_is_carried():
    rng = np.random.default_rng(0)
    tokens = np.tile(np.array([5, 9, 700, 0]), 1500)
    bounds = np.arange(0, len(tokens) + 1, 200)
    flat = gru_lm.start_weights(np.bincount(tokens, minlength=gru_lm.CLASSES * gru_lm.PER_CLASS).astype(float))
    before = gru_lm.score_texts(flat, tokens, bounds).sum()
    for _ in range(3):
        flat = gru_lm.train(flat, tokens, bounds, 0.03)
    assert gru_lm.score_texts(flat, tokens, bounds).sum() > 0.5 * before
    long = np.concatenate([tokens, rng.integers(0, 4000, 1000)])     # one text over many windows = its prefix scores
    one = gru_lm.score_texts(flat, long, np.array([0, len(long)]))[0]
    many = gru_lm.score_texts(flat, np.tile(long, 3), np.arange(4) * len(long))
    assert np.allclose(many, one, rtol=1e-5)


def expected_base(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    toks = [[x.translate(brute.LOWER) for x in brute.words(t)] + ["\0"] for _, t in rows]
    c = {}
    for t, h in zip(toks, held):
        for x in t if not h else []:
            c[x] = c.get(x, 0) + 1
    n, v = sum(c.values()), len(c)
    return [(d, h, len(t), sum(x in c for x in t), n, round(sum(math.log10((c.get(x, 0) + 1) / (n + v + 1)) for x in t), 6))
            for (d, _), h, t in zip(rows, held, toks)]


@pytest.mark.parametrize("head", [1 << 18, 40])
def test_language_scores(spark, monkeypatch, head):
    monkeypatch.setattr(gru_lm, "HEAD", head)           # 40: nearly all counts come by the join
    rows = samples.prose(60) + samples.ODD
    got = [r for r in gru_lm.language_scores(samples.frame(spark, rows)).collect()]
    have = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], key=str)
    assert have == sorted(expected_base(rows), key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert gru_lm.language_scores(samples.empty(spark)).count() == 0


def test_language_model_beats_the_unigram_model_on_held_out_texts(spark):
    rows = QUERIES["op5_gru_lm"](spark, SF).filter("held_out").collect()
    assert sum(r.score for r in rows) > 0.97 * sum(r.base_score for r in rows)


def test_every_training_document_reaches_the_network(spark):
    n = 2000                                            # 2.4 million tokens; each text has a word of its own
    texts = spark.range(n, numPartitions=8).select(
        F.xxhash64("id").alias("order"), F.concat(F.repeat(F.concat(F.lit("own"), "id", F.lit(" the ")), 600)).alias("text"))
    words, weight = gru_lm.vocabulary(gru_lm.count_words(texts.select("text")))
    changed = (gru_lm.unpack(gru_lm.fit(texts, words, weight))["embed"] != gru_lm.unpack(gru_lm.start_weights(weight))["embed"]).any(axis=1)
    assert changed[1:n + 2].all() and words.n == n * 1201


def test_token_slices_hold_every_token_once():
    import pyarrow as pa
    rows = [list(range(k)) for k in (5, 1, 30, 1, 1, 7, 2)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int16()))], names=["tokens"]) for x in (rows[:4], [], rows[4:])]
    for most in (1, 8, 10, 1000):
        got = list(gru_lm.token_slices(batches, most))
        assert [t[a:b].tolist() for t, o in got for a, b in zip(o, o[1:])] == rows
        assert all(len(t) <= most or len(o) == 2 for t, o in got)


def test_rules(spark):
    rows = samples.prose(80) + samples.ODD + [(900, samples.long_text()), (901, "x y " * 300), (902, "é# ü|\n\n|é# ü|\né# ü|")]
    book = quality_rules.ledger(samples.frame(spark, rows))
    got = sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in book.collect()], key=str)
    assert got == sorted([(d, *brute.rules(t)) for d, t in rows], key=str)
    assert quality_rules.ledger(samples.odd(spark)).count() == len(samples.ODD)
    assert quality_rules.ledger(samples.empty(spark)).count() == 0


def test_ablations_count_what_each_rule_does_alone(spark):
    book = quality_rules.ledger(samples.frame(spark, samples.prose(80) + samples.ODD + [(901, "x y " * 300), (902, "A# " * 30)]))
    policy = quality_rules.WEB
    failed = [r.failed & policy.mask for r in book.collect()]
    table = {r.rule: r for r in quality_rules.ablations(book, policy).collect()}
    for rule, (bit, _) in quality_rules.RULES.items():
        assert table[rule].failed == sum(f >> bit & 1 for f in failed)
        assert table[rule].failed_alone == sum(f == 1 << bit for f in failed)
        assert table[rule].kept == failed.count(0)
    assert quality_rules.apply_policy(book, quality_rules.BASE).filter("kept").count() == sum(not f & 3 for f in failed)


def test_hypergeometric_draws_have_the_right_distribution(spark):
    n, k, d = 50, 20, 15
    draws = spark.range(20_000).select(mixing.hypergeometric(
        F.lit(n), F.lit(k), F.lit(d), (F.col("id") + 0.5) / 20_000).alias("x")).groupBy("x").count().collect()
    total = math.comb(n, d)
    for r in draws:                                     # evenly spaced u: shares are exact to one step
        assert abs(r["count"] / 20_000 - math.comb(k, r.x) * math.comb(n - k, d - r.x) / total) < 1e-4
    edges = spark.createDataFrame([(10, 0, 5, 0), (10, 10, 5, 5), (10, 4, 0, 0), (10, 4, 10, 4), (0, 0, 0, 0)], "n int, k int, d int, x int")
    got = edges.select("x", mixing.hypergeometric(F.col("n"), F.col("k"), F.col("d"), F.lit(0.73)).alias("y")).collect()
    assert all(r.x == r.y for r in got)
    # Large parameters: mean and spread of evenly spaced u (outcomes are enumerated from the mode up, then down).
    big = [r.x for r in spark.range(41).select(mixing.hypergeometric(
        F.lit(10 ** 8), F.lit(3 * 10 ** 7), F.lit(5 * 10 ** 7), (F.col("id") + 0.5) / 41).alias("x")).collect()]
    assert abs(np.mean(big) - 15_000_000) < 400 and 1700 < np.std(big) < 2900        # 2291 in theory


def test_tree_keeps_quotas_and_shard_sizes(spark):
    quotas = [1000, 0, 37, 512, 3]
    got = mixing.splitting_tree(spark.createDataFrame([(quotas,)], "quotas array<bigint>"), 3, 7).collect()
    for place, q in enumerate(quotas):
        assert sum(r.quota for r in got if r.place == place) == q
    sizes = [sum(r.quota for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == sum(quotas)


def test_targets_are_reshared_until_none_is_above_its_limit(spark):
    sizes = {"a": 10, "b": 1000, "é": 5, "z": 700, None: 3, "c": 0, "d": 90}
    rows = {r.source: r for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()}
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = brute.targets([sizes[s] for s in order], [i % 3 + 1 for i in range(len(order))])
    for s, w in zip(order, want):
        assert rows[s].target == pytest.approx(w)


def mix_rows():
    rows = [(i, t, f"s{i % 7}" if i % 11 else None) for i, t in samples.prose(600)]
    return rows + [(5000, None, "s1"), (5001, "", "empty"), (None, "a b c", "s2"), (7, rows[7][1], rows[7][2])]


def test_mix_meets_its_targets(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    mix = mixing.Mix(df, block_words=400, shard_words=2000)
    got = mix.taken().collect()
    assert len(got) == len(rows)
    assert sorted(((r.doc_id, r["size"]) for r in got), key=str) == sorted(((d, len(brute.words(t))) for d, t, _ in rows), key=str)
    assert all(r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"] for r in got)
    per = {}
    for r in got:
        p = per.setdefault((r.source_size, r.target), [0])
        p[0] += r.taken
    for (size, target), (taken,) in per.items():
        assert abs(taken - target) <= 120 or size == 0      # half of the longest texts
    again = mixing.Mix(df.repartition(3), block_words=400, shard_words=2000).taken().collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    # The mix's rows are what taken counts, and shards take disjoint blocks of near equal number.
    out = mix.rows()
    assert out.columns == [*df.columns, "mix_epoch", "mix_shard", "mix_order"]
    assert out.groupBy("doc_id", "text", "mix_epoch").agg(F.count_distinct("mix_shard").alias("k")).filter("k > 1 and doc_id <> 7").count() == 0
    assert sum(len(brute.words(r.text)) for r in out.collect()) == sum(r.taken for r in got)
    assert mix.levels > 0 and mix.shuffled().columns == df.columns


def test_mix_of_odd_and_empty_tables(spark):
    got = mixing.Mix(samples.odd(spark))
    assert got.taken().count() == len(samples.ODD) and got.shuffled().columns == samples.odd(spark).columns
    assert mixing.Mix(samples.empty(spark)).taken().count() == 0
    assert mixing.Mix(samples.empty(spark)).shuffled().count() == 0
