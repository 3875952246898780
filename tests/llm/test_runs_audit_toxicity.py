"""Periodic runs, filter audit and toxicity: brute force, planted cases, odd rows, held-out accuracy."""

import random
import zlib

import brute
import numpy as np
import pytest
import samples
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import filter_audit, periodic_runs, toxicity
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


# -- Operator 11 ---------------------------------------------------------------------------------------------

def found_in(docs):
    first = np.concatenate(([0], np.cumsum([len(w) for w in docs])))
    numbers = np.array([x for w in docs for x in w], np.int64)
    text, *rows = periodic_runs.find_runs(numbers, first)
    return [[tuple(int(v) for v in r) for d, *r in zip(text, *rows) if d == k] for k in range(len(docs))]


def periodic(rng):
    n, k = rng.choice([0, 1, 23, 24, 25, 47, 48, 60, 150, 400]), rng.choice([1, 2, 2, 3, 40])
    w = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // (3 + rng.randrange(8))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    for _ in range(rng.randrange(3) if n else 0):
        w[rng.randrange(n)] = 99
    return w


def test_runs_equal_trying_all_periods():
    rng = random.Random(7)
    for _ in range(150):
        docs = [periodic(rng) for _ in range(rng.randrange(1, 7))]
        assert found_in(docs) == [brute.runs(w) for w in docs]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=90), st.integers(1, 4))
def test_runs_of_repeated_binary_words(w, times):
    assert found_in([w * times]) == [brute.runs(w * times)]


def test_runs_in_slices_of_candidates(monkeypatch):
    rng = random.Random(3)
    docs = [periodic(rng) for _ in range(12)]
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 7)
    assert found_in(docs) == [brute.runs(w) for w in docs]


def test_grammar_extensions_are_exact_both_ways():
    rng = np.random.default_rng(2)
    w = np.concatenate([np.zeros(300), rng.integers(0, 2, 200), np.tile([1, 0, 2], 60), np.zeros(77)]).astype(np.int64)
    seq = np.concatenate(([-1], w, [-2]))
    levels = periodic_runs.recompress(seq)
    assert len(levels[-1].symbols) == 3                     # one symbol for the text
    x = rng.integers(1, len(w), 500)
    y = np.minimum(x + rng.integers(1, 200, 500), len(w))
    x, y = x[x < y], y[x < y]
    for step in (1, -1):
        want = []
        for a, b in zip(x, y):
            k = 0
            while seq[a + step * k] == seq[b + step * k]:
                k += 1
            want.append(k)
        assert periodic_runs.extend(levels, x, y, step).tolist() == want


def digest_rows(spark, rows, parts=3):
    docs = periodic_runs.with_planted_runs(samples.frame(spark, rows, parts))
    out = periodic_runs.periodic_runs(docs, keep=["doc_id"]).select(
        "doc_id", *periodic_runs.run_digests(F.col("runs"), F.col("collapsed_text")))
    return sorted(map(tuple, out.collect()), key=str)


def expected_digests(rows):
    return sorted(((d, *brute.run_digests(brute.planted(d, t))) for d, t in rows), key=str)


def test_run_query_against_brute_force(spark):
    rng = random.Random(5)
    rows = samples.prose(150) + [(1000 + i, " ".join(f"w{x}" for x in periodic(rng))) for i in range(150)]
    rows += samples.ODD + [(None, "x y " * 20)] * 3
    # Different words of 2,048 bytes that polynomial hashes modulo 2^64 take for equal.
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    rows += [(2001, " ".join([one] * 30)), (2002, " ".join([one, two] * 20)), (2003, " ".join([one] * 23 + [two] * 23))]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 10
    assert digest_rows(spark, rows) == expected_digests(rows)


def test_run_query_of_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text) < 6000]
    got = sorted((tuple(r) for r in QUERIES["op11_recompression_runs"](spark, sf).collect()), key=str)
    kept = {d for d, _ in rows}
    assert [r for r in got if r[0] in kept] == expected_digests(rows)


def test_runs_keep_columns_and_take_odd_long_and_empty_tables(spark):
    df = samples.odd(spark).withColumns({"runs": F.lit(7), "N_words": F.lit("clash")})
    got = periodic_runs.periodic_runs(df)
    assert got.columns == [*df.columns, "_n_words", "_runs", "collapsed_text"]
    assert sorted([(r.doc_id, r.text, r.runs, r._n_words, r.collapsed_text) for r in got.collect()], key=str) == sorted(
        [(d, t, 7, len(brute.words(t)), " ".join(brute.words(t))) for d, t in samples.ODD], key=str)
    assert periodic_runs.periodic_runs(samples.empty(spark)).count() == 0
    long = samples.long_text(60_000)
    row = periodic_runs.periodic_runs(samples.frame(spark, [(1, (long + " ") * 4), (2, "a " * 200_000)], 1)).orderBy("doc_id").collect()
    assert [tuple(x) for x in row[0].runs] == [(0, 240_000, 60_000)] and row[0].collapsed_text == long
    assert [tuple(x) for x in row[1].runs] == [(0, 200_000, 1)] and row[1].collapsed_text == "a"


# -- Operator 12 ---------------------------------------------------------------------------------------------

def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    docs = docs.withColumns({"part": F.lit(1), "mask": F.lit("z"), "good": F.lit(None).cast("int"), "n": F.lit(0)})
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return sorted(map(tuple, filter_audit.audit(docs, marks).collect()))


def test_audit_against_applying_every_order(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        w = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 9) for _ in range(rng.choice([150, 199, 200, 260]))]
        w = w if rng.random() < 0.6 else w[:len(w) // 5] * 5
        t = " ".join(x.title() if rng.random() < 0.02 else x for x in w)
        rows.append((i, t + rng.choice(["", "", " |", " $ &"]), rng.choice(["s1", "s2", "", None])))
    rows += [(200 + i, rows[i][1], "s2") for i in range(0, 60, 2)] + [rows[3], (3, rows[5][1], "s1"), (None, rows[7][1], None)]
    rows += [(None, "one text", "s1")] * 5 + [(d, t, "odd") for d, t in samples.ODD]
    labels = [(i, rng.randrange(2), rng.choice([0, 1, None])) for i in range(0, 230, 3)] + [(0, 1, 1), (None, 1, 1), (6, None, 1)]
    assert audited(spark, rows, labels) == brute.filter_audit(rows, labels)


def test_audit_of_many_copies_null_ids_and_empty_tables(spark):
    rows = [(i % 400, "hot text", "s1") for i in range(1200)] + [(None, "hot text", "s2")] * 800 + [(7, f"text {i}", None) for i in range(300)]
    labels = [(d, 1, d % 2) for d in range(0, 400, 5)]
    assert audited(spark, rows, labels) == brute.filter_audit(rows, labels)
    assert audited(spark, rows, []) == brute.filter_audit(rows, [])
    assert audited(spark, [], labels) == []
    assert audited(spark, [(1, samples.long_text(), "s")], labels) == brute.filter_audit([(1, samples.long_text(), "s")], labels)


# -- Operator 13 ---------------------------------------------------------------------------------------------

def test_toxicity_separates_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op13_weak_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    bad, clean = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    assert np.mean([s >= 0.7 for s in bad]) > 0.85 and np.mean([s >= 0.7 for s in clean]) < 0.005
    assert np.mean([b > c for b in bad for c in clean]) > 0.95
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_labels_of_the_held_out_fold_and_other_columns_are_not_used(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    one = toxicity.learn(docs, labels)
    two = toxicity.learn(docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")}),
                         labels.withColumns({"toxic": F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")), "quality": F.lit(0)}))
    assert np.array_equal(one.codes, two.codes) and np.array_equal(one.weights, two.weights) and one.intercept == two.intercept


@pytest.mark.parametrize("seed", range(3))
def test_label_model_finds_accuracies_and_correlations(seed):
    rng = np.random.default_rng(seed)
    n = 20_000
    truth = rng.random(n) < 0.3
    hit, silent = [0.7, 0.6, 0.5, 0.8, 0.4], [0.95, 0.9, 0.98, 0.85, 0.99]
    votes = np.column_stack([np.where(truth, rng.random(n) < a, rng.random(n) > b) for a, b in zip(hit, silent)])
    copied = np.where(rng.random(n) < 0.9, votes[:, 0], votes[:, 2])                 # repeats the first voter
    votes = np.column_stack([votes, copied])
    guess = np.where(votes[:, :5].sum(axis=1) >= 2, 0.8, 0.2)
    model = toxicity.fit_label_model(votes, np.ones(n), guess, list("abcdef"), rounds=60)
    for name, a, b in zip("abcde", hit, silent):
        assert abs(model.accuracies[name][0] - a) < 0.06 and abs(model.accuracies[name][1] - b) < 0.04
    assert max(model.correlations, key=model.correlations.get) in (("a", "f"), ("f", "a")) and abs(model.prior - 0.3) < 0.04
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.88


def test_posterior_equals_the_product_of_rates():
    model = toxicity.LabelModel(["a", "b"], 0.2, np.array([-1, 0]), np.array([[[0.1, 0.1], [0.6, 0.6]], [[0.2, 0.3], [0.4, 0.9]]]))
    rows = np.array([[True, True], [False, True]])
    both = [0.2 * 0.6 * 0.9 / (0.2 * 0.6 * 0.9 + 0.8 * 0.1 * 0.3), 0.2 * 0.4 * 0.4 / (0.2 * 0.4 * 0.4 + 0.8 * 0.9 * 0.2)]
    assert np.allclose(model.posterior(rows), both)


def test_logistic_regression_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.random((600, 6)) < 0.3
    odds = x @ np.array([3.0, -2.0, 0.0, 0.0, 1.0, 0.0]) - 1
    y = (rng.random(600) < 1 / (1 + np.exp(-odds))).astype(float)
    l1 = 5e-3
    beta, b = toxicity.fit_logistic(x, y, np.ones(600), l1=l1)
    gradient = x.T @ (1 / (1 + np.exp(-(x @ beta + b))) - y) / 600
    assert np.all(np.abs(gradient[beta != 0] + l1 * np.sign(beta[beta != 0])) < 1e-5) and np.all(np.abs(gradient[beta == 0]) <= l1 + 1e-5)


def test_terms_by_hand():
    def of(text):
        data = np.frombuffer(text.encode(), np.uint8)
        codes, _ = toxicity.in_texts(*toxicity.terms(data, np.array([0, len(data)])))
        return {toxicity._spell(int(c)) for c in codes}
    assert of("Idiots, an ode!") == {"idio...", "idiot...", "idiots...", "idiots"}
    assert of("lowa lowab lowac") >= {"many lowa...", "lowa", "lowa...", "lowab"} and "many lowab..." not in of("lowab lowab")
    assert of("lowa lowab " + "x " * 999) == {"lowa", "lowa...", "lowab", "lowab..."}         # too thin to be dense
    assert of("") == of("| 12 a") == set()


def test_toxicity_of_odd_rows_without_labels_and_long_texts(spark):
    df = samples.odd(spark)
    labels = spark.createDataFrame([(4, 0, 0), (6, 0, 1), (7, 1, None), (None, 1, 1), (4, 0, 1), (9, 1, 0), (10, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    for lab in (labels, labels.limit(0), labels.filter("toxic = 0"), labels.withColumn("toxic", F.lit(1))):
        got = toxicity.score(df, toxicity.learn(df, lab))
        assert got.columns == [*df.columns, "_score"]
        rows = got.collect()
        assert len(rows) == len(samples.ODD) and all(0 <= r._score <= 1 and r.score == [1] and r.Kept == "clash" for r in rows)
        assert len({r._score for r in rows if r.text in (None, "")}) == 1
    model = toxicity.learn(df, labels)
    assert toxicity.score(samples.empty(spark), model).count() == 0
    docs = [(i, "plain words here" + ("" if i % 3 else " idiot" if i % 2 else " moron")) for i in range(300)]
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)], "doc_id bigint, quality int, toxic int")
    model = toxicity.learn(samples.frame(spark, docs), marks)
    long = samples.long_text()
    got = toxicity.score(samples.frame(spark, [(1, long), (2, long + " you Idiot"), (3, "moron"), (4, None)]), model)
    assert [r.score >= 0.7 for r in got.orderBy("doc_id").collect()] == [False, True, True, False]


def test_sample_is_bounded_and_the_same_in_every_run(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 20)
    docs = samples.frame(spark, [(i % 60, f"text {i}") for i in range(600)] + [(i, "x" * 40_000) for i in range(60, 90)])
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(90)] * 2, "doc_id bigint, quality int, toxic int")
    made = [sorted(map(tuple, toxicity.sample(docs.repartition(k), marks, "doc_id", "text", "toxic", 3, 1)[0].collect())) for k in (2, 5)]
    assert made[0] == made[1] and 0 < len(made[0]) <= 20
