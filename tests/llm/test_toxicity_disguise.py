"""Short words, pairs of words, tokens with signs and words in disguise are terms of operator 13."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import toxicity
from starloom.llm.common import buffers

SYLLABLES = "en er sch ver be ge ung lich keit heit ein zu ach au te st".split()
MARKS = {"short": ["qi", "ozx", "wup"], "pair": ["enver beach", "schau zuge"], "signs": ["x#q", "k7*p", "88"], "plain": ["qumbo", "zarnix"]}


def found(text):
    data, offsets = buffers(pa.array([text, "", None], pa.string()))
    codes, at = toxicity.other_terms(data, offsets)
    assert not at.any() and len(np.unique(codes)) == len(codes)
    return {toxicity._spell(int(c)) for c in codes}


def test_other_terms_by_hand():
    kinds = sorted(t.split(" ")[0] for t in found("an ode, an ode (1st)"))
    assert kinds == ["frequent", "frequent", "pair", "pair", "pair", "short", "short", "short", "token"]
    assert found("") == found(" ,. ") == set()


@pytest.mark.parametrize("text", ["1d1ot!", "i.d.i.o.t", "(i-d-i-o-t)", "an i d i o t", "idiooot", "ID!OT.", "іdіоt", "ïdïöt#", "i​diot"])
def test_words_in_disguise_stand_for_words(text):
    assert {"idiot", "idio..."} <= found(text)


def test_a_word_plain_and_in_disguise_counts_once():
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array(["idiot 1diot"], pa.string())], names=["y", "text"])
    codes = pa.Table.from_batches(list(toxicity._count_batches([batch])))
    assert set(codes["pos"].to_pylist()) == {1} and len(set(codes["code"].to_pylist())) == len(codes)


@pytest.mark.parametrize("kind", MARKS)
def test_marks_are_learnt(spark, kind):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(900):
        words = ["".join(rng.choices(SYLLABLES, k=rng.choice((2, 3)))) for _ in range(80)]
        for k in rng.sample(range(80), 4) if i % 6 == 0 else ():
            words[k] = rng.choice(MARKS[kind])
        text = " ".join(words)
        if kind == "plain" and zlib.crc32(str(i).encode()) % 3 == 1:           # in disguise only where nothing is learnt
            text = text.replace("qumbo", "q.u.m.b.o").replace("zarnix", "z4rn1x")
        docs.append((i, text))
        labels.append((i, int(i % 6 == 0)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.learn(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(frame, model).select("doc_id", "score").collect()}
    held = [i for i in scores if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([scores[i] >= 0.7 for i in held if i % 6 == 0]) > 0.9
    assert np.mean([scores[i] < 0.7 for i in held if i % 6]) > 0.97
