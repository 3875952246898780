"""Marks inside ever new words are terms of operator 13."""

import random
import zlib

import numpy as np
import pyarrow as pa

from starloom.llm import toxicity
from starloom.llm.common import buffers

SYLLABLES = "en er sch ver be ge ung lich keit heit ein zu ach au te st".split()


def word(rng, inner=""):
    return "".join(rng.choices(SYLLABLES, k=rng.choice((2, 3)))) + inner + rng.choice(SYLLABLES)


def test_inner_parts_are_found_where_dense_and_alike_with_and_without_a_base():
    data, offsets = buffers(pa.array(["axlowei bülowei", "axlowei axlowei", "xlowei " + "b " * 500 + "ylowei", "", "lowei"], pa.string()))
    lowe = np.uint64(int.from_bytes(b"lowe", "little") | (0x14 << 56))
    codes, text = toxicity.in_texts(*toxicity.terms(data, offsets))
    dense = lowe | np.uint64(0x40 << 56)
    assert text[codes == dense].tolist() == [0] and not (codes == lowe).any()
    known = np.unique(codes)
    rows, which = toxicity._hits(data, offsets, known, toxicity._base(known))
    assert sorted(zip(rows.tolist(), known[which].tolist())) == sorted(zip(text.tolist(), codes.tolist()))


def test_marks_inside_new_words_are_learnt(spark):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = [word(rng) for _ in range(80)]
        for k in rng.sample(range(80), 4) if toxic else ():
            words[k] = word(rng, "lowei")
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.learn(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(frame, model).select("doc_id", "score").collect()}
    held = [i for i in scores if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([scores[i] >= 0.7 for i in held if i % 6 == 0]) > 0.9
    assert np.mean([scores[i] < 0.7 for i in held if i % 6]) > 0.97
