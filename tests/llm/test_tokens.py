"""Token ids, Simple-8b files and packing: round trips and whole-text encoding."""

import zlib

import numpy as np
import public_tokenizers
import samples
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import simple8b
from starloom.llm.packing import Packer, pack
from starloom.llm.tokens import VOCABULARY, WordEncoder


def whole(texts, end):
    tok = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    return [np.append(x.ids, end).astype("<u4") for x in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


TEXTS = [None, "", " \t", "Hello, WORLD's don't 3.14 éa ́x", "<|endoftext|> a<|startoftext|>b", "日本語 text　wide space",
         "x\x1cy\x85z", "😀👍🏽 a‍b", "\x00 \x7f", "ΑΣ ΑΣΑ Σ", "İstanbul ß ﬁ", "a" * 3000, samples.long_text(3000)]


def test_words_encode_as_whole_texts():
    for cache in (5, 10_000):
        enc = WordEncoder(cache=cache)
        for _ in range(2):
            ids, bounds = enc.encode([t and t.encode() for t in TEXTS])
            for k, w in enumerate(whole(TEXTS, 0)):
                assert ids[bounds[k]:bounds[k + 1]].tolist() == w[:-1].tolist(), TEXTS[k]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2 ** 64 - 1)), max_size=300))
def test_simple8b_round_trip(ids):
    words, escapes = simple8b.encode(np.array(ids, np.uint64))
    assert simple8b.decode(words, len(ids), escapes).tolist() == ids


def test_simple8b_packs_small_ids_tightly():
    words, _ = simple8b.encode(np.zeros(6000, np.uint64))
    assert len(words) == 100
    words, _ = simple8b.encode(np.full(3000, 40_000, np.uint64))
    assert len(words) == 1000


def test_token_files(spark):
    rows = samples.prose(80) + [(500 + i, t) for i, t in enumerate(TEXTS)] + [(5, "dup id"), (5, "dup id"), (None, "none")]
    df = samples.frame(spark, rows)
    got = [tuple(r) for r in simple8b.token_files(df, block_ids=50).collect()]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, expected = 0, []
    for (d, _), ids in zip(ordered, whole([t for _, t in ordered], 1)):
        expected.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected
    assert simple8b.token_files(samples.empty(spark)).count() == 0


def check_pieces(rows, full, limits, loss=None):
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(full)
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(full[d])
            assert r.ids_crc32 == zlib.crc32(full[d][at:at + r.length].tobytes())
            at += r.length
        assert at == len(full[d])
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits[0] and len(pieces) <= limits[1] and sum(r.loss_tokens for r in pieces) <= limits[2]
        padding += 0 if at & (at - 1) == 0 else limits[0] - at
    return padding


def test_packing_covers_every_id_without_padding(spark):
    rows = samples.prose(150) + [(500 + i, t) for i, t in enumerate(TEXTS)] + [(900, samples.long_text(9000))]
    got = pack(samples.frame(spark, rows)).collect()
    full = dict(zip([d for d, _ in rows], whole([t for _, t in rows], 2)))
    assert check_pieces(got, full, (4096, 128, 4096)) == 0
    again = pack(samples.frame(spark, rows)).collect()
    assert {r.doc_id for r in again} == set(full)
    assert pack(samples.empty(spark)).count() == 0
    assert pack(samples.odd(spark)).select("doc_id").distinct().count() == len({d for d, _ in samples.ODD})


def test_very_short_texts_pack_without_padding(spark):
    rows = [(i, "a b" if i % 3 else None) for i in range(9000)] + [(20_000, samples.long_text(3000))]
    got = pack(samples.frame(spark, rows), max_segments=4096).collect()
    full = dict(zip([d for d, _ in rows], whole([t for _, t in rows], 2)))
    assert check_pieces(got, full, (4096, 4096, 4096)) == 0
    assert len({r.sequence_id for r in got}) < 60


def test_packing_holds_all_three_limits(spark):
    rows = [(i, f"question {i} " * (i % 5), "answer word " * (1 + i % 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, prompt string, text string").repartition(2)
    got = pack(df, prompt_col="prompt", max_tokens=256, max_segments=6, max_loss=90, with_ids=True).collect()
    prompts, answers = whole([r[1] for r in rows], 0), whole([r[2] for r in rows], 2)
    full = {r[0]: np.concatenate((p[:-1], a)) for r, p, a in zip(rows, prompts, answers)}
    check_pieces(got, full, (256, 6, 90))
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    for r in rows:
        assert sum(x.loss_tokens for x in got if x.doc_id == r[0]) == len(answers[r[0]])


def test_conversations_pack(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = pack(turns.withColumnRenamed("conv_id", "doc_id"), max_tokens=512, max_segments=4)
    n = got.groupBy("sequence_id").agg({"length": "sum", "*": "count"}).collect()
    assert n and max(r["count(1)"] for r in n) <= 4 and max(r["sum(length)"] for r in n) <= 512


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 200), st.integers(0, 40)), max_size=60), st.integers(1, 5), st.integers(1, 64))
def test_packer_places_every_token_once(examples, segments, loss):
    packer = Packer(64, segments, loss, waiting=8)
    pieces = []
    for key, (n, prompt) in enumerate(examples):
        pieces += packer.add(key, n, min(n, prompt))
    pieces += packer.finish()
    for key, (n, _) in enumerate(examples):
        own = sorted((p.start, p.length) for p in pieces if p.key == key)
        assert sum(k for _, k in own) == n and all(a + k == b for (a, k), (b, _) in zip(own, own[1:]))
    for s in {p.sequence for p in pieces}:
        own = [p for p in pieces if p.sequence == s]
        quiet = sum(max(0, p.start + p.length - max(p.start, min(examples[p.key]))) for p in own)
        assert len(own) <= segments and sum(p.length for p in own) <= 64 and quiet <= max(loss, 1)
