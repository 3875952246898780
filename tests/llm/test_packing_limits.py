"""The packing query holds the operator's limits, and sequences that run out of segments need no padding."""

from hypothesis import given, settings
from hypothesis import strategies as st
from test_tokens import check_pieces, whole

import samples
from starloom.llm.packing import MAX_SEGMENTS, MAX_TOKENS, Packer, pack
from starloom.llm.queries import op9_vector_packing


def power_of_two(n):
    return n & (n - 1) == 0


def test_the_query_holds_all_limits_without_padding(spark, tmp_path):
    rows = [(i, "a b" if i % 3 else None) for i in range(9000)] + [(20_000, samples.long_text(3000))]
    samples.frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = op9_vector_packing(spark, str(tmp_path)).collect()
    full = dict(zip([d for d, _ in rows], whole([t for _, t in rows], 2)))
    assert check_pieces(got, full, (MAX_TOKENS, MAX_SEGMENTS, MAX_TOKENS)) == 0
    lengths = {}
    for r in got:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert all(power_of_two(n) for n in lengths.values())
    assert sum(r.length for r in got) == sum(map(len, full.values()))


def test_segments_run_out_at_a_power_of_two(spark):
    rows = [(i, f"question {i} " * (i % 5), "answer word " * (1 + i % 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, prompt string, text string").repartition(2)
    got = pack(df, prompt_col="prompt", max_tokens=256, max_segments=6, max_loss=90).collect()
    lengths = {}
    for r in got:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert all(power_of_two(n) for n in lengths.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 200), st.integers(0, 40)), max_size=60), st.integers(1, 5), st.integers(1, 64))
def test_packed_sequences_are_powers_of_two(examples, segments, loss):
    packer = Packer(64, segments, loss, waiting=8)
    pieces = []
    for key, (n, prompt) in enumerate(examples):
        pieces += packer.add(key, n, min(n, prompt))
    pieces += packer.finish()
    for key, (n, _) in enumerate(examples):
        own = sorted((p.start, p.length) for p in pieces if p.key == key)
        assert sum(k for _, k in own) == n and all(a + k == b for (a, k), (b, _) in zip(own, own[1:]))
    for s in {p.sequence for p in pieces}:
        own = sorted((p.offset, p.length) for p in pieces if p.sequence == s)
        assert power_of_two(sum(k for _, k in own)) and own[0][0] == 0
        assert all(a + k == b for (a, k), (b, _) in zip(own, own[1:])) and len(own) <= segments
