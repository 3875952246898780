"""Word ids made of pieces (operators 6 and 9) against the whole tokenizer."""

import random

from starloom.llm.tokens import WordEncoder

SIGNS = [*"abcXYZéÉßÿÀ÷×'''0123.,!?<|>/wªµ́Å’ \n\t\x1c\x85İΣ中🙂½²", "<|endoftext|>", "'s", "'RE", "</w>", "I'll", "don't"]


def whole(enc, texts):
    return [enc.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]


def by_words(enc, texts):
    ids, bounds = enc.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_pieces_give_the_ids_of_whole_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(15))).encode() for _ in range(4000)] + [b"\xff\xc3 ab\xe9", b"", b"\n"]
    for enc in (WordEncoder(), WordEncoder(cache=50, pieces=7), WordEncoder(cache=0, pieces=0)):
        for i in range(0, len(texts), 500):
            assert by_words(enc, texts[i:i + 500]) == whole(enc, texts[i:i + 500])


def test_new_words_of_known_pieces_do_not_reach_the_whole_tokenizer():
    enc, asked = WordEncoder(), []
    plain = enc.tokenizer

    class Watched:
        def encode_batch(self, texts, **how):
            asked.extend(texts)
            return plain.encode_batch(texts, **how)

    enc.tokenizer = Watched()
    texts = [f"{a}-{b}, (É{b}?) {a}'s".encode() for a in ("wug", "Blick", "été") for b in ("zorp", "Straße")]
    got = by_words(enc, texts)
    enc.tokenizer = plain
    assert got == whole(enc, texts) and not asked
