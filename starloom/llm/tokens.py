"""Token ids of whole texts by a public tokenizer, word by word.

The vocabulary's pre-tokeniser never crosses white space and drops it, so the ids of a text are those of
its words one after another.  Each Python worker keeps the ids of the first ``CACHE`` different words it
meets; the others are encoded once per batch slice.

New words of printable ASCII and the letters of Latin-1 are cut into the pieces that the vocabulary's own
normaliser and pre-tokeniser would make of them (letters, one digit, other signs, in lower case), and the
tokenizer's model is asked once for each of the first ``PIECES`` different pieces; all other words, and other
vocabularies, go through the whole tokenizer.  ``tests/llm`` holds this against whole-text encoding.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import islice, repeat

import numpy as np

VOCABULARY = "word_bpe_49k.json"
CACHE, PIECES = 400_000, 400_000
GROUP = 256

#: The pre-tokeniser's rule, as the vocabulary file has it.
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for lower-case words without ``_ODD`` signs, one word a line; a line's end is a piece as well.
_PIECE = re.compile(r"\n|'(?:[stmd]|re|ve|ll)|[a-zß-öø-ÿ]+|[0-9]|[^\na-z0-9ß-öø-ÿ]+")
#: Signs that may need the whole tokenizer, and what its special tokens begin with.
_ODD = re.compile(r"[^\n!-~À-ÖØ-öø-ÿ]|<\|")


class _Table:
    """Ids of the first ``most`` different keys met, and until the next call those of the keys beyond."""

    def __init__(self, most: int, encode: Callable[[list], tuple[np.ndarray, np.ndarray]]):
        self.most, self.encode = most, encode
        self.index: dict = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)        # of key k's ids in flat; start[k + 1] is their end
        self.known = 0

    def _learn(self, keys: list) -> dict:
        """Append keys to the tables and return their places; those beyond the most are only valid until the next call."""
        ids, sizes = self.encode(keys)
        at = self.start[self.known]
        need, rows = int(at + sizes.sum()), self.known + len(keys) + 1
        if need > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(need, np.uint32)))
        if rows > len(self.start):
            self.start = np.concatenate((self.start, np.zeros(rows, np.int64)))
        self.flat[at:need] = ids
        self.start[self.known + 1:rows] = at + np.cumsum(sizes)
        new = dict(zip(keys, range(self.known, self.known + len(keys))))
        keep = max(0, min(len(keys), self.most - self.known))
        self.index.update(new if keep == len(keys) else islice(new.items(), keep))
        self.known += keep
        return new

    def ids(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the keys one after another, and each key's number of ids."""
        row = np.fromiter(map(self.index.get, keys, repeat(-1)), np.int64, len(keys))
        miss = np.flatnonzero(row < 0)
        if len(miss):
            missed = [keys[i] for i in miss.tolist()]
            new = self._learn(list(dict.fromkeys(missed)))
            row[miss] = np.fromiter(map(new.__getitem__, missed), np.int64, len(missed))
        first = self.start[row]
        size = self.start[row + 1] - first
        after = np.cumsum(size)
        total = int(after[-1]) if len(after) else 0
        return self.flat[np.repeat(first - after + size, size) + np.arange(total)], size


class WordEncoder:
    """Ids of many words at once; ``vocabulary`` is a path, or the name of a public vocabulary file."""

    def __init__(self, vocabulary: str = VOCABULARY, cache: int = CACHE, pieces: int = PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        if not os.path.exists(vocabulary):
            import public_tokenizers
            vocabulary = public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.words, self.pieces = _Table(cache, self._encode), None
        if self._cuts_plainly():
            self.pieces = _Table(pieces, self._encode_pieces)
            self.model = Tokenizer(self.tokenizer.model)        # the same model behind a plain split at spaces
            self.model.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def _cuts_plainly(self) -> bool:
        """Whether ``_PIECE`` cuts words as this tokenizer does, and a token tells whether it ends a piece."""
        tok = self.tokenizer
        if tok.normalizer is None or tok.pre_tokenizer is None or tok.post_processor is not None:
            return False
        normal, cut = json.loads(tok.normalizer.__getstate__()), json.loads(tok.pre_tokenizer.__getstate__())
        steps = [x.get("type") for x in normal.get("normalizers", [])]
        cuts = cut.get("pretokenizers", [])
        suffix = getattr(tok.model, "end_of_word_suffix", None)
        if (steps != ["NFC", "Replace", "Lowercase"] or normal["normalizers"][1]["pattern"] != {"Regex": r"\s+"}
                or [x.get("type") for x in cuts] != ["Split", "ByteLevel"] or cuts[0]["pattern"] != {"Regex": _RULE}
                or (cuts[0]["behavior"], cuts[0]["invert"]) != ("Removed", True) or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]
                or not suffix or any(not t.content.startswith("<|") for t in tok.get_added_tokens_decoder().values())):
            return False
        vocabulary = tok.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        from tokenizers.pre_tokenizers import ByteLevel
        return all(c in vocabulary and c + suffix in vocabulary for c in ByteLevel.alphabet())

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces and each one's number of ids; a line's end has none."""
        real = [p for p in pieces if p != "\n"]
        made = self.model.encode_batch_fast([" ".join(real[i:i + GROUP]) for i in range(0, len(real), GROUP)], add_special_tokens=False)
        ids = np.concatenate([np.array(m.ids, np.uint32) for m in made] or [np.zeros(0, np.uint32)])
        sizes = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        if len(sizes) != len(real):
            raise ValueError("tokens do not tell the ends of pieces")
        out = np.zeros(len(pieces), np.int64)
        out[[p != "\n" for p in pieces]] = sizes
        return ids, out

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words and each word's number of ids."""
        text = b"\n".join(words).decode("utf-8", "replace")          # no word holds a line's end
        if self.pieces is None:
            return self._encode_whole(text.split("\n"))
        odd = np.zeros(len(words), bool)
        if _ODD.search(text):
            texts = text.split("\n")
            odd = np.array([_ODD.search(t) is not None for t in texts])
            if odd.all():
                return self._encode_whole(texts)
            text = "\n".join([t for t, o in zip(texts, odd) if not o])
        pieces = _PIECE.findall(text.lower())
        ids, size = self.pieces.ids(pieces)
        word = np.cumsum(np.fromiter(map("\n".__eq__, pieces), bool, len(pieces)))
        sizes = np.bincount(word, size, word[-1] + 1).astype(np.int64)
        if odd.any():
            more, more_sizes = self._encode_whole([t for t, o in zip(texts, odd) if o])
            both = np.zeros(len(texts), np.int64)
            both[~odd], both[odd] = sizes, more_sizes
            ids_of = np.repeat(odd, both)
            out = np.zeros(len(ids) + len(more), np.uint32)
            out[~ids_of], out[ids_of] = ids, more
            return out, both
        return ids, sizes

    def _encode_whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words and each word's number of ids, by the whole tokenizer.

        Many words are encoded as one text; where a token starts tells its word.
        """
        ids, sizes = [], np.zeros(len(texts), np.int64)
        groups = [texts[i:i + GROUP] for i in range(0, len(texts), GROUP)]
        for k, (group, made) in enumerate(zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False))):
            start = np.cumsum([0] + [len(x) + 1 for x in group[:-1]])
            place = np.fromiter((x[0] for x in made.offsets), np.int64, len(made.ids))
            owner = np.searchsorted(start, place, side="right") - 1
            sizes[k * GROUP:k * GROUP + len(group)] = np.bincount(owner, minlength=len(group))
            ids.append(np.array(made.ids, np.uint32))
        return np.concatenate(ids), sizes

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and each text's first id (n+1 bounds)."""
        words: list[bytes] = []
        ends = [0]
        for t in texts:
            if t:
                words += t.split()                      # ASCII white space only
            ends.append(len(words))
        ids, size = self.words.ids(words)
        return ids, np.concatenate(([0], np.cumsum(size)))[ends]


_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    """This worker's encoder."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return _ENCODERS[vocabulary]
