"""Operator 8, quality rules: a rule bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements and one failure bit per
rule as a table of the shared folder (no texts); ``apply_policy`` (a named, versioned mask) and ``ablations`` (what each rule of a policy does, alone
and beyond the others) read only the stored bits.

Defined results: a null or empty text has zero words and fails ``few_words`` only; repeated rows are
measured each on its own; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (buffers, covered, gram_starts, mix64, on_workers, per_text, range_hash, slices, spans, stored, text_hash)

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters")
#: Each rule: its bit and when a document fails it.  Bits keep their meaning for ever; a changed rule gets a new bit.
RULES: dict[str, tuple[int, Column | str]] = {
    "few_words": (0, "n_words < 20"),
    "repeat_words": (1, "100 * n_repeat_words > 30 * n_words"),
    "symbols": (2, "100 * n_symbols > 20 * n_words"),
    "dup_lines": (3, "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    "short_words": (4, "n_words >= 20 AND word_chars < 2 * n_words"),
    "long_words": (5, "n_words >= 20 AND word_chars > 25 * n_words"),
    "shouting": (6, "n_letters >= 50 AND 100 * n_upper > 60 * n_letters"),
}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES[r][0] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeat_words"))
WEB = Policy("web", 1, tuple(RULES))

_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_UPPER = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))
_ALPHA = _UPPER | np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1))


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of the texts in one buffer."""
    s, e, first = spans(data, offsets)
    n = len(offsets) - 1
    begins = (data & 0xC0) != 0x80                                       # first byte of a character
    chars = np.concatenate(([0], np.cumsum(begins, dtype=np.int64)))
    out = {"n_words": np.diff(first), "word_chars": _ranges(chars[e] - chars[s], first),
           "n_symbols": per_text(_SYMBOL[data], offsets), "n_upper": per_text(_UPPER[data], offsets),
           "n_letters": per_text(_ALPHA[data], offsets)}
    # Lines: between newlines and text ends; those with a word are compared within their text.
    breaks = np.flatnonzero(data == 0x0A)
    full = offsets[:-1] < offsets[1:]
    ls = np.sort(np.concatenate((offsets[:-1][full], (breaks + 1)[~np.isin(breaks + 1, offsets)])))
    newline = np.append(breaks, len(data))[np.searchsorted(breaks, ls)]
    le = np.minimum(newline, offsets[np.searchsorted(offsets, ls, side="right")])
    has_word = np.searchsorted(s, ls) < np.searchsorted(s, le)
    ls, le = ls[has_word], le[has_word]
    doc = np.searchsorted(offsets, ls, side="right") - 1
    _, keep = np.unique(_in_text(text_hash(data, ls, le), doc), return_index=True)
    out["n_lines"] = np.bincount(doc, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(doc[keep], minlength=n)
    # Windows of eight words found twice or more in their text.
    p, doc = gram_starts(first, WINDOW)
    _, inverse, count = np.unique(_in_text(range_hash(text_hash(data, s, e), p, p + WINDOW), doc),
                                  return_inverse=True, return_counts=True)
    out["n_repeat_words"] = per_text(covered(p[count[inverse] > 1], WINDOW, len(s)), first)
    return out


def _ranges(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return c[bounds[1:]] - c[bounds[:-1]]


def _in_text(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix64(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _measure_batches(batches):
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        parts = []
        for i, j in slices(offsets):
            parts.append(measure(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
        cols = [np.concatenate([x[m] for x in parts]) if parts else np.zeros(0) for m in MEASURES]
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c.astype(np.int64)) for c in cols]],
                                         names=[batch.schema.names[0], *MEASURES])


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the measurements, ``failed``), a stored table: ``failed`` has one bit per rule of ``RULES``."""
    on_workers(df.sparkSession)
    schema = f"id {df.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_measure_batches, schema)
    bits = sum((F.when(F.expr(cond), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, cond in RULES.values()),
               F.lit(0)).cast("long")
    return stored(rows.withColumn("failed", bits), "rule-ledger").withColumnRenamed("id", id_col)


def apply_policy(book: DataFrame, policy: Policy, out: str = "kept") -> DataFrame:
    """The ledger with ``out``: no rule of the policy failed."""
    return book.withColumn(out, F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: how many documents fail it, how many fail nothing else (and so come back
    without it), and how many the policy keeps.  One aggregate over the distinct bit patterns."""
    masked = F.col("failed").bitwiseAND(F.lit(policy.mask))
    patterns = book.groupBy(masked.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r][0]).cast("long").alias("bit"))
                                for r in policy.rules])).alias("r")
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return patterns.select("bits", "n", rules).groupBy("r.rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("kept"))
