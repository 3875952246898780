"""Filter interaction audit by the Hart-Mas-Colell potential of the removal game.

Five filters judge every document of the table, whatever another filter does:

* A: under 200 words; B: 100 x distinct words < 50 x words; C: 100 x ``[A-Z]`` > 2 x code points;
  D: holds any ``[#$%&*|]``; E: identical to the text of any smaller id, table-wide.

In the removal game of a part (a source) the worth v(S) of a coalition S of filters is the number of
documents that fail one of them.  Its potential is P(S) = (v(S) + sum of P(S without i) over i in S) / |S|, the
Shapley value of filter i is P(all) - P(all without i), and what a filter removes after others is a
difference of two coalitions.  Potentials are kept as whole numbers, Q(S) = |S|! P(S), so that 120 Shapley
values of a filter are Q(all) - 5 Q(all without i) exactly.

The documents are read once, into rows of digest, id, part and failed conditions.  Copies of one text are
counted before they are shuffled (a text is known by its SHA-256); the smallest id of each text is joined to
rows per (text, part, labels), of which a text copied a million times has a few.  All else is arithmetic
on at most 32 rows for each part.  Nothing but DataFrame functions is used.

Defined results: a null or empty text has no words and no code points (it fails A only, and E as a copy); a null
part counts as the empty string; a row with a null id has no smaller id and is none (it never fails E and
makes no other row fail it), and has no label; rows that share an id and a text are not smaller than each other;
of several label rows of an id any 1 counts; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, small, stored

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
#: (k - 1)! for a coalition of k filters.
_WEIGHT = [0, 1, 1, 2, 6, 24]


def failures(text: Column) -> Column:
    """Bits 0 to 3: the failed conditions A to D of a text."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    wide = F.lit(100).cast("bigint")
    failed = [n < 200, wide * F.size(F.array_distinct(words)) < F.lit(50).cast("bigint") * n, wide * upper > 2 * F.length(text),
              text.rlike(r"[#$%&*|]")]
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failed)), F.lit(0))


def _label_flags(labels: DataFrame, id_col: str) -> DataFrame:
    """One row per labelled id."""
    return (labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id"))
            .agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
                 F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("bad")))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, bad): documents, good and toxic ones of each part by their failed filters."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("text_id"), failures(F.col(text_col)).alias("failed"))
    rows = stored(rows.groupBy("id", "part", "text_id").agg(F.min("failed").alias("failed"), F.count(F.lit(1)).alias("n")),
                  "audit-rows")
    # Null ids are dealt by their texts: they find no label, but would all meet in one task.
    rows = rows.withColumns({"key": F.coalesce(F.xxhash64("id"), F.lit(0)), "no_id": F.col("id").isNull()})
    rows = rows.withColumn("key", F.when(F.col("no_id"), F.xxhash64("text_id", "part")).otherwise(F.col("key")))
    flags = small(stored(_label_flags(labels, id_col), "audit-labels"))
    flags = flags.withColumns({"key": F.xxhash64("label_id"), "no_id": F.lit(False)})
    known = rows.alias("r").join(flags.alias("l"), (F.col("r.key") == F.col("l.key")) & (F.col("r.no_id") == F.col("l.no_id"))
                                 & (F.col("r.id") == F.col("l.label_id")), "left")
    known = known.select("r.id", "part", "text_id", "failed", "n", F.coalesce("good", F.lit(False)).alias("good"),
                         F.coalesce("bad", F.lit(False)).alias("bad"))
    with_id = F.col("id").isNotNull()
    texts = stored(known.groupBy("text_id", "part", "good", "bad").agg(
        F.min("failed").alias("failed"), F.sum("n").alias("n"), F.coalesce(F.sum(F.when(with_id, F.col("n"))), F.lit(0)).alias("n_ids"),
        F.min(F.when(with_id, F.struct("id", "n"))).alias("first")), "audit-texts")
    least = texts.groupBy("text_id").agg(F.min("first.id").alias("least_id"))
    copies = F.col("n_ids") - F.coalesce(F.when(F.col("first.id") == F.col("least_id"), F.col("first.n")), F.lit(0))
    counted = texts.join(least, "text_id").withColumn("copies", copies)
    both = F.array(F.struct(F.col("failed").alias("mask"), (F.col("n") - F.col("copies")).alias("k")),
                   F.struct((F.col("failed") + 16).alias("mask"), F.col("copies").alias("k")))
    each = counted.select("part", "good", "bad", F.explode(both).alias("x"))
    return each.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.k").alias("n"), F.coalesce(F.sum(F.when(F.col("good"), F.col("x.k"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("bad"), F.col("x.k"))), F.lit(0)).alias("bad"))


def _worths(by_mask: Column, field: str) -> Column:
    """v(S) for the 32 coalitions S = 0 ... 31: rows whose failed filters meet S."""
    def worth(s):
        return F.aggregate(by_mask, F.lit(0).cast("bigint"),
                           lambda acc, x: acc + F.when(x["mask"].bitwiseAND(s) != 0, x[field]).otherwise(F.lit(0).cast("bigint")))
    return F.transform(F.sequence(F.lit(0), F.lit(ALL)), worth)


def _at(values: Column, i) -> Column:
    return F.coalesce(F.get(values, i if isinstance(i, Column) else F.lit(i)), F.lit(0).cast("bigint"))


def potentials(worths: Column) -> Column:
    """|S|! P(S) for the 32 coalitions, each from those with one filter less (which have smaller numbers)."""
    weight = F.array(*[F.lit(w).cast("bigint") for w in _WEIGHT])

    def grow(done, s):
        less = sum((F.when(s.bitwiseAND(F.lit(1 << i)) != 0, _at(done, s.bitwiseXOR(F.lit(1 << i))))
                    .otherwise(F.lit(0).cast("bigint")) for i in range(len(FILTERS))), F.lit(0).cast("bigint"))
        return F.concat(done, F.array(_at(weight, F.bit_count(s)) * _at(worths, s) + less))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("bigint")), grow)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): what
    each filter does at each step of each of the 120 orders, per part."""
    by_mask = judged(docs, labels, id_col, text_col, part_col)
    # At most 32 entries for a part.
    parts = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("rows"), F.sum("n").alias("total"))
    games = parts.select("part", "total", _worths(F.col("rows"), "n").alias("v"), _worths(F.col("rows"), "good").alias("vg"),
                         _worths(F.col("rows"), "bad").alias("vb"))
    games = stored(games.withColumn("q", potentials(F.col("v"))), "audit-games")
    orders = F.split(F.lit(" ".join("".join(p) for p in permutations(FILTERS))), " ")
    steps = games.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = sum((F.when(F.substring("filter_order", F.col("step"), F.lit(1)) == x, 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))
    before = sum((F.when(F.instr("filter_order", x) < F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))
    steps = steps.withColumns({"bit": bit, "before": before})
    after = F.col("before") + F.col("bit")

    def added(v):
        return _at(F.col(v), after) - _at(F.col(v), F.col("before"))
    without = F.lit(ALL) - F.col("bit")
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - _at(F.col("v"), after)).alias("kept"), added("v").alias("removed"),
        (_at(F.col("v"), F.col("bit")) - added("v")).alias("redundant"),
        (_at(F.col("v"), ALL) - _at(F.col("v"), without)).alias("unique_fails"), added("vg").alias("good_lost"),
        added("vb").alias("toxic_lost"), (_at(F.col("q"), ALL) - 5 * _at(F.col("q"), without)).alias("shapley"))
