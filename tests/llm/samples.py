"""Small tables that the tests of all operators share."""

import random

from pyspark.sql import functions as F

#: Texts and ids that every operator must take: nulls, empty and word-less texts, repeated rows, ties.
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (6, "a b c d"), (None, "a b c d"), (None, None),
       (7, "é ü\xa0x ÀB"), (8, "x\x0by\x0cz\r\n"), (9, "same line\nsame line\n\nsame line"), (10, "|||| #### ***")]




def odd(spark):
    """The odd rows in three partitions, with columns whose names clash with those the operators add."""
    df = spark.createDataFrame(ODD, "doc_id bigint, text string").repartition(3)
    return df.withColumns({"lang": F.lit("en"), "source": F.when(F.col("doc_id") < 6, "s1").when(F.col("doc_id") < 9, "s2"),
                           "n_chars": F.length("text"), "Kept": F.lit("clash"), "fp": F.lit(1.5),
                           "keep_id": F.lit(None).cast("string"), "id": F.lit("x"), "score": F.array(F.lit(1)),
                           "mix_shard": F.lit(0), "order": F.lit("z"), "epoch": F.lit(None).cast("int")})


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def long_text(n=120_000, seed=5):
    rng = random.Random(seed)
    return " ".join("w%d" % rng.randrange(3000) for _ in range(n))


def thue_morse(n):
    """Two different words of ``n`` bytes that a polynomial modulo 2**64 cannot tell apart."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def prose(n_docs=120, seed=3, lines=True):
    """(id, text): made-up documents with exact copies, edited copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randrange(1, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    out = []
    for i in range(n_docs):
        kind = rng.random()
        if out and kind < 0.15:
            text = rng.choice(out)[1]
        elif out and kind < 0.3:
            w = rng.choice(out)[1].split(" ")
            w[rng.randrange(len(w))] = "edited"
            text = " ".join(w)
        else:
            w = [rng.choice(vocabulary) + rng.choice(["", "", "", ".", "\n" if lines else ""]) for _ in range(rng.randrange(1, 160))]
            text = " ".join(w)
            if kind < 0.5:
                text = text[:len(text) // 2] + " " + passage + "\n" + text[len(text) // 2:]
        out.append((i, text))
    return out


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
