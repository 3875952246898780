"""64-bit FNV-1a of a string, with an optional seed.

Built from higher-order SQL functions, no UDF.  The 64-bit state is carried
as two 32-bit halves so every product fits a signed 64-bit integer and ANSI
overflow checks never fire.  Meant for small dimension tables; where the
stored number does not matter, ``xxhash64`` is cheaper.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FNV-1a 64-bit offset basis (0xcbf29ce484222325 as a signed
# long) and prime 2**40 + 435.
FNV64_OFFSET = -3750763034362895579
FNV64_PRIME_LOW = 435
MASK32 = 0xFFFFFFFF


def fnv1a64(c: Column | str, seed: Column | int | None = None) -> Column:
    """FNV-1a over the UTF-8 bytes of ``c``; the empty string hashes to the seed."""
    c = F.col(c) if isinstance(c, str) else c
    seed_col = F.lit(FNV64_OFFSET if seed is None else seed) if not isinstance(seed, Column) else seed
    seed_col = seed_col.cast("bigint")
    raw = F.encode(c, "UTF-8")
    byte_values = F.transform(
        F.sequence(F.lit(1), F.length(raw)),
        lambda i: F.conv(F.hex(F.substring(raw, i, 1)), 16, 10).cast("bigint"))
    start = F.struct(F.shiftrightunsigned(seed_col, 32).alias("hi"),
                     (seed_col.bitwiseAND(F.lit(MASK32))).alias("lo"))

    def step(acc, b):
        x = acc["lo"].bitwiseXOR(b)
        low_product = x * FNV64_PRIME_LOW
        hi = (acc["hi"] * FNV64_PRIME_LOW + F.shiftrightunsigned(low_product, 32) + x * 256)
        return F.struct(hi.bitwiseAND(F.lit(MASK32)).alias("hi"),
                        low_product.bitwiseAND(F.lit(MASK32)).alias("lo"))

    folded = F.aggregate(byte_values, start, step,
                         lambda acc: F.shiftleft(acc["hi"], 32).bitwiseOR(acc["lo"]))
    return F.when(c == "", seed_col).otherwise(folded)


def fnv1a64_chain(cols: list[Column | str]) -> Column:
    """``hash(c1, hash(c2, ... hash(cn)))``, the tracked-columns hash.

    A NULL column passes on the hash behind it with all bits turned, so NULL
    is a value like any other (and not the empty string).
    """
    h = F.lit(FNV64_OFFSET)
    for c in reversed(cols):
        c = F.col(c) if isinstance(c, str) else c
        h = F.when(c.isNull(), F.bitwise_not(h)).otherwise(fnv1a64(c, h))
    return h
