"""Operator 1, mixing sources to target weights: a multivariate-hypergeometric splitting tree.

DataFrame and SQL functions only.

1. Every source gets a target in words (weights 1, 2, 3, ... of the total, water-filled under a limit of
   ``MAX_REPEATS`` times the source).
2. A source is cut into blocks of about ``BLOCK_WORDS`` words by a hash of its rows.  Its quota is an exact
   number of blocks: each whole pass over the source takes all its blocks, the last pass those that come
   first in a permutation of the blocks, and the block where the target is reached is cut between rows.
3. The tree splits the vector of quotas: a node deals half of its blocks to either child, and how many of
   each source go left is a multivariate hypergeometric draw (source by source, each a hypergeometric
   draw given those before).  Leaves are the output shards; quotas stay exact at every level.
4. A shard draws its share of a source as consecutive places in a second permutation of the source's
   blocks, so shards are disjoint, and orders its rows by a hash.

All randomness is a hash of ``seed`` and names, so reruns agree.  Tables of blocks and shards are made by
aggregates and joins; running sums go through ``CELLS`` hash cells per source, so a source that holds a
third of all rows is not ordered in one task.  The table of sources (a name, a size, a target) is the only
one that is ordered as a whole.

Defined results: a null or empty text has size 0 and takes no words; null is a source of its own, the
last; rows with the same id and text are taken alike; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_name, small, stored

BLOCK_WORDS = 1 << 16
SHARD_WORDS = 1 << 24
MAX_REPEATS = 3
CELLS = 256


def _bits(*parts) -> Column:
    """A uniform 53-bit integer from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11)


def _uniform(*parts) -> Column:
    return _bits(*parts) / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """The number of good ones among ``draws`` drawn from ``total``, by inversion at a uniform ``u``.

    Outcomes are enumerated from the mode upwards, then from the mode downwards, with probabilities
    relative to the mode's (by their ratios), up to 12 standard deviations on either side, beyond which
    nothing is left in double precision; the first whose running sum passes ``u`` of the whole is drawn.
    """
    def of(v):
        n, k, d, x = (v[c] for c in ("n", "k", "d", "u"))
        return _let(F.struct(
            n.alias("n"), k.alias("k"), d.alias("d"), x.alias("u"),
            F.greatest(F.lit(0).cast("long"), d + k - n).alias("low"), F.least(d, k).alias("high"),
            F.floor((d + 1).cast("double") * (k + 1) / (n + 2)).cast("long").alias("mode"),
            F.ceil(12 * F.sqrt(d.cast("double") * k * (n - k) * (n - d) / F.greatest(n * 1.0 * n * (n - 1), F.lit(1.0))) + 12)
            .cast("long").alias("reach")), lambda w: _let(F.struct(
                *[w[c].alias(c) for c in ("n", "k", "d", "u")],
                F.greatest(w["low"], F.least(w["high"], w["mode"])).alias("mode"),
                F.greatest(w["low"], w["mode"] - w["reach"]).alias("a"),
                F.least(w["high"], w["mode"] + w["reach"]).alias("b")), walk))

    def walk(w):
        n, k, d, mode = w["n"], w["k"], w["d"], w["mode"]
        none = F.array().cast("array<bigint>")
        ups = F.when(w["b"] > mode, F.sequence(mode + 1, w["b"])).otherwise(none)
        downs = F.when(w["a"] < mode, F.sequence(mode - 1, w["a"], F.lit(-1).cast("long"))).otherwise(none)

        def up(x):        # p(x) / p(x - 1)
            return (k - x + 1).cast("double") * (d - x + 1) / (x.cast("double") * (n - k - d + x))

        def down(x):      # p(x) / p(x + 1)
            return (x + 1).cast("double") * (n - k - d + x + 1) / ((k - x).cast("double") * (d - x))

        def tail(xs, ratio):
            return F.aggregate(xs, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("s")),
                               lambda acc, x: F.struct((acc["p"] * ratio(x)).alias("p"),
                                                       (acc["s"] + acc["p"] * ratio(x)).alias("s")))["s"]

        def pick(xs, ratio, begin):       # begin: probability mass before xs, and the pick so far
            return F.aggregate(xs, F.struct(F.lit(1.0).alias("p"), begin["s"].alias("s"), begin["x"].alias("x")),
                               lambda acc, x: F.struct(
                                   (acc["p"] * ratio(x)).alias("p"), (acc["s"] + acc["p"] * ratio(x)).alias("s"),
                                   F.when((acc["x"] < 0) & (acc["s"] + acc["p"] * ratio(x) > begin["t"]), x)
                                   .otherwise(acc["x"]).alias("x")))

        mass = _let(F.struct(tail(ups, up).alias("up"), tail(downs, down).alias("down")),
                    lambda m: F.struct(F.lit(1.0).alias("s"), (w["u"] * (1.0 + m["up"] + m["down"])).alias("t")))
        start = _let(mass, lambda m: F.struct(m["s"].alias("s"), m["t"].alias("t"),
                                              F.when(m["t"] < 1.0, mode).otherwise(F.lit(-1).cast("long")).alias("x")))
        after = _let(start, lambda m: F.struct(m["t"].alias("t"), pick(ups, up, m).alias("r")))
        both = _let(after, lambda m: pick(downs, down, F.struct(m["r"]["s"].alias("s"), m["t"].alias("t"), m["r"]["x"].alias("x"))))
        return _let(both["x"], lambda x: F.when(x < 0, mode).otherwise(x))

    return _let(F.struct(total.cast("long").alias("n"), good.cast("long").alias("k"), draws.cast("long").alias("d"),
                         u.alias("u")), of)


def _split(node: Column, quotas: Column, seed: int) -> Column:
    """(left, right): the quotas dealt to the two children, each an array in the order of ``quotas``."""
    whole = F.aggregate(quotas, F.lit(0).cast("long"), lambda s, q: s + q)
    begin = F.struct(whole.alias("n"), F.floor(whole / 2).cast("long").alias("d"), F.array().cast("array<bigint>").alias("left"))
    left = F.aggregate(quotas, begin, lambda acc, q: _let(
        hypergeometric(acc["n"], q, acc["d"], _uniform(F.lit(seed), node, F.size(acc["left"]))),
        lambda x: F.struct((acc["n"] - q).alias("n"), (acc["d"] - x).alias("d"),
                           F.concat(acc["left"], F.array(x)).alias("left"))))["left"]
    return _let(left, lambda x: F.struct(x.alias("left"), F.zip_with(quotas, x, lambda q, y: q - y).alias("right")))


def splitting_tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(shard, place, quota) from one row with an array column ``quotas``: 2**levels shards, each with its
    exact number of blocks of each source (place: index into the array)."""
    nodes = quotas.select(F.lit(1).cast("long").alias("node"), "quotas")
    split = _split(F.col("node"), F.col("quotas"), seed).alias("h")
    for level in range(levels):
        halves = nodes.select("node", split)
        nodes = halves.select("node", F.posexplode(F.array("h.left", "h.right")).alias("side", "quotas")).select(
            (F.col("node") * 2 + F.col("side")).alias("node"), "quotas")
        nodes = stored(nodes.repartition(max(1, 1 << level >> 4), "node") if level >= 5 else nodes, f"mix-tree-{level}")
    return nodes.select((F.col("node") - (1 << levels)).alias("shard"), F.posexplode("quotas").alias("place", "quota"))


def targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight, target, place) from (source, source_size).

    Weights 1, 2, 3 repeat over the sources by code point, null last.  A target stops at ``max_repeats``
    times its source; the excess is shared again by weight until none is above: in ascending order of
    limit over weight, a source is limited if its share of what the limited ones before it leave is more.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("place", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.col("place") % 3 + 1).withColumn("most", F.col("source_size") * max_repeats)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.withColumn("share", left / weight)
    limited = F.col("share") * F.col("weight") >= F.col("most")
    first_open = F.min(F.when(~limited, F.struct(F.col("most") / F.col("weight"), F.col("place"), F.col("share")))).over(everything)
    return level.select("source", "source_size", "weight", "place",
                        F.when(limited, F.col("most").cast("double"))
                        .otherwise(first_open["share"] * F.col("weight")).alias("target"))


def _running(df: DataFrame, key: list[str], order: str, value: Column, out: str) -> DataFrame:
    """``out``: sum of ``value`` over the rows of the key that come before, in ascending ``order`` (a
    uniform 53-bit hash).  Rows are summed per cell of the order first, so a key spreads over its cells."""
    cell = F.floor(F.col(order) / F.lit((1 << 53) // CELLS)).cast("int")
    df = df.withColumns({"cell_": cell, "value_": value})
    inside = Window.partitionBy(*key, "cell_").orderBy(order, *[c for c in df.columns if c in ("epoch", "block")])
    across = Window.partitionBy(*key).orderBy("cell_").rowsBetween(Window.unboundedPreceding, -1)
    cells = df.groupBy(*key, "cell_").agg(F.sum("value_").alias("sum_"))
    cells = cells.select(*[F.col(k).alias(f"{k}_") for k in key], F.col("cell_").alias("c_"),
                         F.coalesce(F.sum("sum_").over(across), F.lit(0)).alias("base_"))
    same = F.col("cell_") == F.col("c_")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    return (df.withColumn("in_", F.sum("value_").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("value_"))
            .join(cells, same).withColumn(out, F.col("in_") + F.col("base_"))
            .drop("cell_", "value_", "in_", "c_", "base_", *[f"{k}_" for k in key]))


class Mix:
    """A mix of the rows of ``df``: ``sources`` (sizes and targets), ``shards`` (the tree's leaves) and the
    drawn blocks are tables in the shared folder; ``rows`` joins them with any columns of ``df``."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
                 seed: int = 1, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS):
        self.df, self.seed, self.max_repeats = df, seed, max_repeats
        self.id_col, self.text_col, self.source_col = id_col, text_col, source_col
        size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
        self.sizes = stored(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"),
                                      self._order().alias("order")), "mix-sizes")
        per_source = self.sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        self.sources = stored(targets(per_source, max_repeats).withColumn(
            "n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")), "mix-sources")
        self._draw(shard_words)

    def _order(self) -> Column:
        """A row's place in its source's permutation: depends on its id and text only."""
        return _bits(F.lit(self.seed), F.col(self.id_col), F.xxhash64(F.col(self.text_col)))

    def _block(self) -> Column:
        # The block number is a second hash's share of the source's blocks.
        return F.floor(_uniform(F.lit(self.seed + 1), F.col("order")) * F.col("n_blocks")).cast("long")

    def _in_source(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """Rows (with ``source``) joined with columns of their source."""
        side = small(self.sources.select(F.col("source").alias("source_"), *columns))
        return rows.join(side, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")

    def _draw(self, shard_words: int) -> None:
        seed = self.seed
        sized = self._in_source(self.sizes, ["place", "n_blocks"]).withColumn("block", self._block())
        blocks = sized.groupBy("place", "block").agg(F.sum("size").alias("words"))
        blocks = blocks.withColumn("mix_order", _bits(F.lit(seed + 2), "place", "block"))
        blocks = _running(blocks, ["place"], "mix_order", F.col("words"), "before")
        side = small(self.sources.select("place", "source_size", "target"))
        passes = F.floor(F.col("target") / F.col("source_size")).cast("long")
        blocks = blocks.join(side, "place").filter("source_size > 0 and words > 0").withColumn("passes", passes)
        blocks = blocks.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        last = (F.when(F.col("before") + F.col("words") <= F.col("rest"), "whole")
                .when(F.col("before") < F.col("rest"), "part").otherwise("none"))
        blocks = stored(blocks.select("place", "block", "words", "passes", (F.col("rest") - F.col("before")).alias("wanted"),
                                      last.alias("last")), "mix-blocks")
        # At most one block of a source is cut: of its rows in hash order, each that still fits is taken, and
        # then the smallest of the others if that comes nearer.
        cut = small(stored(blocks.filter("last = 'part'").select("place", "block", "wanted"), "mix-cut-blocks"))
        inside = sized.join(cut, ["place", "block"]).filter("size > 0").groupBy("place", "block").agg(
            F.array_sort(F.collect_list(F.struct("order", "size"))).alias("rows"), F.first("wanted").alias("wanted"))
        begin = F.struct(F.col("wanted").cast("double").alias("left"), F.array().cast("array<bigint>").alias("picked"))
        picked = F.aggregate("rows", begin, lambda acc, r: F.when(r["size"] <= acc["left"], F.struct(
            (acc["left"] - r["size"]).alias("left"), F.concat(acc["picked"], F.array(r["order"])).alias("picked"))).otherwise(acc))
        fitted = inside.select("place", "block", "rows", picked.alias("fit"))
        other = F.filter("rows", lambda r: (r["size"] < 2 * F.col("fit.left")) & ~F.array_contains(F.col("fit.picked"), r["order"]))
        nearer = F.array_min(F.transform(other, lambda r: F.struct(r["size"], r["order"])))["order"]
        cuts = fitted.select("place", "block", F.when(nearer.isNull(), F.col("fit.picked")).otherwise(
            F.concat(F.col("fit.picked"), F.array(nearer))).alias("cut")).filter(F.size("cut") > 0)
        drawn = blocks.join(cuts, ["place", "block"], "left")
        n = F.col("passes") + F.when((F.col("last") == "whole") | F.col("cut").isNotNull(), 1).otherwise(0)
        epochs = F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>")))
        drawn = drawn.select("place", "block", "words", "passes", "cut", epochs.alias("epoch")).withColumn(
            "cut", F.when(F.col("epoch") == F.col("passes"), F.col("cut")))
        drawn = drawn.withColumn("mix_order", _bits(F.lit(seed + 3), "place", "epoch", "block"))
        drawn = stored(_running(drawn, ["place"], "mix_order", F.lit(1).cast("long"), "number")
                       .select("place", "block", "epoch", "cut", "words", "number"), "mix-drawn")
        # The tree.
        words = drawn.agg(F.sum("words")).first()[0] or 0
        self.levels = max(0, (int(words) // shard_words)).bit_length()
        quota = drawn.groupBy("place").agg(F.count(F.lit(1)).alias("quota"))
        quotas = self.sources.select("place").join(quota, "place", "left").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("place", F.coalesce("quota", F.lit(0)).alias("quota")))),
            lambda q: q["quota"]).alias("quotas"))
        shards = splitting_tree(stored(quotas, "mix-quotas"), self.levels, seed + 4)
        before = Window.partitionBy("place").orderBy("shard")
        self.shards = stored(shards.withColumn("high", F.sum("quota").over(before)).withColumn(
            "low", F.col("high") - F.col("quota")).filter("quota > 0"), "mix-shards")
        # A block's shard: the range of numbers it falls in, found by equal width cells of the numbers.
        width = F.greatest(F.lit(1), F.floor(F.col("total") / (1 << self.levels))).cast("long")
        totals = self.shards.groupBy("place").agg(F.sum("quota").alias("total")).select("place", width.alias("width"))
        ranges = self.shards.join(totals, "place").select(
            "place", "shard", "low", "high", F.explode(F.sequence(
                F.floor(F.col("low") / F.col("width")), F.floor((F.col("high") - 1) / F.col("width")))).alias("at"))
        numbered = drawn.join(totals, "place").withColumn("at", F.floor(F.col("number") / F.col("width")))
        self.drawn = stored(numbered.join(ranges, ["place", "at"]).filter("number >= low and number < high").select(
            "place", "block", "epoch", "cut", "shard"), "mix-drawn-shards")

    def _taken(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with source and order) once for each time the mix takes them."""
        placed = self._in_source(rows, ["place", "n_blocks"]).withColumn("block", self._block())
        return placed.join(self.drawn, ["place", "block"]).filter(F.col("cut").isNull() | F.array_contains("cut", F.col("order")))

    def _mixed(self, columns: list[str]) -> DataFrame:
        """The mix with its columns as c0, c1, ... (so that no name can clash), epoch, shard and place."""
        rows = self.df.select(F.col(self.source_col).alias("source"), self._order().alias("order"),
                              *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
        return self._taken(rows).select(*[f"c{i}" for i in range(len(columns))], "epoch", "shard",
                                        _bits(F.lit(self.seed + 5), "order", "epoch").alias("place"))

    def rows(self, columns: list[str] | None = None) -> DataFrame:
        """The mix: a row for each time a row of ``df`` is taken, with ``mix_epoch``, ``mix_shard`` and
        ``mix_order`` (its place in the shard); underscores are put before these where ``df`` has the name."""
        columns = self.df.columns if columns is None else columns
        return self._mixed(columns).toDF(*columns, *[free_name(self.df, n) for n in ("mix_epoch", "mix_shard", "mix_order")])

    def shuffled(self, columns: list[str] | None = None) -> DataFrame:
        """The mix with the original columns only, each shard whole in one task and shuffled in it."""
        columns = self.df.columns if columns is None else columns
        dealt = self._mixed(columns).repartition("shard").sortWithinPartitions("shard", "place")
        return dealt.drop("epoch", "shard", "place").toDF(*columns)

    def taken(self) -> DataFrame:
        """(id, size, source_size, target, taken) of every row of ``df``; taken counts the mix's rows."""
        count = self._taken(self.sizes).groupBy("place", "order").agg(F.count(F.lit(1)).alias("times"))
        own = self._in_source(self.sizes, ["place", "source_size", "target"])
        same = own.groupBy("place", "order").agg(F.count(F.lit(1)).alias("rows_"))
        return own.join(count.join(same, ["place", "order"]), ["place", "order"], "left").select(
            F.col("id").alias(self.id_col), "size", "source_size", "target",
            F.coalesce(F.col("times") / F.col("rows_") * F.col("size"), F.lit(0)).cast("long").alias("taken"))
