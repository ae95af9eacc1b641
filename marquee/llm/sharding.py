"""A uniform shuffle into shards of exact size.

Rows are stored as they come, in parts. How many rows of each part go to each
shard is drawn first, as a matrix with the parts' sizes and the shards' sizes as
its margins, by hypergeometric draws in a binary tree over the parts. Then each
part permutes its own rows and deals them out by its line of the matrix, rows
move to their shards, and each shard permutes again what it got.

All of it is DataFrame work. No part, shard or task holds more than its share:
inside a shard, rows are ranked in buckets of the random key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.common import spare, stored

#: Rows, about, that are ranked together within a shard.
BUCKET_ROWS = 100_000
#: A draw looks this many standard deviations to each side of the mode; what
#: lies beyond has a chance below 1e-60.
WIDTH = 18


def uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) from a hash of the parts: 52 of its bits."""
    mixed = F.xxhash64(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return (F.shiftrightunsigned(mixed, 12).cast("double") + 0.5) / F.lit(float(2**52))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked ones among ``drawn`` of ``total``, of which ``marked`` are; by inversion at ``u``.

    Chances relative to the one at the mode follow from ratios of neighbours, so
    no factorial is needed; they are summed once for their total and once more
    up to ``u``. All four are doubles.
    """
    low = F.greatest(F.lit(0.0), drawn + marked - total)
    high = F.least(drawn, marked)
    mode = F.least(high, F.greatest(low, F.floor((drawn + 1) * (marked + 1) / (total + 2)).cast("double")))
    share = marked / F.greatest(total, F.lit(1.0))
    spread = F.sqrt(drawn * share * (1 - share) * (total - drawn) / F.greatest(total - 1, F.lit(1.0)))
    reach = F.ceil(WIDTH * spread + 40).cast("double")
    first, last = F.greatest(low, mode - reach), F.least(high, mode + reach)

    def upward(x: Column) -> Column:  # chance of x + 1 by that of x
        return (marked - x) * (drawn - x) / ((x + 1) * (total - marked - drawn + x + 1))

    def steps(n: Column) -> Column:
        return F.slice(F.sequence(F.lit(0), F.greatest(n, F.lit(0.0)).cast("int")), F.lit(2), F.greatest(n, F.lit(0.0)).cast("int"))

    def state(x: Column, chance: Column, total_: Column) -> Column:
        return F.struct(x.alias("x"), chance.alias("c"), total_.alias("t"))

    one = F.lit(1.0)
    # Down from the mode: where it ends, the chance there, and the sum of all from there to the mode.
    down = F.aggregate(
        steps(mode - first), state(mode, one, one),
        lambda s, _: state(s["x"] - 1, s["c"] / upward(s["x"] - 1), s["t"] + s["c"] / upward(s["x"] - 1)),
    )
    up = F.aggregate(steps(last - mode), state(mode, one, F.lit(0.0)), lambda s, _: state(s["x"] + 1, s["c"] * upward(s["x"]), s["t"] + s["c"] * upward(s["x"])))

    def walk(begin: Column, rise: Column) -> Column:
        # Up from the lower end until the summed chance passes u of the whole.
        goal = u * (begin["t"] + rise["t"])
        found = F.aggregate(
            steps(last - begin["x"]), state(begin["x"], begin["c"], begin["c"]),
            lambda s, _: F.when(s["t"] > goal, s).otherwise(state(s["x"] + 1, s["c"] * upward(s["x"]), s["t"] + s["c"] * upward(s["x"]))),
        )
        return found["x"]

    both = F.array(F.struct(down.alias("d"), up.alias("u")))
    return F.element_at(F.transform(both, lambda b: walk(b["d"], b["u"])), 1)


def _line(capacities: Column, drawn: Column, seed: str, key: Column) -> Column:
    """A multivariate draw: how much of each capacity goes to a set of ``drawn`` rows."""
    def step(s: Column, item: Column) -> Column:
        taken = hypergeometric(s["total"], item["cap"], s["drawn"], uniform(seed, key, item["at"]))
        return F.element_at(F.transform(F.array(taken), lambda t: F.struct(
            (s["total"] - item["cap"]).alias("total"),
            (s["drawn"] - t).alias("drawn"),
            F.concat(s["line"], F.array(t.cast("bigint"))).alias("line"),
        )), 1)

    numbered = F.transform(capacities, lambda c, k: F.struct(c.cast("double").alias("cap"), k.alias("at")))
    total = F.aggregate(capacities, F.lit(0).cast("bigint"), lambda a, c: a + c).cast("double")
    begin = F.struct(total.alias("total"), drawn.cast("double").alias("drawn"), F.expr("cast(array() as array<bigint>)").alias("line"))
    return F.aggregate(numbered, begin, step)["line"]


def communication_matrix(sizes: DataFrame, shard_sizes: list[int], seed: str = "") -> DataFrame:
    """``sizes`` (slot int gapless from 0, n bigint) with ``line array<bigint>``.

    A line says how many of a part's rows go to each shard. Lines sum to the
    parts' sizes, columns to the shards' sizes, and the matrix is distributed as
    under a uniform permutation of all rows. The tree over the parts is walked
    level by level: a node splits what its shards take between its halves.
    """
    parts = sizes.count()
    levels = max(0, math.ceil(math.log2(max(parts, 1))))
    totals = (
        sizes.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
        .withColumn("node", F.floor(F.col("slot") / F.pow(F.lit(2.0), F.lit(levels) - F.col("level"))).cast("int"))
        .groupBy("level", "node").agg(F.sum("n").alias("n"))
    )
    totals = stored(totals, "shard-tree")
    level = totals.where(F.col("level") == 0).select("node", F.array(*[F.lit(n).cast("bigint") for n in shard_sizes]).alias("line"))
    for depth in range(1, levels + 1):
        left = totals.where(F.col("level") == depth).where(F.col("node") % 2 == 0).select((F.col("node") / 2).cast("int").alias("node"), F.col("n").alias("left"))
        halves = level.join(left, "node").withColumn("mine", _line(F.col("line"), F.col("left"), f"{seed}-{depth}", F.col("node")))
        rest = F.zip_with("line", "mine", lambda a, b: a - b)
        level = halves.select(F.inline(F.array(
            F.struct((2 * F.col("node")).alias("node"), F.col("mine").alias("line")),
            F.struct((2 * F.col("node") + 1).alias("node"), rest.alias("line")),
        )))
        if depth % 4 == 0:
            level = stored(level, f"shard-level-{depth}")
    return sizes.join(level.withColumnRenamed("node", "slot"), "slot")


def shard(rows: DataFrame, n_shards: int, seed: str = "0", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with ``shard`` (from 0) and ``slot`` (its place there, gapless from 0).

    Shard sizes differ by one at most; the first ones are the larger. Every way
    of dealing out the rows is equally likely, up to the hash that stands for
    chance. Repeated rows and NULLs are rows like any other, since chance is
    drawn by a row's place, not by its values. No rows: no result rows. Columns
    named shard or slot are replaced, others kept.
    """
    if n_shards < 1:
        raise ValueError("at least one shard")
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    part, place, rank, key, bucket, line = (spare(kept, f"_{k}") for k in ("part", "place", "rank", "key", "bucket", "line"))
    placed = rows.select(*kept).withColumn(place, F.monotonically_increasing_id())
    placed = stored(placed.withColumn(part, F.shiftright(F.col(place), 33)), "shard-rows")
    counted = placed.groupBy(part).agg(F.count("*").alias("n"))
    # One line per part, not per row: numbering them is small work.
    sizes = stored(counted.withColumn("slot", F.row_number().over(W.orderBy(part)) - 1), "shard-parts")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shard_sizes = [total // n_shards + (k < total % n_shards) for k in range(n_shards)]
    matrix = communication_matrix(sizes, shard_sizes, seed)
    # Upper ends of a part's pieces, so that a row finds its shard by its local rank.
    ends = F.transform(F.sequence(F.lit(1), F.lit(n_shards)), lambda k: F.aggregate(F.slice("line", F.lit(1), k), F.lit(0).cast("bigint"), lambda a, c: a + c))
    lines = matrix.select(part, ends.alias(line))
    local = placed.withColumn(rank, F.row_number().over(W.partitionBy(part).orderBy(F.xxhash64(F.lit(f"{seed}-local"), F.col(place)), place)) - 1)
    dealt = local.join(lines, part).withColumn("shard", F.size(F.filter(line, lambda end: end <= F.col(rank))))
    dealt = dealt.drop(line, rank).withColumn(key, uniform(f"{seed}-shard", F.col(place)))
    buckets = max(1, math.ceil(total / n_shards / bucket_rows))
    dealt = dealt.withColumn(bucket, F.floor(F.col(key) * buckets).cast("int"))
    filled = dealt.groupBy("shard", bucket).agg(F.count("*").alias("n"))
    before = filled.select("shard", bucket, F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = dealt.withColumn("slot", F.row_number().over(W.partitionBy("shard", bucket).orderBy(key, place)) - 1)
    offset = spare([*ranked.columns], "_before")
    out = ranked.join(before.withColumnRenamed("before", offset), ["shard", bucket])
    return out.select(*kept, "shard", (F.col("slot") + F.col(offset)).cast("bigint").alias("slot"))
