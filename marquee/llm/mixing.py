"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed per cell of source, language and topic. The cells'
weights are raked: scaled to each margin's targets in turn, until they fit all
of them. A document is then sampled with its cell's weight per token that the
cell has, so that the sample's expected tokens meet the targets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import spare, stored, words

#: Up to so many cells are sent to all executors; more are joined by shuffling.
BROADCAST_CELLS = 50_000

#: Topics by the first pattern that a text contains; none of them: prose.
TOPICS = [
    ("legal", r"[Ll]icen[sc]ed|[Cc]opyright|rights reserved|[Ww]arranty"),
    ("contact", r"@[a-z]|[0-9]{3}-[0-9]{4}"),
    ("web", r"https?://|www\."),
    ("tabular", r" \| "),
]
PROSE = "prose"


@dataclass(frozen=True)
class Margin:
    """Target shares of one column's values.

    ``shares`` names some values (None: NULL); the others divide the rest by
    their tokens to the power ``temper``. Shares of values that have no tokens
    go to the others in proportion.
    """

    column: str
    shares: dict[str | None, float]
    temper: float = 1.0


def topic(text: Column, topics: list[tuple[str, str]] = TOPICS) -> Column:
    """The first topic whose pattern the text contains."""
    found = F.lit(PROSE)
    for name, pattern in reversed(topics):
        found = F.when(F.coalesce(text, F.lit("")).rlike(pattern), F.lit(name)).otherwise(found)
    return found


def _key(column: str) -> Column:
    """A value as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _goals(cells: DataFrame, margin: Margin, key: str, budget: float) -> DataFrame:
    """(key, goal) in tokens for each value of a margin that has tokens."""
    named = {("" if v is None else f"={v}"): float(s) for v, s in margin.shares.items()}
    share = F.lit(None).cast("double")
    for value, s in named.items():
        share = F.when(F.col(key) == value, F.lit(s)).otherwise(share)
    totals = cells.groupBy(key).agg(F.sum("tokens").alias("tokens")).where(F.col("tokens") > 0)
    totals = totals.withColumn("share", share).withColumn("part", F.pow(F.col("tokens").cast("double"), F.lit(margin.temper)))
    sums = totals.agg(F.sum("share").alias("named"), F.sum(F.when(F.col("share").isNull(), F.col("part"))).alias("open")).first()
    fixed, open_ = sums["named"] or 0.0, sums["open"] or 0.0
    rest = max(0.0, 1.0 - sum(named.values())) if open_ else 0.0
    whole = (fixed + rest) or 1.0
    goal = F.coalesce(F.col("share"), F.col("part") * F.lit(rest / open_ if open_ else 0.0)) * F.lit(budget / whole)
    return totals.select(key, goal.alias("goal"))


def rake(cells: DataFrame, margins: list[Margin], keys: list[str], rate: float, cycles: int) -> DataFrame:
    """``cells`` (keys, tokens) with ``weight``: the tokens to expect of each in the sample.

    Starts from ``rate`` of each cell's tokens. A cycle scales the weights to
    each margin in turn and then lowers those above the cell's tokens to these,
    since no document is repeated; targets that need more are met as far as
    there are tokens. Each cycle's cells are written, so that none is done twice.
    """
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    goals = [stored(_goals(cells, m, k, rate * total), f"mix-{m.column}") for m, k in zip(margins, keys)]
    state = cells.withColumn("weight", F.col("tokens") * F.lit(rate))
    for _ in range(cycles):
        for key, goal in zip(keys, goals):
            sums = state.groupBy(key).agg(F.sum("weight").alias("sum")).join(goal, key)
            factor = F.when(F.col("sum") > 0, F.col("goal") / F.col("sum")).otherwise(F.lit(0.0))
            state = state.join(sums.select(key, factor.alias("factor")), key, "left")
            state = state.select(*keys, "tokens", (F.col("weight") * F.coalesce("factor", F.lit(0.0))).alias("weight"))
        state = stored(state.withColumn("weight", F.least("weight", F.col("tokens").cast("double"))), "mix-cells")
    return state


def draw(key: Column, seed: str) -> Column:
    """A number from 0 to 1 by the key alone: repeated rows fall together."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def mix(docs: DataFrame, margins: list[Margin], rate: float = 0.5, cycles: int = 6, seed: str = "mix", key: str = "doc_id", tokens: str = "n_tokens") -> DataFrame:
    """``docs`` with ``chance`` and ``sampled``.

    ``docs`` has the margins' columns and ``tokens``, a count per row (NULL: 0).
    Cells without tokens, such as those of empty texts alone, have the chance 0.
    NULL is a value of a margin like any other. Rows stay apart; columns named
    chance or sampled are replaced, others kept. No rows give no rows.
    """
    kept = [c for c in docs.columns if c.lower() not in ("chance", "sampled")]
    keys = [f"key_{k}" for k in range(len(margins))]
    cells = docs.select(*[_key(m.column).alias(k) for m, k in zip(margins, keys)], F.coalesce(F.col(tokens), F.lit(0)).cast("bigint").alias("tokens"))
    cells = stored(cells.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    raked = rake(cells, margins, keys, rate, cycles)
    chance = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0))
    own = [spare(kept, f"_mix_{k}") for k in range(len(margins))]
    chances = raked.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], chance.alias("chance"))
    if cells.count() <= BROADCAST_CELLS:
        chances = F.broadcast(chances)
    rows = docs.select(*kept, *[_key(m.column).alias(o) for m, o in zip(margins, own)]).join(chances, own)
    return rows.select(*kept, "chance", (draw(F.col(key), seed) < F.col("chance")).alias("sampled"))


def with_topic_and_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``topic`` and ``n_tokens``, the number of words."""
    return docs.withColumn("topic", topic(F.col(text))).withColumn("n_tokens", F.size(words(F.col(text))).cast("bigint"))
