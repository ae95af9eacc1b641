"""Quality rules as a short-circuit cascade.

Each rule rejects a document by a condition on its text. On a sample the cost
and the rejections of the rules are estimated; the rules then run in the order
of rejections per cost, each only on documents that the ones before have let
pass. The order changes the time, never the verdict: a document is kept if no
rule rejects it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import spare, words

#: Rows, about, on which costs and rejections are estimated.
SAMPLE_ROWS = 2000
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``rejects`` and ``work`` take the text; ``work`` is what a look costs."""

    name: str
    rejects: object
    work: object


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _gaps(text: Column) -> Column:
    return _count(text, " \t\n\x0b\x0c\r")


def _letters(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))


def _capitals(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))


def _bytes(times: float):
    return lambda text: times * F.octet_length(text)


#: More than a twentieth of the characters are symbols; more than three of ten
#: letters are capitals; one "!" in twelve characters;
#: half of the text is digits; words of more than 40 characters on average
#: (no spaces), counted by gaps; no letter at all.
RULES = [
    Rule("symbols", lambda t: 20 * _count(t, SYMBOLS) > F.length(t), _bytes(2.0)),
    Rule("shouting", lambda t: 10 * _capitals(t) > 3 * _letters(t), _bytes(9.0)),
    Rule("exclaiming", lambda t: 12 * _count(t, "!") > F.length(t), _bytes(1.5)),
    Rule("digits", lambda t: 2 * _count(t, "0123456789") > F.length(t), _bytes(2.0)),
    Rule("unbroken", lambda t: F.length(t) > 40 * (1 + _gaps(t)), _bytes(2.0)),
    Rule("wordless", lambda t: ~t.rlike(r"\p{L}"), lambda t: F.lit(8.0)),
]


def best_order(rules: list[Rule], patterns: list, costs: list[float]) -> list[int]:
    """Greedy order by rejections, among those still in, per cost.

    ``patterns``: (which rules reject, as bits; rows). Ties go to the rule that
    was named first.
    """
    order: list[int] = []
    left = [(int(bits), int(n)) for bits, n in patterns]
    while len(order) < len(rules):
        rest = [k for k in range(len(rules)) if k not in order]
        gain = {k: sum(n for bits, n in left if bits >> k & 1) / max(costs[k], 1e-9) for k in rest}
        best = max(rest, key=lambda k: (gain[k], -k))
        order.append(best)
        left = [(bits, n) for bits, n in left if not bits >> best & 1]
    return order


def plan_cascade(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order in which they should run.

    The sample is drawn by a hash of the text from all rows; on the driver are
    only its counts, at most one line per set of rules that reject together.
    An empty sample leaves the order as it is.
    """
    if not rules:
        return []
    total = docs.count()
    part = min(1.0, sample_rows / max(total, 1))
    of = F.coalesce(F.col(text), F.lit(""))
    picked = docs.select(of.alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(1_000_003)) < part * 1_000_003)
    bits = F.lit(0)
    for k, rule in enumerate(rules):
        bits = bits + F.when(rule.rejects(F.col("t")), F.lit(1 << k)).otherwise(F.lit(0))
    work = [F.sum(rule.work(F.col("t")).cast("double")).alias(f"w{k}") for k, rule in enumerate(rules)]
    seen = picked.groupBy(bits.alias("bits")).agg(F.count("*").alias("n"), *work).collect()
    if not seen:
        return list(rules)
    n = sum(r["n"] for r in seen)
    costs = [sum(r[f"w{k}"] for r in seen) / n for k in range(len(rules))]
    return [rules[k] for k in best_order(rules, [(r["bits"], r["n"]) for r in seen], costs)]


def first_rejection(text: Column, ordered: list[Rule]) -> Column:
    """Name of the first rule that rejects, NULL if none does.

    A CASE stops at its first true branch, so that a later rule's work is done
    for the documents that passed all before it.
    """
    verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        verdict = F.when(rule.rejects(text), F.lit(rule.name)).otherwise(verdict)
    return verdict


def cascade(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``rejected_by`` (NULL: kept).

    NULL counts as the empty text, which the rule ``wordless`` rejects. Rows
    are kept apart: repeated ones get the same verdict each. Which of several
    rejecting rules is named follows from the order. Own columns are kept; one
    named ``rejected_by`` is replaced.
    """
    of = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("rejected_by", first_rejection(of, plan_cascade(docs, rules, text, sample_rows)))


def _window_hashes(w: Column) -> Column:
    """64-bit hashes of the 3-word windows of a list of words."""
    places = F.when(F.size(w) > 2, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda k: F.xxhash64(F.get(w, k), F.get(w, k + 1), F.get(w, k + 2)))


def _repeat_words(window_hashes: Column) -> Column:
    """Words that lie in 3-word windows found twice or more.

    Windows are compared by 64-bit hashes. Sorted with their places, equal ones
    are neighbours; the places of repeated ones, sorted again, cover up to three
    words each, fewer where the next begins earlier.
    """
    n = F.size(window_hashes)

    def count(h: Column) -> Column:
        placed = F.sort_array(F.arrays_zip(h.alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("p")))

        def among(s: Column) -> Column:
            size = F.size(s)
            before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,p:int>")), F.slice(s, 1, size - 1))
            trio = F.arrays_zip(s.alias("s"), before.alias("b"), F.slice(s, 2, size).alias("a"))
            same = F.filter(trio, lambda x: F.coalesce(x["s"]["h"] == x["b"]["h"], F.lit(False)) | F.coalesce(x["s"]["h"] == x["a"]["h"], F.lit(False)))
            places = F.sort_array(F.transform(same, lambda x: x["s"]["p"]))
            return let(places, lambda p: F.aggregate(
                F.arrays_zip(p.alias("p"), F.slice(p, 2, F.size(p)).alias("q")),
                F.lit(0).cast("bigint"),
                lambda acc, x: acc + F.coalesce(F.least(x["q"] - x["p"], F.lit(3)), F.lit(3)),
            ))

        return let(placed, among)

    return F.when((n > 1) & (F.size(F.array_distinct(window_hashes)) < n), count(window_hashes)).otherwise(F.lit(0).cast("bigint"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, not once per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Over the whole text of each row; of NULL and empty texts all are 0. Columns
    of these names are replaced, all others kept.
    """
    of, ws, hs = (spare(docs.columns, f"_{k}") for k in ("of", "words", "windows"))
    with_words = docs.withColumn(of, F.coalesce(F.col(text), F.lit(""))).withColumn(ws, words(F.col(of)))
    w = F.col(ws)
    size = F.size(w)
    hashes = _window_hashes(w)
    lines = F.filter(F.split(F.col(of), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = with_words.withColumns({
        "n_words": size.cast("bigint"),
        "word_chars": F.length(F.translate(F.col(of), " \t\n\x0b\x0c\r", "")).cast("bigint"),
        "n_symbols": _count(F.col(of), SYMBOLS).cast("bigint"),
        "n_dup_lines": let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint"),
        hs: hashes,
    })
    return out.withColumn("n_repeat_words", _repeat_words(F.col(hs))).drop(of, ws, hs)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Under 50 words, or over half of them in repeated windows."""
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _repeats_fail(n_words: Column, window_hashes: Column) -> Column:
    """Whether ``base_failed`` by repeated words, which are placed only if they could be enough.

    Of k equal windows k - 1 are no first ones, and k is at most twice that; a
    window covers three words. So repeated words are at most six times the windows
    that are no first ones.
    """
    again = F.size(window_hashes) - F.size(F.array_distinct(window_hashes))
    return F.when(100 * 6 * again > 50 * n_words, base_failed(n_words, _repeat_words(window_hashes))).otherwise(F.lit(False))


def judged(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``rejected_by`` and ``kept``."""
    out = measures(cascade(docs, rules, text), text)
    out = out.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())


def passed(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows that ``judged`` keeps, without the measures.

    The base rules, which are the dearest, come last and see only what the others
    leave; a text is split once, and windows are hashed only with enough words.
    """
    of = F.coalesce(F.col(text), F.lit(""))
    base = let(words(of), lambda w: F.when(F.size(w) < 50, F.lit(True)).otherwise(
        let(_window_hashes(w), lambda h: _repeats_fail(F.size(w), h))
    ))
    return docs.where(F.when(first_rejection(of, plan_cascade(docs, rules, text)).isNull(), ~base).otherwise(F.lit(False)))
