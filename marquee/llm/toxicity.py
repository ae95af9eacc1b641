"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as classes (insult, suspect, threat, target, negation, report, other).
Sequential transducers pass them on: reported speech and negation rewrite the
classes that stand in their scope, then insults and threats give weights, more
where a target is near. The four are composed into one machine, which is run
over each clause that holds an insult or threat; a clause's score is the sum of
the weights on its path. What the clauses of a text add up to is turned into a
chance by a logistic regression learned from labelled rows, and the words that
labels mark as insults are learned from the same rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import releasing, spare, stored

#: Labelled rows, at most about, from which words and weights are learned: the
#: rows whose ids hash below a bound.
MAX_LABELLED = 10_000
#: A word is learned as an insult if so many toxic texts hold it and this share of
#: all texts with it is toxic. A stem (the beginning of longer words) is learned as
#: suspect if the same is true of texts that hold it twice. Copies of one text
#: repeat their words behind the same words, so these must be of so many kinds.
INSULT_TEXTS, INSULT_SHARE = 15, 0.95
STEM_TEXTS, STEM_SHARE, STEM_LENGTHS = 6, 0.7, (5, 8)
MIN_CONTEXTS = 6
#: Learned words and stems, at most: those with the most toxic texts.
MAX_LEARNED = 5000

#: Words that start the grammar's classes.
INSULTS = (
    "idiot idiots idiotic moron morons moronic stupid dumb scum trash loser losers pathetic worthless disgusting clown "
    "imbecile fool foolish jerk bastard coward vermin garbage filthy ugly dirtbag "
    "dummkopf trottel arschloch abschaum versager idiota imbécil estúpido basura escoria crétin débile ordure connard"
).split()
THREATS = (
    "kill hurt destroy murder strangle stab shoot beat crush smash burn attack "
    "töten umbringen vernichten matar destruir tuer détruire"
).split()
TARGETS = (
    "you your yours yourself he she they him her them his their this these those everyone people "
    "du dich dir ihr euch sie tú te usted ustedes vosotros tu toi vous"
).split()
NEGATIONS = "not never no nobody nothing neither nor without isn't aren't wasn't don't doesn't won't nicht kein keine nie sin nunca ne pas jamais".split()
REPORTS = (
    "said says say told tells claimed claims wrote writes called calls quoted quotes reported according alleged "
    "sagte behauptete schrieb dijo dice afirmó escribió dit disait écrit selon"
).split()

OTHER, INSULT, SUSPECT, THREAT, TARGET, NEGATION, REPORT, DENIED, CITED = range(9)
CLASSES = 9
CLAUSE_END = re.compile(r"[.!?;:,\n\r()\[\]{}\"“”«»|]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


@dataclass(frozen=True)
class Transducer:
    """Sequential: in each state, a class read gives a class written, a weight and the next state."""

    start: object
    step: Callable[[object, int], tuple[int, float, object]]


def reported_speech() -> Transducer:
    """After a report, to the clause's end, insults and threats are cited ones."""
    def step(state, read):
        if state and read in (INSULT, SUSPECT, THREAT):
            return CITED, 0.0, state
        return read, 0.0, state or read == REPORT

    return Transducer(False, step)


def negation(scope: int = 4) -> Transducer:
    """Up to ``scope`` words after a negation, insults and threats are denied ones."""
    def step(left, read):
        if read == NEGATION:
            return read, 0.0, scope
        after = max(0, left - 1)
        if left and read in (INSULT, SUSPECT, THREAT, CITED):
            return DENIED, 0.0, after
        return read, 0.0, after

    return Transducer(0, step)


def target(scope: int = 4, bonus: float = 0.6) -> Transducer:
    """A target up to ``scope`` words before or after an insult adds to it, once."""
    def step(state, read):
        insult, aim = (max(0, k - 1) for k in state)
        if read == INSULT:
            return read, bonus if state[1] else 0.0, (0 if state[1] else scope, aim)
        if read == TARGET:
            return read, bonus if state[0] else 0.0, (0, scope)
        return read, 0.0, (insult, aim)

    return Transducer((0, 0), step)


def insult(direct: float = 1.0, suspect: float = 0.25, cited: float = 0.35, denied: float = 0.1) -> Transducer:
    """What an insult weighs as it stands, as a suspect stem, cited or denied."""
    weights = {INSULT: direct, SUSPECT: suspect, CITED: cited, DENIED: denied}
    return Transducer(0, lambda state, read: (read, weights.get(read, 0.0), 0))


def threat(scope: int = 3, weight: float = 1.2) -> Transducer:
    """A threat weighs if a target follows within ``scope`` words."""
    def step(left, read):
        if read == THREAT:
            return read, 0.0, scope
        if read == TARGET and left:
            return read, weight, 0
        return read, 0.0, max(0, left - 1)

    return Transducer(0, step)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What ``first`` writes is read by ``second``; weights add up."""
    def step(state, read):
        written, weight, a = first.step(state[0], read)
        written, more, b = second.step(state[1], written)
        return written, weight + more, (a, b)

    return Transducer((first.start, second.start), step)


def tabulate(machine: Transducer) -> tuple[list[list[int]], list[list[float]]]:
    """The reachable states as tables: next state and weight by state and class."""
    numbers, queue = {machine.start: 0}, [machine.start]
    moves: list[list[int]] = []
    weights: list[list[float]] = []
    for state in queue:
        moves.append([])
        weights.append([])
        for read in range(CLASSES):
            _, weight, after = machine.step(state, read)
            if after not in numbers:
                numbers[after] = len(numbers)
                queue.append(after)
            moves[-1].append(numbers[after])
            weights[-1].append(weight)
    return moves, weights


class Grammar:
    """The composed machine and its lexicon, made once in each Python worker."""

    def __init__(self, learned: tuple[str, ...], stems: tuple[str, ...]):
        lists = ((INSULT, learned), (INSULT, INSULTS), (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS))
        self.classes = {w: k for k, ws in lists for w in ws}
        self.stems = frozenset(stems)
        self.lengths = sorted({len(stem) for stem in stems})
        self.moves, self.weights = tabulate(reduce(compose, [reported_speech(), negation(), target(), insult(), threat()]))
        # Clauses without one of these have no weight, whatever else they hold.
        self.anchors = ahocorasick.Automaton()
        for w in [*stems, *(w for w, k in self.classes.items() if k in (INSULT, THREAT))]:
            self.anchors.add_word(w, w)
        self.anchors.make_automaton()

    def read(self, word: str) -> int:
        """The class of a word: its own, else suspect if it goes on from a stem."""
        found = self.classes.get(word)
        if found is not None:
            return found
        return SUSPECT if any(len(word) > n and word[:n] in self.stems for n in self.lengths) else OTHER

    def clause_score(self, clause: str) -> float:
        state, score = 0, 0.0
        for w in WORD.findall(clause):
            read = self.read(w)
            score += self.weights[state][read]
            state = self.moves[state][read]
        return score

    def clauses(self, text: str) -> list[tuple[str, float]]:
        """The clauses with a score above 0, in order, in lower case."""
        lowered = text.lower()
        if next(self.anchors.iter(lowered), None) is None:
            return []
        scored = ((c.strip(), self.clause_score(c)) for c in CLAUSE_END.split(lowered) if next(self.anchors.iter(c), None))
        return [(c, s) for c, s in scored if s > 0]


@dataclass(frozen=True)
class Model:
    """Learned insults and stems, and the logistic regression on a text's ``signals``."""

    learned: tuple[str, ...]
    stems: tuple[str, ...]
    weights: tuple[float, ...]


def signals(scores: list[float]) -> list[float]:
    """What a text's clause scores say: their sum, and the steps it has reached."""
    total = sum(scores)
    return [1.0, math.log1p(total), *(float(total >= step) for step in (0.2, 0.45, 0.7, 0.95))]


def chance(weights: tuple[float, ...], values: list[float]) -> float:
    z = sum(w * v for w, v in zip(weights, values))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


#: Before anything is learned: rare without a clause, likely with one.
PRIOR = (-3.0, 1.0, 0.2, 0.8, 1.0, 1.5)


def fit_weights(rows: list[tuple[list[float], int]], ridge: float = 1.0, rounds: int = 25) -> tuple[float, ...]:
    """Newton steps, drawn towards ``PRIOR``; without rows it is the prior."""
    center = np.array(PRIOR)
    if not rows:
        return PRIOR
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    w = center.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * (w - center)
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
    return tuple(float(v) for v in w)


def _learned_words(rows: DataFrame) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Insults and suspect stems, of rows (h, t, y); counted on the executors."""
    found = rows.select("h", "y", F.regexp_extract_all(F.lower("t"), F.lit(r"\p{L}+"), F.lit(0)).alias("ws"))
    behind = F.concat(F.array(F.lit("")), F.slice("ws", 1, F.greatest(F.size("ws") - 1, F.lit(0))))
    pairs = found.where(F.size("ws") > 0).select("h", "y", F.inline(F.arrays_zip(F.col("ws").alias("w"), behind.alias("b"))))
    low, high = STEM_LENGTHS
    cut = F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.length("w") - 1)), lambda n: F.col("w").substr(F.lit(1), n))
    starts = pairs.where(F.length("w") > low).select("h", "y", "b", F.explode(cut).alias("w"), F.lit(True).alias("stem"))
    both = starts.unionByName(pairs.where(F.length("w") > 2).withColumn("stem", F.lit(False)))
    texts = both.groupBy("w", "stem", "h", "y").agg(F.count("*").alias("times"), F.first("b").alias("b"))
    words = texts.where(~F.col("stem") | (F.col("times") > 1)).groupBy("w", "stem").agg(
        F.count("*").alias("n"), F.sum("y").alias("toxic"), F.count_distinct(F.when(F.col("y") == 1, F.col("b"))).alias("contexts")
    )
    toxic, n = F.col("toxic"), F.col("n")
    enough = F.when(F.col("stem"), (toxic >= STEM_TEXTS) & (toxic >= STEM_SHARE * n)).otherwise((toxic >= INSULT_TEXTS) & (toxic >= INSULT_SHARE * n))
    best = words.where(enough & (F.col("contexts") >= MIN_CONTEXTS)).orderBy(F.desc("toxic"), "w").limit(MAX_LEARNED).collect()
    known = {*INSULTS, *THREATS, *TARGETS, *NEGATIONS, *REPORTS}
    stems = {r["w"] for r in best if r["stem"]}
    # A stem says all that longer ones with the same beginning say.
    shortest = {w for w in stems if not any(w[:k] in stems for k in range(low, len(w)))}
    insults = {r["w"] for r in best if not r["stem"] and r["w"] not in known}
    return tuple(sorted(w for w in insults if not any(w.startswith(k) for k in shortest))), tuple(sorted(shortest))


def _scored(rows: DataFrame, text: str, model: Model) -> DataFrame:
    """``rows`` with toxic_clauses, signals and score.

    Only texts go to Python and only the findings come back; the other columns
    do not leave the JVM, so that whole rows are never held in Arrow batches.
    """
    clause_type = pa.list_(pa.struct([("clause", pa.string()), ("weight", pa.float64())]))
    names = ["toxic_clauses", "signals", "score"]

    def found(stream: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grammar = Grammar(model.learned, model.stems)
        for texts in stream:
            clauses, values, scores = [], [], []
            for value in texts:
                of = grammar.clauses(value.as_py() or "")
                clauses.append([{"clause": c, "weight": s} for c, s in of])
                values.append(signals([s for _, s in of]))
                scores.append(chance(model.weights, values[-1]))
            own = [pa.array(clauses, clause_type), pa.array(values, pa.list_(pa.float64())), pa.array(scores, pa.float64())]
            yield pa.StructArray.from_arrays(own, names)

    kind = "struct<toxic_clauses: array<struct<clause: string, weight: double>>, signals: array<double>, score: double>"
    # Else a filter on a finding would run the grammar a second time.
    once = F.arrow_udf(releasing(found), kind).asNondeterministic()
    at = spare([*rows.columns, *names], "found")
    return rows.withColumn(at, once(F.col(text))).select(*rows.columns, *[F.col(at)[c].alias(c) for c in names])


def learn(labelled: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", most: int = MAX_LABELLED) -> Model:
    """A model from labelled rows; NULL labels are left out, NULL texts are empty.

    About ``most`` rows at most are used, drawn by a hash of their keys. Without
    labelled rows the model is the prior and knows no words but the grammar's.
    """
    known = labelled.where(F.col(label).isNotNull())
    part = min(1.0, most / max(1, known.count()))
    rows = known.select(
        F.coalesce(F.col(text), F.lit("")).alias("t"), (F.col(label) > 0).cast("int").alias("y"), F.xxhash64(key).alias("h")
    ).where(F.pmod("h", F.lit(1_000_003)) < part * 1_000_003)
    rows = stored(rows, "toxic-labels")
    found = _learned_words(rows)
    seen = _scored(rows, "t", Model(*found, PRIOR)).select("signals", "y").collect()
    return Model(*found, fit_weights([(list(r["signals"]), r["y"]) for r in seen]))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``toxic_clauses`` (clause, weight) and ``score`` (0 to 1).

    Scores whole texts, by the text alone. NULL and empty texts have no clauses
    and the score of a text without any. Own columns of these names are
    replaced, all others stay; rows stay apart and where they are.
    """
    rows = docs.select(*[c for c in docs.columns if c.lower() not in ("toxic_clauses", "signals", "score")])
    return _scored(rows, text, model).drop("signals")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels nothing is learned from: a quarter, by crc32 of the id."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Text and label of the documents whose labels may be learned from."""
    marks = labels.where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    return docs.select("doc_id", "text").join(marks, "doc_id")
