"""Licence scan by sentence rules.

A text is brought to a normal form, with signs where sentences and lines end, and
cut there into pieces. Each run of neighbouring pieces that may be a known sentence
is looked up in one map from sentences to identifiers: a sentence may run over
several lines, with comment marks before and after each. The identifiers, in order,
are then matched against rules: sequences of sentences with few others between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import UPPER
from marquee.llm.quality import let

#: One letter for each known sentence, in normal form. They are
#: sentences of public licence texts and of the usual notices.
SENTENCES = {
    "a": "licensed under the apache license version 2.0",
    "b": "you may not use this file except in compliance with the license",
    "c": "you may obtain a copy of the license at http //www.apache.org/licenses/license-2.0",
    "d": "licensed under the apache license version 2.0 the license",
    "e": "released under the mit license",
    "f": "licensed under the mit license",
    "g": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "h": "the software is provided as is without warranty of any kind express or implied",
    "i": "this work is licensed under the gnu general public license version 3",
    "j": "this work is licensed under the gnu general public license version 2",
    "k": "this program is distributed in the hope that it will be useful but without any warranty",
    "l": "see the gnu general public license for more details",
    "m": "licensed under cc by 4.0",
    "n": "licensed under cc by-sa 4.0",
    "o": "licensed under cc by-nc 4.0",
    "p": "licensed under cc by-nc-sa 4.0",
    "q": "this work is licensed under a creative commons attribution 4.0 international license",
    "r": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "s": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "t": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "u": "all rights reserved",
    "v": "released under the bsd license",
    "w": "licensed under the mozilla public license version 2.0",
}

#: Other wordings of known sentences, as the licences' own notices have them; "|" is
#: any end of a sentence, line or paragraph.
WORDINGS = [
    ("c", "you may obtain a copy of the license at|http //www.apache.org/licenses/license-2.0"),
    ("h", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("i", "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("j", "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation|either version 2 of the license or at your option any later version"),
]

#: Licence and its sentences in order; "~" lets up to three others stand between.
#: The first rule that matches names the text's licence.
RULES = [
    ("BSD-3-Clause", "r~s~t"), ("BSD-2-Clause", "r~s"), ("BSD", "v"),
    ("Apache-2.0", "d~b~c"), ("Apache-2.0", "[ad]~b"), ("Apache-2.0", "[ad]"),
    ("MIT", "g~h"), ("MIT", "[ef]"),
    ("GPL-3.0", "i~k~l"), ("GPL-3.0", "i"), ("GPL-2.0", "j"), ("GPL", "k~l"),
    ("CC-BY-NC-SA-4.0", "p"), ("CC-BY-NC-4.0", "o"), ("CC-BY-SA-4.0", "n"), ("CC-BY-4.0", "[mq]"),
    ("MPL-2.0", "w"),
    ("proprietary", "u"),
]

#: One more than the others that a rule lets stand between two sentences.
OTHERS = 4

#: Each known sentence holds one of these, so that other texts need not be cut.
ANCHORS = ("licens", "copyright", "warranty", "rights reserved")
#: How sentences end, and what stands between the words of the normal form.
SENTENCE_END = r"([.!?;:])[\x20\x09-\x0D]+"
BETWEEN = r"[^a-z0-9./+-]+"
EDGES = r"^[ ./+-]+|[ ./+-]+$"


def pattern(rule: str) -> str:
    """A rule as a regular expression over letters, with "." for unknown sentences."""
    return rule.replace("~", f"[.a-z]{{0,{OTHERS - 1}}}")


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def normal_form(sentence: Column) -> Column:
    """Lower case, words apart by one space, no marks at the ends."""
    return F.regexp_replace(F.regexp_replace(_lower(sentence), BETWEEN, " "), EDGES, "")


#: In a text in lower case: the end of a sentence or paragraph, and of any other line.
END, LINE = "Y", "Z"


def _marked(text: Column) -> Column:
    """Normal forms of a text's sentences, with END between them and LINE where a line ends in one."""
    lines = F.regexp_replace(_lower(text), r"\r\n?", "\n")
    bare = F.regexp_replace(lines, r"(^|\n)[^a-z0-9\n]+", "$1")  # comment marks; lines of nothing else are blank
    ended = F.regexp_replace(F.regexp_replace(bare, SENTENCE_END, f" {END} "), r"\n{2,}", f" {END} ")
    spaced = F.regexp_replace(F.regexp_replace(ended, r"\n", f" {LINE} "), r"[^a-z0-9./+YZ-]+", " ")
    whole = F.regexp_replace(spaced, r"(?<![ ./+YZ-])[ ./+Z-]*+Y[ ./+YZ-]*+", END)
    return F.regexp_replace(F.regexp_replace(whole, r"(?<![ ./+Z-])[ ./+-]*+Z[ ./+Z-]*+", LINE), EDGES, "")


def known_sentences() -> dict[str, str]:
    """Every known wording with its letter, "|" for the end of a sentence inside it.

    Where a wording may end a sentence or go on, both forms are known.
    """
    known = {sentence: letter for letter, sentence in SENTENCES.items()}
    for letter, wording in WORDINGS:
        known |= {wording: letter, wording.replace("|", " "): letter}
    return known


def _longest_known(pieces: Column, known: dict[str, str]) -> Column:
    """For each piece the letter and number of pieces of the longest known sentence that begins there.

    Only pieces that begin as a known sentence does are looked at, and runs grow from
    them until they are as long as the longest. Each run is one look-up.
    """
    letter_of = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    first_words = F.lit(sorted({sentence.split(" ")[0] for sentence in known}))
    most_pieces = max(len(sentence.replace("|", " ").split(" ")) for sentence in known)
    none = F.struct(F.lit(None).cast("string").alias("letter"), F.lit(0).alias("n"))

    def at(piece: Column, i: Column) -> Column:
        start = F.struct(F.lit("").alias("run"), F.lit(0).alias("n"), none.alias("best"))

        def longer(state: Column, following: Column) -> Column:
            run, n = F.concat(state["run"], following["text"]), state["n"] + 1
            letter = F.element_at(letter_of, run)
            best = F.when(letter.isNotNull(), F.struct(letter.alias("letter"), n.alias("n"))).otherwise(state["best"])
            return F.struct(F.concat(run, following["gap"]).alias("run"), n.alias("n"), best.alias("best"))

        grown = F.aggregate(F.slice(pieces, i + 1, most_pieces), start, longer, lambda state: state["best"])
        return F.when(F.array_contains(first_words, F.substring_index(piece["text"], " ", 1)), grown).otherwise(none)

    return F.transform(pieces, at)


def letters(text: Column) -> Column:
    """One letter per known sentence of a text, "." for each other between them.

    No rule spans ``OTHERS`` others, so that a longer row of them is as good as one of that length.
    """

    def pieces(marked: Column) -> Column:
        texts = F.split(marked, f"[{END}{LINE}]")
        signs = F.regexp_extract_all(marked, F.lit(f"[{END}{LINE}]"), F.lit(0))
        gaps = F.transform(signs, lambda sign: F.translate(sign, END + LINE, "| "))
        return F.transform(
            F.arrays_zip(texts.alias("text"), gaps.alias("gap")),
            lambda p: F.struct(p["text"].alias("text"), F.coalesce(p["gap"], F.lit("")).alias("gap")),
        )

    def coded(cut: Column) -> Column:
        def state(code: Column, taken: Column, in_other: Column, others: Column) -> Column:
            return F.struct(code.alias("code"), taken.alias("taken"), in_other.alias("in_other"), others.alias("others"))

        def step(s: Column, p: Column) -> Column:
            """``taken``: pieces that a sentence found before still covers; ``others``: dots in a row."""
            goes_on, found = p["piece"]["gap"] == " ", p["found"]
            adds = ~s["in_other"] & (s["others"] < OTHERS)
            return (
                F.when(s["taken"] > 0, state(s["code"], s["taken"] - 1, F.lit(False), F.lit(0)))
                .when(found["n"] > 0, state(F.concat(s["code"], found["letter"]), found["n"] - 1, F.lit(False), F.lit(0)))
                .when(adds, state(F.concat(s["code"], F.lit(".")), F.lit(0), goes_on, s["others"] + 1))
                .otherwise(state(s["code"], F.lit(0), goes_on, s["others"]))
            )

        found = F.arrays_zip(cut.alias("piece"), _longest_known(cut, known_sentences()).alias("found"))
        return F.aggregate(found, state(F.lit(""), F.lit(0), F.lit(False), F.lit(0)), step, lambda s: s["code"])

    return let(_marked(text), lambda marked: F.when(marked == "", F.lit("")).otherwise(let(pieces(marked), coded)))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with sentence_ids, licence and licences.

    ``sentence_ids``: the letters of the known sentences in order; ``licences``:
    all whose rules match, in the rules' order, joined by commas; ``licence``:
    the first of them. NULL, empty and other texts without known sentences have
    an empty sequence and NULL licences. Rows stay apart and where they are;
    own columns of these names are replaced.
    """
    of = F.coalesce(F.col(text), F.lit(""))
    held = F.lit(False)
    for anchor in ANCHORS:
        held = held | F.contains(_lower(of), F.lit(anchor.split()[-1]))  # a line may end before it
    coded = docs.withColumn("sentence_ids", F.when(held, letters(of)).otherwise(F.lit("")))
    code = F.col("sentence_ids")
    matches = F.array_distinct(F.array_compact(F.array(*[F.when(code.rlike(pattern(rule)), F.lit(name)) for name, rule in RULES])))
    coded = coded.withColumn("licences", F.when(code.rlike("[a-z]"), F.nullif(F.array_join(matches, ","), F.lit(""))))
    return coded.withColumns({
        "licence": F.substring_index("licences", ",", 1),
        "sentence_ids": F.regexp_replace("sentence_ids", r"\.", ""),
    })
