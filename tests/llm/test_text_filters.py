import re
from collections import Counter

import duckdb
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from marquee.llm import licences, quality, registered, toxicity, url_filter


@pytest.mark.parametrize("name", registered.ORACLES)
def test_query_equals_sql(spark, small, name):
    assert differences(registered.QUERIES[name](spark, small), connect(small), registered.ORACLES[name]) is None


def test_measures_equal_a_plain_count(odd, odd_rows):
    got = Counter((r["doc_id"], r["n_words"], r["n_repeat_words"], r["n_dup_lines"]) for r in quality.measures(odd).collect())
    expected = Counter()
    for doc, text, *_ in odd_rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        trios = list(zip(ws, ws[1:], ws[2:]))
        n = Counter(trios)
        covered = {k + d for k, t in enumerate(trios) if n[t] > 1 for d in (0, 1, 2)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected[doc, len(ws), len(covered), len(lines) - len(set(lines))] += 1
    assert got == expected


def test_the_order_of_rules_changes_no_verdict(odd, none):
    kept = {frozenset((r["doc_id"], r["rejected_by"] is None) for r in quality.cascade(odd, rules).collect()) for rules in (quality.RULES, quality.RULES[::-1])}
    assert len(kept) == 1
    assert quality.judged(none).count() == 0
    assert quality.judged(odd).count() == odd.count()


def test_best_order_puts_the_cheap_rejecting_rule_first():
    # Rule 0 rejects what rule 1 does and costs more; rule 2 rejects others.
    patterns = [(0b011, 50), (0b100, 20), (0, 30)]
    assert quality.best_order(quality.RULES[:3], patterns, [10.0, 1.0, 1.0]) == [1, 2, 0]


def test_known_sentences_are_in_normal_form_and_hold_an_anchor(spark):
    rows = spark.createDataFrame([(s,) for s in licences.SENTENCES.values()], "s string")
    assert rows.where(licences.normal_form(F.col("s")) != F.col("s")).count() == 0
    plain = [s for letter, s in licences.SENTENCES.items() if not any(a in s for a in licences.ANCHORS)]
    assert plain == []


def test_rules_match_sentences_in_order(spark, odd, none):
    texts = [
        "Released under the MIT License.", "Intro.\nLicensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License.",
        "All rights reserved.", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY. See the GNU General Public License for more details.",
        "See the GNU General Public License for more details. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY.", "A licensed driver.",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["licence"] for r in licences.scan(rows).orderBy("doc_id").collect()] == ["MIT", "Apache-2.0", "proprietary", "GPL", None, None]
    assert licences.scan(odd).where("licence is not null").count() == 0
    assert licences.scan(none).count() == 0


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software is
distributed on an "AS IS" BASIS."""
BSD2 = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2 = GPL3.replace("software:", "software;").replace("Foundation, either version 3", "Foundation; either version 2")
WRAPPED = [(MIT, "gh", "MIT"), (APACHE, "dbc", "Apache-2.0"), (BSD2, "urs", "BSD-2-Clause"), (BSD3, "urst", "BSD-3-Clause"), (GPL3, "ikl", "GPL-3.0"), (GPL2, "jkl", "GPL-2.0")]
#: One-line notices of the other rules, wrapped at each gap between words.
SHORT = {"e": "MIT", "f": "MIT", "v": "BSD", "a": "Apache-2.0", "i": "GPL-3.0", "j": "GPL-2.0", "m": "CC-BY-4.0", "n": "CC-BY-SA-4.0", "o": "CC-BY-NC-4.0", "p": "CC-BY-NC-SA-4.0", "q": "CC-BY-4.0", "w": "MPL-2.0", "u": "proprietary"}


def test_notices_are_found_over_several_lines(spark):
    cases = list(WRAPPED)
    for before, mark in (("", "# "), ("/*\n", " * "), ("", "// "), ("", ";; ")):
        cases += [(before + "\n".join((mark + line).rstrip() for line in text.split("\n")) + "\n", ids, name) for text, ids, name in WRAPPED]
    cases += [(text.replace("\n", "\r\n"), ids, name) for text, ids, name in WRAPPED]
    cases += [("Some words\n" + licences.SENTENCES[k].replace(" ", "\n") + ".\nMore words", k, name) for k, name in SHORT.items()]
    cases += [("licensed under\n\nthe mit license", "", None), ("it is not licensed under\nthe mit license", "", None), ("x\nlicensed under the mit license y", "", None)]
    first, last = (licences.SENTENCES[k].capitalize() + "." for k in "gh")
    for n in range(8):  # others between two sentences of a rule, over one line each or two
        for other in (" Another one.", " Another\none.", "\n\nAnother\none;\n"):
            cases.append((first + other * n + " " + last, "gh", "MIT" if n <= 3 else None))
    cases.append((("Some line without a mark\n" * 3 + "An end. ") * 20_000 + "All rights reserved.", "u", "proprietary"))
    rows = spark.createDataFrame([(k, text) for k, (text, *_) in enumerate(cases)], "doc_id long, text string")
    got = licences.scan(rows).orderBy("doc_id").collect()
    assert [(r["sentence_ids"], r["licence"]) for r in got] == [(ids, name) for _, ids, name in cases]
    con = duckdb.connect()
    con.register("documents", rows.toPandas())
    by_sql = con.sql(f"SELECT * FROM ({registered.ORACLES['op7_licence_scans']}) ORDER BY doc_id").fetchall()
    assert by_sql == [(r["doc_id"], r["sentence_ids"], r["licence"], r["licences"]) for r in got]


def test_grammar_scores_clauses_not_words():
    g = toxicity.Grammar((), ("vermisch",))
    score = g.clause_score
    assert score("you are an idiot") > score("an idiot") > score("she said you are an idiot") > score("you are not an idiot") > 0
    assert score("i will kill you") > 0 and score("kill the process") == 0
    assert 0 < score("vermischten") < 0.5 and score("vermisch") == 0
    assert [c for c, _ in g.clauses("Fine. You IDIOT! Fine; an idiotic thing")] == ["you idiot", "an idiotic thing"]


def test_composition_equals_running_one_after_the_other():
    import itertools

    parts = [toxicity.reported_speech(), toxicity.negation(), toxicity.target(), toxicity.insult(), toxicity.threat()]
    both = toxicity.compose(parts[0], toxicity.compose(parts[1], toxicity.compose(parts[2], toxicity.compose(parts[3], parts[4]))))
    moves, weights = toxicity.tabulate(both)
    for word in itertools.product(range(7), repeat=4):
        states, total, state, by_table = [p.start for p in parts], 0.0, 0, 0.0
        for read in word:
            by_table += weights[state][read]
            state = moves[state][read]
            for k, p in enumerate(parts):
                read, w, states[k] = p.step(states[k], read)
                total += w
        assert abs(total - by_table) < 1e-12


def test_toxicity_on_held_out_rows_and_odd_ones(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    got = registered.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.9
    assert got[got.toxic == 0].predicted.mean() < 0.02
    model = toxicity.learn(spark.createDataFrame([], "doc_id long, text string, toxic int"))
    out = toxicity.score(odd, model)
    assert out.count() == odd.count() and out.where("score < 0 or score > 1 or score is null").count() == 0
    assert toxicity.score(none, model).count() == 0


def test_toxicity_moves_no_column_but_the_text(spark, odd):
    # Arrow cannot hold a calendar interval: it must not be part of what goes to Python.
    model = toxicity.learn(spark.createDataFrame([], "doc_id long, text string, toxic int"))
    rows = odd.withColumn("since", F.expr("make_interval(1, doc_id)")).withColumn("found", F.lit("kept"))
    out = toxicity.score(rows, model)
    assert out.columns == [*(c for c in rows.columns if c != "score"), "toxic_clauses", "score"]
    assert out.where("found = 'kept' and cast(since as string) <=> cast(make_interval(1, doc_id) as string)").count() == odd.count()
    insult = spark.createDataFrame([(1, "Fine. You IDIOT!"), (2, "Fine.")], "doc_id long, text string")
    toxic = toxicity.score(insult, model).where("score >= 0.3")
    assert [(r["doc_id"], [c["clause"] for c in r["toxic_clauses"]]) for r in toxic.collect()] == [(1, ["you idiot"])]
    assert toxic._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_urls(spark, none):
    urls = [
        ("http://a.net/x", "a.net", "/x", "net/", "block"), ("https://WWW.example.NET/en/1?q", "www.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"), ("x://b.org/fr/9#t", "b.org", "/fr/9", "org/fr/", "allow"),
        ("http://notexample.com/de/1", "notexample.com", "/de/1", None, None), (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"),
        ("http://net", "net", "", None, None), ("http://h?x://y/z", "h", "", None, None), ("http://free-bets.example.com/en/3", "free-bets.example.com", "/en/3", None, "block"),
        ("http://library.example.org/en/3", "library.example.org", "/en/3", None, "allow"),
    ]
    rows = spark.createDataFrame([(k, u[0], "x") for k, u in enumerate(urls)], "page_id int, url string, host string")
    weights = url_filter.fit(url_filter.LABELLED_URLS)
    got = url_filter.judge(rows, weights, registered.URL_RULES).orderBy("page_id").collect()
    for r, (_, host, path, rule, verdict) in zip(got, urls):
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert verdict is None or r["verdict"] == verdict
    assert url_filter.judge(rows.where("false"), weights, registered.URL_RULES).count() == 0
    right = sum((1 / (1 + 2.718281828 ** -(weights[f].sum() + weights[-1]) / len(f) ** 0.5) > 0.5) == bool(y) for u, y in url_filter.LABELLED_URLS for f in [url_filter.features(*url_filter._python_parts(u))])
    assert right == len(url_filter.LABELLED_URLS)


def test_passed_rows_are_those_that_are_kept(spark, small, odd, none):
    """One expression for all of it, in which texts are split once."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for rows in (docs, odd, none):
        # The measures take the place of own columns of their names, which ``passed`` leaves alone.
        kept = quality.judged(rows).where("kept").select("doc_id", "text")
        got = quality.passed(rows)
        assert got.columns == rows.columns
        assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, kept.collect()))
    repeated = spark.createDataFrame([(1, "one two three four five " * 20), (2, " ".join(f"word{k} is here" for k in range(30)))], "doc_id bigint, text string")
    assert [r["doc_id"] for r in quality.passed(repeated).collect()] == [2]
    plan = quality.passed(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
