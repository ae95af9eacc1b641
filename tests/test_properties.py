"""Random inputs against plain Python, and counts that must add up."""

import random

from pyspark.sql import functions as F

from marquee.operators import votes
from marquee.operators.catalogue import genre_years
from marquee.plans.analytics import genre_by_decade
from marquee.registry import adapters
from marquee.sources.dumps import read_dump


def expected_vote(message):
    """``(tconst, vote)`` of a message, None if it has to be rejected."""
    title, mark, number = message[1:-1].partition("_")
    number = number.strip()
    if not mark or not number.isascii() or not number.lstrip("+-").isdigit():
        return None
    try:
        vote = int(number)
    except ValueError:
        return None
    return (title.strip(), vote) if -(2**31) <= vote < 2**31 else None


def test_random_messages(spark):
    rng = random.Random(7)
    alphabet = '"t_ 0159+-.x\t\n\x1c\x85 　é'
    messages = ["".join(rng.choices(alphabet, k=rng.randint(0, 9))) for _ in range(6000)]
    messages += [
        f'"{rng.choice(" t")}{n}{rng.choice(["", " "])}_{rng.choice(["", " ", "+"])}{n}　"'
        for n in [rng.randint(-(2**33), 2**33) for _ in range(500)] + list(range(500))
    ]
    frame = spark.createDataFrame(list(enumerate(messages)), "msg_offset bigint, value string")
    expected = {i: v for i, m in enumerate(messages) if (v := expected_vote(m))}
    parsed = {row[0]: tuple(row[1:]) for row in votes.parse_votes(frame).collect()}
    assert parsed == expected and len(expected) > 500
    rejected = {row[0] for row in votes.rejected_messages(frame).collect()}
    assert rejected == set(range(len(messages))) - expected.keys()


def test_random_dump_lines(spark, tmp_path):
    rng = random.Random(11)
    alphabet = "ab\"'\\N,# é"

    def field():
        return rng.choice(["\\N", "", "".join(rng.choices(alphabet, k=rng.randint(1, 5)))])

    # A line of nothing but blanks is no row, so the first field has a letter.
    rows = [["k" + field(), field(), field()] for _ in range(2000)]
    text = "\n".join("\t".join(row) for row in [["tconst", "directors", "writers"], *rows])
    (tmp_path / "title.crew.tsv").write_text(text + "\n", encoding="utf-8")
    read = read_dump(spark, str(tmp_path), "title_crew")
    expected = [tuple(None if x == "\\N" else x for x in row) for row in rows]
    assert sorted(map(tuple, read.collect()), key=repr) == sorted(expected, key=repr)


def test_counts_add_up(spark, small):
    titles = adapters.titles(spark, small)
    counted = genre_by_decade(titles).agg(F.sum("count")).first()[0]
    assert counted == genre_years(titles).count()
    messages = adapters.messages(spark, small)
    assert (
        votes.parse_votes(messages).count() + votes.rejected_messages(messages).count()
        == messages.count()
    )
