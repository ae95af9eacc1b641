"""The three aggregate reports and their chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.display import thousands, two_decimals
from marquee.operators.catalogue import director_averages, director_scores, genre_years
from marquee.operators.series import axis_maximum


def genre_by_decade(titles: DataFrame) -> DataFrame:
    """Titles per decade and genre, in that order."""
    return (
        genre_years(titles)
        .groupBy("decade", "genre")
        .agg(F.count("*").alias("count"))
        .orderBy("decade", "genre")
    )


def votes_by_title_type(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Sum of the vote counts per type of title, largest first."""
    return (
        titles.select("tconst", "titleType")
        .join(ratings.select("tconst", "numVotes"), "tconst")
        .groupBy("titleType")
        .agg(F.sum("numVotes").alias("totalVotes"))
        .orderBy(F.desc("totalVotes"), "titleType")
    )


def top_directors(
    crew: DataFrame,
    ratings: DataFrame,
    titles: DataFrame,
    names: DataFrame,
    rows: int = 25,
    by: str = "primaryName",
    digits: int | None = None,
) -> DataFrame:
    """The directors with the best mean rating, weighted by the number of movies.

    Equal scores are ordered by name (and id), so the result is repeatable.
    """
    averages = director_averages(crew, ratings, titles, names, by)
    ties = ["primaryName"] if by == "primaryName" else ["primaryName", "nconst"]
    return (
        director_scores(averages, digits)
        .orderBy(F.desc("weightedScore"), *ties)
        .limit(rows)
    )


def director_records(top: DataFrame) -> DataFrame:
    """The report's output record, where the name is called ``director``."""
    return top.select(
        F.col("primaryName").alias("director"), "averageRating", "movieCount", "weightedScore"
    )


def director_labels(top: DataFrame) -> DataFrame:
    return top.select(
        F.col("primaryName").alias("director"),
        two_decimals(F.col("averageRating")).alias("average_label"),
        "movieCount",
        two_decimals(F.col("weightedScore")).alias("score_label"),
    )


def title_type_labels(type_votes: DataFrame) -> DataFrame:
    return type_votes.select("titleType", thousands(F.col("totalVotes")).alias("votes_label"))


def rating_labels(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        "tconst",
        two_decimals(F.col("averageRating")).alias("rating"),
        thousands(F.col("numVotes")).alias("votes"),
    )


def axis_maxima(genre_counts: DataFrame, type_votes: DataFrame, top: DataFrame) -> DataFrame:
    """Upper ends of the three charts' value axes, one row each."""
    return (
        axis_maximum(genre_counts, "count", "count")
        .unionByName(axis_maximum(type_votes, "totalVotes", "totalVotes"))
        .unionByName(axis_maximum(top, "weightedScore", "weightedScore"))
    )
