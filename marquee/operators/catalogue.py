"""Filters, joins and aggregations over the catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.catalogue import decade, exact_rating, listed, weighted_score


def preview(table: DataFrame, *columns: str, rows: int = 10, key: str | None = None) -> DataFrame:
    """A few rows of a table; the first ones by ``key`` if one is given."""
    if key is not None:
        table = table.orderBy(key)
    return table.limit(rows).select(*columns)


def titles_of_type(titles: DataFrame, title_type: str = "movie") -> DataFrame:
    return titles.where(F.col("titleType") == F.lit(title_type)).select("tconst", "titleType")


def genre_years(titles: DataFrame) -> DataFrame:
    """One row ``(decade, genre)`` per genre of each title with a known year."""
    return titles.where(F.col("startYear").isNotNull()).select(
        decade(F.col("startYear")).alias("decade"),
        F.explode(listed(F.col("genres"))).alias("genre"),
    )


def explode_directors(crew: DataFrame) -> DataFrame:
    """One row per title and director id, with the other columns of ``crew``."""
    others = [name for name in crew.columns if name != "directors"]
    return crew.where(F.col("directors").isNotNull()).select(
        *others, F.explode(listed(F.col("directors"))).alias("director")
    )


def crew_ratings(crew: DataFrame, ratings: DataFrame) -> DataFrame:
    """Director lists of the rated titles."""
    return (
        crew.where(F.col("directors").isNotNull())
        .select("tconst", "directors")
        .join(
            ratings.where(F.col("averageRating").isNotNull()).select("tconst", "averageRating"),
            "tconst",
        )
    )


def movie_crew_ratings(crew: DataFrame, ratings: DataFrame, titles: DataFrame) -> DataFrame:
    """Director lists of the rated movies; all three inputs meet on ``tconst``."""
    return crew_ratings(crew, ratings).join(titles_of_type(titles), "tconst")


def director_titles(
    crew: DataFrame, ratings: DataFrame, titles: DataFrame, names: DataFrame
) -> DataFrame:
    """One row per rated movie and director, under the director's name."""
    directed = explode_directors(
        movie_crew_ratings(crew, ratings, titles).drop("titleType")
    )
    people = names.select("nconst", "primaryName")
    return directed.join(people, directed["director"] == people["nconst"]).select(
        "primaryName", "averageRating", "tconst"
    )


def director_averages(
    crew: DataFrame,
    ratings: DataFrame,
    titles: DataFrame,
    names: DataFrame,
    by: str = "primaryName",
) -> DataFrame:
    """Mean rating and number of movies per director.

    People who share a name are one director, unless ``by="nconst"``. Sums per
    director id are formed before the names are joined: the exploded rows then
    never travel (partial sums do), a prolific director is a single row in the
    join, and the mean comes from the summed sums, which is the same mean. Sums
    are exact, so the ranking is the same however the rows were split.
    """
    films = movie_crew_ratings(crew, ratings, titles).select(
        "tconst", "directors", exact_rating(F.col("averageRating")).alias("rating")
    )
    tallies = (
        explode_directors(films)
        .groupBy("director")
        .agg(
            F.sum("rating").alias("rating_sum"),
            F.count("rating").alias("rated"),
            F.count("tconst").alias("movies"),
        )
    )
    people = names.select("nconst", "primaryName")
    keys = ["primaryName"] if by == "primaryName" else ["nconst", "primaryName"]
    return (
        tallies.join(people, tallies["director"] == people["nconst"])
        .groupBy(*keys)
        .agg(
            F.try_divide(F.sum("rating_sum").cast("double"), F.sum("rated")).alias(
                "averageRating"
            ),
            F.sum("movies").alias("movieCount"),
        )
    )


def director_scores(averages: DataFrame, digits: int | None = None) -> DataFrame:
    """Add ``weightedScore``; ``digits`` rounds it and the mean.

    Rounding makes ties that summation order would break by the last bit.
    """
    average = F.col("averageRating")
    score = weighted_score(average, F.col("movieCount"))
    if digits is not None:
        average, score = F.round(average, digits), F.round(score, digits)
    return averages.withColumns({"averageRating": average, "weightedScore": score})
