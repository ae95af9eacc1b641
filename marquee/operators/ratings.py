"""Merging votes into ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.catalogue import merged_mean, rating_value
from marquee.functions.votes import row_key
from marquee.operators.votes import is_plain_id, vote_totals


def _merged_columns() -> list[Column]:
    """Output columns over a rating joined with the totals ``dn``/``ds``."""
    average, count = rating_value(F.col("averageRating")), F.col("numVotes").cast("bigint")
    mean = merged_mean(average, count, F.col("dn"), F.col("ds"))
    return [
        F.col("tconst"),
        F.when(F.col("dn") > 0, mean).otherwise(average).alias("averageRating"),
        (count + F.coalesce("dn", F.lit(0))).alias("numVotes"),
    ]


def merge_totals(ratings: DataFrame, totals: DataFrame) -> DataFrame:
    """Every rating with the totals of its title worked in, if it has any."""
    return ratings.join(totals, "tconst", "left").select(*_merged_columns())


def merge_voted(ratings: DataFrame, totals: DataFrame) -> DataFrame:
    """The same for the titles that have both a rating and votes."""
    return ratings.join(totals, "tconst").select(*_merged_columns())


def merged_ratings(ratings: DataFrame, votes: DataFrame) -> DataFrame:
    """Every rating with the votes of its title worked in."""
    return merge_totals(ratings, vote_totals(votes))


def rating_by_id(ratings: DataFrame, tconst: str) -> DataFrame:
    """The first rating of a title; no row if there is none."""
    return ratings.where(F.col("tconst") == F.lit(tconst)).limit(1)


def merged_rating_by_id(ratings: DataFrame, votes: DataFrame, tconst: str) -> DataFrame:
    """The merged rating of one title.

    No row for an unknown title, nor for one whose stored rating is incomplete
    while votes for it exist.
    """
    totals = vote_totals(votes.where(F.col("tconst") == F.lit(tconst)))
    complete = rating_value(F.col("averageRating")).isNotNull() & F.col("numVotes").isNotNull()
    return (
        rating_by_id(ratings, tconst)
        .join(totals, "tconst", "left")
        .where(F.col("dn").isNull() | complete)
        .select(*_merged_columns())
    )


def _pieces(text: Column, shortest: Column, longest: Column) -> Column:
    """The distinct substrings whose length lies between the two bounds."""

    def of_length(n: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - n + 1)
        return F.transform(starts, lambda start: F.substring(text, start, n))

    lengths = F.sequence(shortest, F.least(longest, F.length(text)))
    return F.array_distinct(F.flatten(F.transform(lengths, of_length)))


def _id_lengths(ratings: DataFrame) -> Column:
    """Shortest and longest ordinary and other ids, from one scan that all uses share."""
    plain, size = is_plain_id(F.col("tconst")), F.length("tconst")
    bounds = [
        bound(F.when(plain if ordinary else ~plain, size)).alias(f"{name}_{kind}")
        for ordinary, kind in ((True, "plain"), (False, "other"))
        for bound, name in ((F.min, "lo"), (F.max, "hi"))
    ]
    return ratings.agg(F.struct(*bounds)).scalar()


def _totals_of_pieces(
    totals: DataFrame, text: str, lengths: Column, kind: str, wanted: Column
) -> DataFrame:
    """Sum ``dn``/``ds`` over the pieces of ``text`` that could be an id of a kind."""
    lo, hi = F.col(f"lengths.lo_{kind}"), F.col(f"lengths.hi_{kind}")
    return (
        totals.withColumn("lengths", lengths)
        .where(lo.isNotNull() & (F.length(text) >= lo))
        .select("dn", "ds", text, F.explode(_pieces(F.col(text), lo, hi)).alias("piece"))
        .where((F.col(text) >= F.col("piece")) & wanted)
        .groupBy("piece")
        .agg(F.sum("dn").alias("dn"), F.sum("ds").alias("ds"))
    )


def merged_ratings_contains(ratings: DataFrame, votes: DataFrame) -> DataFrame:
    """Merge by "row key from the id on, containing the id" instead of equality.

    A title then also takes the votes of longer ids that contain its own. The
    condition is met by cutting each key into its pieces, as long as ids are,
    and matching pieces to ids by equality, which needs no pairwise comparison:

    * an ordinary id can only lie inside the voted title's id, and comparing
      it with that id gives the same answer as comparing it with the key, so
      the votes are first summed per title and only the titles are cut;
    * other ids (with ``_``, or digits only) are looked for in whole keys. If
      no rating has such an id, their length bounds are NULL and no key is cut.

    Both sides of the final join hold one row per id.
    """
    lengths = _id_lengths(ratings)
    piece_is_plain = is_plain_id(F.col("piece"))
    by_title = _totals_of_pieces(vote_totals(votes), "tconst", lengths, "plain", piece_is_plain)
    votes_by_key = votes.select(
        F.lit(1).cast("bigint").alias("dn"),
        F.col("vote").cast("bigint").alias("ds"),
        row_key(F.col("tconst"), F.col("ts_ms")).alias("row_key"),
    )
    by_key = _totals_of_pieces(votes_by_key, "row_key", lengths, "other", ~piece_is_plain)
    return merge_totals(ratings, by_title.unionByName(by_key).withColumnRenamed("piece", "tconst"))


def folded_columns() -> list[Column]:
    """Columns of the next ratings table over ratings next to their totals ``dn``/``ds``."""
    average, count = rating_value(F.col("averageRating")), F.col("numVotes").cast("bigint")
    zero = F.lit(0).cast("bigint")
    old_count, added = F.coalesce(count, zero), F.coalesce("dn", zero)
    old_sum = F.coalesce(average * count, F.lit(0.0))
    mean = F.try_divide(old_sum + F.col("ds"), old_count + added)
    return [
        F.col("tconst"),
        F.when(F.col("dn") > 0, mean).otherwise(average).alias("averageRating"),
        (old_count + added).alias("numVotes"),
    ]


def fold_totals(ratings: DataFrame, totals: DataFrame) -> DataFrame:
    """The next ratings table: merged ratings, and titles known from votes only.

    Missing values count as zero where votes are added; a title without votes
    keeps its rating.
    """
    return ratings.join(totals, "tconst", "full").select(*folded_columns())


def fold_votes(ratings: DataFrame, votes: DataFrame) -> DataFrame:
    return fold_totals(ratings, vote_totals(votes))
