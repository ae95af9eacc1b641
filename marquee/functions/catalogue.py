"""Expressions over catalogue columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decade(year: Column) -> Column:
    """First year of the decade, as BIGINT; years before 0 floor downwards."""
    return F.floor(year / 10) * 10


def listed(text: Column) -> Column:
    """The items of a comma-joined list. Empty items stay; NULL stays NULL."""
    return F.split(text, ",")


def rating_value(rating: Column) -> Column:
    """A rating as DOUBLE whether stored as text or number; bad text is NULL."""
    return rating.try_cast("double")


def exact_rating(rating: Column) -> Column:
    """A rating as DECIMAL, whose sum does not depend on the order of the rows."""
    return rating.try_cast("decimal(38,18)")


def weighted_score(average: Column, titles: Column) -> Column:
    return average * F.log(titles + 1)


def merged_mean(average: Column, count: Column, added: Column, added_sum: Column) -> Column:
    """Mean of ``count`` old votes averaging ``average`` and ``added`` new ones."""
    return F.try_divide(average * count + added_sum, count + added)
