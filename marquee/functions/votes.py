"""Expressions over vote messages and the keys of stored votes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that a message part may be padded with.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
MIN_STARS, MAX_STARS = 1, 5
# Fixed value: the cell that holds a vote in the key-value store.
VOTE_CELL = "cf:vote"


def _message_pattern(digits: str) -> str:
    r"""Any character, text without "_", one "_", a padded number, any character.

    The end is ``\z``: ``$`` would also match before a line break.
    """
    return rf"(?s)\A.[^_]*_[{WHITESPACE}]*[+-]?{digits}[{WHITESPACE}]*.\z"


VOTE_MESSAGE = _message_pattern("[0-9]+")
# Up to nine digits always fit an INT.
SHORT_VOTE_MESSAGE = _message_pattern("0*[0-9]{1,9}")
NEEDS_ESCAPE = r'["\\\x00-\x1f]'


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def message_body(value: Column) -> Column:
    """The text between the first and the last character, whatever these are."""
    return F.substring(value, F.lit(2), F.length(value) - 2)


def message_title(value: Column) -> Column:
    return strip(F.substring_index(message_body(value), "_", 1))


def message_vote(value: Column) -> Column:
    """The vote as INT; NULL if it is no number or does not fit."""
    return strip(F.substring_index(message_body(value), "_", -1)).try_cast("int")


def is_vote_message(value: Column) -> Column:
    """Whether a message has two parts, the second a whole number. Never NULL.

    As a rule one pattern decides; only long numbers have to be cast here.
    """
    fits = value.rlike(VOTE_MESSAGE) & message_vote(value).isNotNull()
    return F.coalesce(value.rlike(SHORT_VOTE_MESSAGE) | fits, F.lit(False))


def row_key(tconst: Column, ts_ms: Column) -> Column:
    return F.concat_ws("_", tconst, ts_ms.cast("string"))


def key_title(key: Column) -> Column:
    return F.split_part(key, F.lit("_"), F.lit(1))


def key_millis(key: Column) -> Column:
    return F.split_part(key, F.lit("_"), F.lit(2)).try_cast("bigint")


def message_value(tconst: Column, vote: Column) -> Column:
    """The message text: a JSON string holding ``tconst_vote``."""
    body = F.concat(tconst, F.lit("_"), vote.cast("string"))
    quote = F.lit('"')
    # to_json takes no bare string: encode a one-item array, drop its brackets.
    escaped = F.regexp_replace(F.to_json(F.array(body)), r"(?s)\A\[|\]\z", "")
    return F.when(tconst.rlike(NEEDS_ESCAPE), escaped).otherwise(F.concat(quote, body, quote))


def is_star_vote(tconst: Column, vote: Column) -> Column:
    """What a producer lets through: a title id and one to five stars."""
    return (tconst != "") & vote.between(MIN_STARS, MAX_STARS)
