"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import col

# Characters a question's cleaning turns into spaces, the one it
# drops, and the word that stands for a run of digits.
SPACED = '?:,"[]~*;!(){}@$#.-/'
DROPPED = "'"
NUMBER = "<number>"


def normalize_question(s) -> Column:
    """Lower-case ASCII words separated by one space, digit runs as one mark; null gives ""."""
    text = F.lower(col(s))
    text = F.translate(text, SPACED + DROPPED, " " * len(SPACED))
    text = F.regexp_replace(text, r"[^\x00-\x7F]", "")
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.coalesce(F.regexp_replace(text, r"[0-9]+", NUMBER), F.lit(""))


def words(s) -> Column:
    """Space-separated pieces, empty ones included (as a plain split gives them)."""
    return F.split(col(s), " ")


def word_set(s) -> Column:
    return F.array_distinct(words(s))


def word_count(s) -> Column:
    return F.size(words(s))


def is_base64(s) -> Column:
    """Decoding and encoding again gives the same text."""
    s = col(s)
    return F.coalesce(F.base64(F.try_to_binary(s, F.lit("base64"))) == s, F.lit(False))


def decode_base64(s) -> Column:
    """The bytes, or null if the text is not base64."""
    return F.when(is_base64(s), F.try_to_binary(col(s), F.lit("base64")))
