"""Text columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """Lower-cased words of ``text``, in order, as an array.

    Anything but ``[a-zA-Z0-9_]`` separates words, so accented letters do too.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(r"\w+"), F.lit(0))


def joined_words(text: Column) -> Column:
    """The same words as one string, with a space between."""
    return F.trim(F.regexp_replace(F.lower(text), r"\W+", " "))


def has_words(text: Column) -> Column:
    return F.lower(text).rlike(r"\w")
