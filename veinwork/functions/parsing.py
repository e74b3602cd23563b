"""Text to typed columns. Bad text becomes null instead of an error, also under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings of a flag.
TRUE_WORDS = ("Yes", "Y", "yes", "y", "True", "true", "TRUE", "1")
FALSE_WORDS = ("No", "N", "no", "n", "False", "false", "FALSE", "0")

# Date layouts tried in this order.
DATE_FORMATS = ("MM/dd/yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")

# Java number parsing takes a trailing type letter, as in "1d"; a CSV number has none.
_TYPE_LETTER = r"[0-9.][dDfF]\s*$"


def flag_from_words(text: Column) -> Column:
    """Boolean by vocabulary; unknown words and nulls are false."""
    return F.coalesce(
        F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False), F.lit(False)
    )


def known_flag_word(text: Column) -> Column:
    """Whether the raw text is one of the accepted spellings (null counts as not known)."""
    return F.coalesce(text.isin(*TRUE_WORDS, *FALSE_WORDS), F.lit(False))


def flag_from_value(value: Column) -> Column:
    """Boolean by truthiness for a column that is not text; null is false."""
    return F.coalesce(value.cast("boolean"), F.lit(False))


def double_from_text(text: Column) -> Column:
    return F.when(~F.coalesce(text.rlike(_TYPE_LETTER), F.lit(False)), text.try_cast("double"))


def whole_from_text(text: Column) -> Column:
    """Nullable bigint. Fractional and non-numeric text is null, `7.0` is 7."""
    number = double_from_text(text)
    return F.coalesce(
        text.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint"))
    )


def timestamp_from_text(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First layout that parses wins; the result carries no time zone."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("timestamp_ntz")
