"""Text helpers for raw delimited fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including the space counts as padding in the raw files.
_PADDING = "".join(chr(code) for code in range(0x21))


def strip_padding(c: Column) -> Column:
    """Trim spaces, tabs and other control characters on both sides."""
    return F.btrim(c, F.lit(_PADDING))


def unquote(c: Column) -> Column:
    """Trim, then remove one leading and one trailing double quote."""
    return F.regexp_replace(strip_padding(c), '^"|"$', "")


def is_blank(c: Column) -> Column:
    """Null, empty or padding only."""
    return F.coalesce(strip_padding(c) == "", F.lit(True))


def is_empty(c: Column) -> Column:
    """Null or empty; for text that is already stripped."""
    return F.coalesce(c == "", F.lit(True))


def squeeze(c: Column) -> Column:
    """Trim and turn every run of white space into one space."""
    return F.regexp_replace(strip_padding(c), r"\s+", " ")


def standardize_name(c: Column) -> Column:
    """Comparable form of a place name: upper case, no punctuation, no trailing number."""
    plain = F.translate(F.upper(c), ":,.-/", "     ")
    no_number = F.regexp_replace(plain, r"\s*\d+\s*$", "")
    return F.coalesce(F.btrim(F.regexp_replace(no_number, r"\s+", " ")), F.lit(""))
