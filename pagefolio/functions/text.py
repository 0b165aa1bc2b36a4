"""Text helpers with Unicode rules for blanks, digits and word edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java patterns for "any blank", which here includes the four separators
# U+001C..U+001F.
BLANK = r"[\s\x1c-\x1f]"
EDGE_BLANKS = rf"(?U)\A{BLANK}+|{BLANK}+\z"


def strip(text: Column) -> Column:
    """Remove blanks of any kind from both ends (``trim`` only removes spaces)."""
    return F.regexp_replace(text, EDGE_BLANKS, "")


def collapse_blanks(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){BLANK}+", " ")


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"(?U)[^\s\x1c-\x1f]")


def word_count(text: Column) -> Column:
    """Number of blank-separated words."""
    return F.size(F.regexp_extract_all(text, F.lit(r"(?U)[^\s\x1c-\x1f]+"), F.lit(0)))


def let(value: Column, body) -> Column:
    """Compute ``value`` once and use it several times inside ``body``.

    An expression that stands inside a lambda is evaluated for every array item; binding it
    outside keeps that to once per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
