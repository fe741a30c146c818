"""Text column expressions (SCL-1..6, SCL-17)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character class kept by both normalisers (Java regex, so
# \s is space, tab, newline, vertical tab, form feed, carriage return), and the
# printable range kept for display.
KEEP_PATTERN = r"[^a-zA-Z0-9\s]"
NON_ASCII_PATTERN = r"[^\x00-\x7F]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_lower_first(c: Column | str) -> Column:
    """Batch normaliser: lowercase, strip all but ASCII letters/digits/whitespace, trim spaces.

    ``trim`` removes only the space character, so leading tabs or newlines stay
    and inner whitespace is not collapsed.
    """
    return F.trim(F.regexp_replace(F.lower(_c(c)), KEEP_PATTERN, ""))


def clean_lower_last(c: Column | str) -> Column:
    """Universal normaliser: cast to string, strip, trim, then lowercase.

    Differs from :func:`clean_lower_first` on characters whose lowercase is
    ASCII (KELVIN SIGN becomes ``''`` here, ``'k'`` there).
    """
    return F.lower(F.trim(F.regexp_replace(_c(c).cast("string"), KEEP_PATTERN, "")))


def strip_non_ascii(c: Column | str) -> Column:
    """Drop every character outside 0x00-0x7F (display-safe text)."""
    return F.regexp_replace(_c(c), NON_ASCII_PATTERN, "")


def char_length(c: Column | str) -> Column:
    return F.length(_c(c))
