"""Dates out of text, without session flags and without failing on bad text.

The raw files were written for a parser that reads a pattern from the front of
the text, takes one-digit months and hours, and ignores what follows.  A regular
expression picks that front part and ``try_cast`` turns it into a value or null,
so the same text gives the same result with ANSI mode on or off.

Still null here, though such a parser takes them: years under four digits, fields
padded with blanks, and fields with superfluous leading zeros.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted layouts.
DAY = r"^\s*\d{4,}-\d{1,2}-\d{1,2}(?!\d)"
SECOND = r"^\s*\d{4,}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(?!\d)"


def parse_timestamp(text: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; anything else is null."""
    return F.regexp_extract(text, SECOND, 0).try_cast("timestamp")


def parse_date_of_timestamp(text: str | Column) -> Column:
    """The day of ``yyyy-MM-dd HH:mm:ss``; text without a time of day is null."""
    return parse_timestamp(text).cast("date")


def parse_date(text: str | Column) -> Column:
    """``yyyy-MM-dd``, with or without a time of day behind it."""
    return F.regexp_extract(text, DAY, 0).try_cast("date")
