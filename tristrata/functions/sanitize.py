"""Column repairs made before a value meets a warehouse type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value", and for yes and no.
NULL_TOKENS = ("nan", "None", "null", "<NA>", "")
TRUE_TOKENS = ("1", "true", "True")
FALSE_TOKENS = ("0", "false", "False")


def drop_null_tokens(value: str | Column, tokens=NULL_TOKENS) -> Column:
    """Whole-value, case-sensitive match; no trimming."""
    value = _column(value)
    return F.when(~value.isin(*tokens), value)


def to_boolean(value: str | Column, true=TRUE_TOKENS, false=FALSE_TOKENS) -> Column:
    """Known yes and no spellings, from text, numbers or booleans; else null."""
    text = _column(value).cast("string")
    return F.when(text.isin(*true), True).when(text.isin(*false), False)


def finite(value: str | Column) -> Column:
    """NaN and both infinities become null."""
    value = _column(value)
    bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.when(~bad, value)


def to_naive_timestamp(value: str | Column) -> Column:
    """A wall-clock timestamp, null where the value cannot be read as one."""
    return _column(value).try_cast("timestamp_ntz")


def to_day(value: str | Column) -> Column:
    """A date, null where the value cannot be read as one."""
    return _column(value).try_cast("date")


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
