"""Aggregate expressions shared by gold tables, views and checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(value: str | Column) -> Column:
    """Sum as bigint; null when every value is null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(value.cast("bigint"))


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; null counts as not holding."""
    return F.count_if(condition)


def is_missing(value: str | Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.isNull() | (value == "")


def exact_mean(value: str | Column, scale: int = 9) -> Column:
    """Mean that does not depend on the order rows arrive in.

    Adding doubles gives a last digit that changes with the partitioning.  Here
    each value becomes a whole number of ``10^-scale`` units, and those are added
    exactly; an empty group gives null.  Meant for means of means and other
    fractions; whole and half numbers are already safe under ``avg``.
    """
    value = F.col(value) if isinstance(value, str) else value
    # Decimals hold what a bigint cannot; a value beyond them is null or an error, by
    # the session's ANSI mode, and never another number.
    units = (value.cast("double") * F.lit(float(10**scale))).cast("decimal(28,0)")
    added = F.sum(units).cast("double")
    return F.try_divide(F.try_divide(added, F.count(value)), F.lit(float(10**scale)))


def share(part: Column, whole: Column) -> Column:
    """Percentage; null over an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole)
