"""Rows against a table contract: repair, cast, and say what is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.contracts import ColumnRule, TableContract
from tristrata.functions import sanitize
from tristrata.operators.columns import unloadable


REASONS, UNPARSABLE = "reasons", "unparsable"
HELD, AS_IT_CAME = "is_held", "as_it_came"


def violations(df: DataFrame, contract: TableContract) -> list[Column]:
    """One expression per way a row can fail: its reason, or null."""
    return [
        problem
        for rule in contract.columns
        for problem in _problems(df, rule, rule.name in contract.key)
    ]


def accepted(df: DataFrame, contract: TableContract) -> DataFrame:
    """Sound rows, in the contract's columns and types."""
    sound = df.where(F.coalesce(F.lit(None), *violations(df, contract)).isNull())
    return sound.select(*(_conformed(df, r).alias(r.name) for r in contract.columns))


def quarantined(df: DataFrame, contract: TableContract) -> DataFrame:
    """Unsound rows as they came, with all their reasons joined by commas."""
    found = violations(df, contract)
    unsound = df.where(F.coalesce(F.lit(None), *found).isNotNull())
    return unsound.withColumn("reasons", F.concat_ws(",", *found))


def judged(df: DataFrame, contract: TableContract) -> DataFrame:
    """Every row as it came, with its ``reasons`` (null if sound) and ``unparsable``,
    the number of its dates and timestamps that cannot be read and become null."""
    found = violations(df, contract)
    lost = [
        F.when(_repaired(df, rule).isNotNull() & _typed(df, rule).isNull(), 1).otherwise(0)
        for rule in contract.columns
        if _is_moment(rule)
    ]
    return df.withColumns(
        {
            REASONS: F.nullif(F.concat_ws(",", *found), F.lit("")),
            UNPARSABLE: sum(lost, F.lit(0)).cast("long"),
        }
    )


def held_back(judged_rows: DataFrame) -> DataFrame:
    """Of ``judged`` rows the unsound ones, with their reasons."""
    return judged_rows.where(F.col(REASONS).isNotNull()).drop(UNPARSABLE)


def passed(judged_rows: DataFrame, contract: TableContract) -> DataFrame:
    """Of ``judged`` rows the sound ones, in the contract's columns and types."""
    rows = judged_rows.where(F.col(REASONS).isNull()).drop(REASONS, UNPARSABLE)
    return rows.select(*(_conformed(rows, r).alias(r.name) for r in contract.columns))


def told_apart(df: DataFrame, contract: TableContract) -> DataFrame:
    """Every row in the contract's columns, and whether it is ``HELD`` back.

    A row held back has nulls in them and stands in ``AS_IT_CAME``, with its reasons.
    ``unparsable`` is as in ``judged``.
    """
    rows = judged(df, contract)
    held = F.col(REASONS).isNotNull()
    return rows.select(
        *(F.when(~held, _conformed(df, r)).alias(r.name) for r in contract.columns),
        F.when(held, F.struct(*df.columns, REASONS)).alias(AS_IT_CAME),
        UNPARSABLE,
        held.alias(HELD),
    )


def loadable(df: DataFrame, contract: TableContract) -> DataFrame:
    """Only columns the contract names and a table can hold."""
    return df.drop(*unloadable(df, contract))


def _repaired(df: DataFrame, rule: ColumnRule) -> Column:
    """The value with stand-ins for "no value" removed, in its own type."""
    if rule.name not in df.columns:
        return F.lit(None)
    value, have = F.col(rule.name), df.schema[rule.name].dataType
    if isinstance(have, T.StringType):
        return sanitize.drop_null_tokens(value)
    if isinstance(have, (T.DoubleType, T.FloatType)):
        return sanitize.finite(value)
    return value


def _typed(df: DataFrame, rule: ColumnRule) -> Column:
    value = _repaired(df, rule)
    have = df.schema[rule.name].dataType if rule.name in df.columns else None
    wanted = T.DataType.fromDDL(rule.type)
    if isinstance(wanted, T.BooleanType) and have != wanted:
        return sanitize.to_boolean(value)
    if isinstance(wanted, T.TimestampNTZType):
        return sanitize.to_naive_timestamp(value)
    if isinstance(wanted, T.DateType):
        return sanitize.to_day(value)
    if isinstance(wanted, T.IntegralType) and isinstance(have, (T.DoubleType, T.FloatType)):
        # A fraction is rounded, as a relational integer column does.
        return F.round(value).try_cast(wanted)
    if isinstance(wanted, T.DecimalType) and isinstance(have, T.NumericType):
        # Casting a number that is too large works by a caught exception, which
        # costs far more than a comparison.
        limit = float(10 ** (wanted.precision - wanted.scale))
        return F.when(F.abs(value) < limit, value.try_cast(wanted))
    return value.try_cast(wanted)


def _is_moment(rule: ColumnRule) -> bool:
    return rule.type in ("date", "timestamp", "timestamp_ntz")


def _conformed(df: DataFrame, rule: ColumnRule) -> Column:
    value = _typed(df, rule)
    # Blanks beyond the length of a bounded text are cut, as SQL does.
    return F.substring(value, 1, rule.max_len) if rule.max_len else value


def _problems(df: DataFrame, rule: ColumnRule, is_key: bool) -> list[Column]:
    before, after = _repaired(df, rule), _typed(df, rule)
    found = []
    # Any yes/no spelling that is not known is read as no value, so only other
    # types can fail to cast, and a cast to its own type cannot.
    have = df.schema[rule.name].dataType.simpleString() if rule.name in df.columns else None
    # A date that cannot be read is no value; that is no reason to refuse the row.
    if rule.type not in ("boolean", "string", have) and not _is_moment(rule):
        found.append(F.when(before.isNotNull() & after.isNull(), f"bad_value:{rule.name}"))
    if rule.max_len:
        # Stand-ins for "no value" are short: where none can be too long, the
        # value is measured as it came.
        short = max(map(len, sanitize.NULL_TOKENS)) <= rule.max_len
        text = F.col(rule.name) if short and have == "string" else after
        too_long = F.length(F.rtrim(text)) > rule.max_len
        found.append(F.when(too_long, f"too_long:{rule.name}"))
    if is_key:
        found.append(F.when(after.isNull(), f"null_key:{rule.name}"))
    return found
