"""Raw JSON under a declared schema, with nothing lost silently."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.contracts import RAW_SCHEMAS

MALFORMED = "_corrupt_record"
REJECT = "is_reject"


def read_raw(
    spark: SparkSession, path: str, dataset: str, multi_line: bool = False
) -> DataFrame:
    """One row per JSON object, plus the raw text of lines that did not fit.

    Fields missing from a line are null, fields not declared are ignored.  Lines
    are the unit of splitting, so a file of any size is read by many tasks;
    ``multi_line`` is for files that hold one array or pretty-printed objects,
    and such a file is read by one task.
    """
    return (
        spark.read.schema(f"{RAW_SCHEMAS[dataset]}, {MALFORMED} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("multiLine", multi_line)
        .json(path)
    )


def parse_json(df: DataFrame, text: str, schema: str) -> DataFrame:
    """The same reading for JSON that arrives in a column, which its fields replace.

    The one-element ``inline`` keeps later filters from being moved in front of the
    parsing, where each field they mention would be parsed for anew.
    """
    parsed = F.from_json(
        text,
        f"{schema}, {MALFORMED} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED},
    )
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.inline(F.array(parsed)))


def readable(raw: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Rows with at least one declared value, or none because the line had none.

    ``fields`` are the declared ones, all columns by default.

    A line with one bad field keeps its other fields; only a line that gave
    nothing at all is left out here (it is in :func:`malformed`).
    """
    fields = fields or [c for c in raw.columns if c != MALFORMED]
    any_value = reduce(or_, (F.col(f"`{c}`").isNotNull() for c in fields))
    return raw.where(F.col(MALFORMED).isNull() | any_value).drop(MALFORMED)


def malformed(raw: DataFrame) -> DataFrame:
    """Every line that did not fit the schema, and what could be read of it.

    A line is found bad only in fields the query asks for.  Asking for all of
    them in the filter keeps that independent of what the caller selects.
    """
    kept = F.to_json(F.struct(*(c for c in raw.columns if c != MALFORMED)))
    bad = raw.where(F.col(MALFORMED).isNotNull() & kept.isNotNull())
    return bad.select(F.col(MALFORMED).alias("line"), kept.alias("kept"))


def with_rejects(raw: DataFrame, fields: list[str]) -> DataFrame:
    """Readable rows and malformed lines out of one parse, apart by ``REJECT``.

    A line with one bad field gives a row of either kind: its fields, and its text in
    ``line`` with what could be read of it in ``kept``.  ``fields`` are the declared ones;
    further columns of ``raw`` stay with the fields.
    """
    others = [c for c in raw.columns if c != MALFORMED]
    kinds = {c: raw.schema[c].dataType for c in others}
    text = F.lit(None).cast("string")
    row = F.struct(*others, text.alias("line"), text.alias("kept"), F.lit(False).alias(REJECT))
    reject = F.struct(
        *(F.lit(None).cast(kinds[c]).alias(c) for c in others),
        F.col(MALFORMED).alias("line"),
        F.to_json(F.struct(*fields)).alias("kept"),
        F.lit(True).alias(REJECT),
    )
    is_bad = F.col(MALFORMED).isNotNull()
    gives_rows = reduce(or_, (F.col(f"`{c}`").isNotNull() for c in fields))
    kinds_of_row = (
        F.when(~is_bad, F.array(row)).when(gives_rows, F.array(row, reject)).otherwise(F.array(reject))
    )
    return raw.select(F.inline(kinds_of_row))


def audit_columns() -> list:
    """Rows read and rows malformed, as aggregates over a raw dataset."""
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"),
    ]


def audit_source(raw: DataFrame) -> DataFrame:
    """One row: rows read and rows malformed.  Every field is asked for, as a line is
    found bad only in fields that are.

    A missing path fails when :func:`read_raw` is called.
    """
    read = F.to_json(F.struct(*(c for c in raw.columns if c != MALFORMED)))
    return raw.where(read.isNotNull()).agg(*audit_columns())
