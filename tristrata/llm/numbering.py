"""Gapless numbers within groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that are numbered together.
CELL_ROWS = 512


def number_within(
    rows: DataFrame, group: str, ties: list[str], name: str, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2 ... within each value of ``group``.

    Each group is dealt by a hash of ``ties`` into cells of about ``cell_rows`` rows.
    Cells are counted, their first numbers are running sums of the counts, and rows are
    numbered within their cell; so a group with most of the rows is spread over as many
    tasks as its rows need.  Rows that agree in all of ``ties`` share a cell.  The
    number of different groups must be bounded (here at most 1,024): their counts are
    broadcast.  Without rows the result is empty.  ``rows`` is read three times, so pass
    a written table.
    """
    spread = rows.groupBy(group).agg(
        F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias("_cells")
    )
    dealt = rows.join(F.broadcast(spread), group).withColumn(
        "_cell", F.pmod(F.xxhash64(*ties), F.col("_cells")).cast("int")
    )
    counted = dealt.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = counted.select(
        group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    within = Window.partitionBy(group, "_cell").orderBy(*ties)
    return (
        dealt.join(first, [group, "_cell"])
        .withColumn(name, (F.col("_first") + F.row_number().over(within) - 1).cast("long"))
        .drop("_cell", "_cells", "_first")
    )
