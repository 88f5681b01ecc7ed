"""Uniqueness of keys: report, and keep the first."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def key_present(key: list[str]) -> Column:
    return reduce(and_, (F.col(k).isNotNull() for k in key))


def duplicate_keys(df: DataFrame, key: list[str], count_as: str = "n") -> DataFrame:
    """Keys held by more than one row, with their row count.

    Counted map-side first, so a hot key costs one row per map task.  Keys with
    a null in them never clash.
    """
    return (
        df.where(key_present(key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias(count_as))
        .where(F.col(count_as) > 1)
    )


def keep_first(
    df: DataFrame, key: list[str], order: list, nulls: bool = True
) -> DataFrame:
    """One row per key: the first by ``order``, which should be a total order.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so
    each map task passes on at most one row per key.  Rows with a null in the key
    all stay; ``nulls=False`` says there are none and saves reading for them.
    """
    first = W.partitionBy(*key).orderBy(*order)
    unique = (
        df.where(key_present(key))
        .withColumn("__rank", F.row_number().over(first))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )
    return unique.unionByName(df.where(~key_present(key))) if nulls else unique
