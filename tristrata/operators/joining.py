"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.operators.dedupe import keep_first, key_present

_ALSO = "__join_hash"


def join_summary(
    rows: DataFrame, summary: DataFrame, key: list[str], how: str = "left"
) -> DataFrame:
    """Join ``rows`` to a ``summary`` that has one row per key.

    Spark splits an oversized join partition at run time only if both inputs of
    the join come straight from a shuffle.  A summary is the output of an
    aggregate, which already sits on the key and would be joined in place, so the
    hot key of ``rows`` would be one task.  Joining on the key *and* its hash
    matches the same rows, yet asks for a partitioning the aggregate does not
    have: the summary (one narrow row per key) is shuffled once more, and the
    split becomes possible.  A summary that turns out small is still broadcast,
    by Spark's own size check.
    """
    also = F.xxhash64(*key)
    return (
        rows.withColumn(_ALSO, also)
        .join(summary.withColumn(_ALSO, also), [*key, _ALSO], how)
        .drop(_ALSO)
    )


def absent(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows whose key ``existing`` lacks, one per key.

    Of rows that share a key the first in column order is taken.  A null in a key
    equals nothing: such rows are always absent.

    Both sides are brought down to one row per key before they meet, map-side
    first, and they meet in the partitioning that did it: no hot key, and no
    shuffle for the join itself.
    """
    order = [f.name for f in incoming.schema if f.dataType.typeName() != "map"]
    candidates = keep_first(incoming, key, order, nulls=False)
    known = existing.select(*key).distinct()
    new = candidates.join(known, key, "left_anti").select(*incoming.columns)
    return new.unionByName(incoming.where(~key_present(key)))


def unique_rows(
    rows: DataFrame, repeated: DataFrame, key: list[str], order: list[str]
) -> DataFrame:
    """``rows`` with one row for each of the ``repeated`` keys: the first by ``order``.

    ``repeated`` has one row per key that is held more than once.  Other rows pass
    unranked.  The joins are :func:`join_summary`, so a hot key is split in them, and
    its rows are cut to one per task before the ranking's shuffle.
    """
    single = join_summary(rows, repeated.select(*key), key, "left_anti")
    multiple = join_summary(rows, repeated.select(*key), key, "left_semi")
    return single.unionByName(keep_first(multiple, key, order, nulls=False))


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, key: list[str]
) -> DataFrame:
    """Existing rows plus the absent ones; inserting twice adds nothing."""
    return existing.unionByName(absent(existing, incoming, key))
