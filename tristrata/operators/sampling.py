"""A capped sample that is the same for any partitioning of the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digits of a digest that one histogram resolves (16 ** DIGITS counts come back).
DIGITS = 3
#: Rows at the boundary that are sorted rather than told apart by another histogram.
SORTED_ROWS = 50_000


def capped_sample(
    df: DataFrame, size: int, key: list[str], ties: list[str] | None = None
) -> DataFrame:
    """Exactly ``size`` rows (all, if there are fewer): those with the lowest digests.

    The digest of the key acts as a random but repeatable rank; rows with the same key
    follow the digest of their ``ties``, then the ties themselves.  A histogram of the
    digests' first digits shows the prefix at which ``size`` is reached; a further one
    resolves that prefix, until few rows have it.  Rows below the prefix pass unranked,
    by one comparison, and only those at the prefix are sorted.  So neither the sample
    nor a key with most of the rows has to fit one task.

    The histograms run here; each brings 16 ** DIGITS counts back at most.
    """
    ties = key if ties is None else ties
    digest = F.concat(_digest(key), _digest(ties))
    prefix, below = "", 0
    while True:
        at = F.substring(digest, 1, len(prefix) + DIGITS)
        rows = df.where(F.startswith(digest, F.lit(prefix))) if prefix else df
        counts = rows.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()
        reached = None
        for at_prefix, n in sorted(tuple(r) for r in counts):
            if below + n >= size:
                reached = at_prefix, n
                break
            below += n
        if reached is None:  # fewer rows than wanted
            return df
        prefix, here = reached
        upto = df.where(F.substring(digest, 1, len(prefix)) <= prefix)
        if below + here <= SORTED_ROWS:  # the whole sample is few rows
            return upto.orderBy(digest, *ties).limit(size)
        if below + here == size:
            return upto
        if here <= SORTED_ROWS or len(prefix) >= 64:
            break
    passing = df.where(F.substring(digest, 1, len(prefix)) < prefix)
    boundary = df.where(F.startswith(digest, F.lit(prefix)))
    # Past all digits the rows are equal, and any of them will do.
    ranked = boundary.orderBy(digest, *ties) if here <= SORTED_ROWS else boundary
    return passing.unionAll(ranked.limit(size - below))


def _digest(columns: list[str]) -> Column:
    return F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in columns)))
