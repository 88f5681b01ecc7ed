"""Cleaning as data: which columns, under which names and types, which required."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.operators.stamps import stamp_processed


@dataclass(frozen=True)
class Pick:
    """One output column, taken from ``source`` (its own name by default)."""

    name: str
    source: str | None = None
    type: str | None = None
    via: Callable[[Column], Column] | None = None

    def column(self) -> Column:
        value = F.col(self.source or self.name)
        if self.via:
            value = self.via(value)
        if self.type:
            value = value.try_cast(self.type)
        return value.alias(self.name)


@dataclass(frozen=True)
class CleanSpec:
    """``picks`` are projected, rows lacking a ``required`` value go, then ``derived``."""

    dataset: str
    picks: tuple[Pick, ...]
    required: tuple[str, ...]
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)


def require(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Keep rows where every named column has a value (an empty text is a value)."""
    return df.where(reduce(and_, (F.col(c).isNotNull() for c in columns)))


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Apply a spec: one projection, one filter, no shuffle."""
    picked = df.select(*(p.column() for p in spec.picks))
    kept = require(picked, spec.required)
    if spec.derived:
        kept = kept.withColumns({name: make() for name, make in spec.derived.items()})
    return stamp_processed(kept, "silver")
