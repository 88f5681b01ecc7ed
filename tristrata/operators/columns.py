"""Column names and column sets, decided before any row is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tristrata.contracts import TableContract


def normalized_name(name: str) -> str:
    return name.lower().replace(" ", "").replace("-", "_")


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case names without blanks, dashes as underscores; a clash is an error."""
    names = [normalized_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after normalising: {clashes}")
    return df.toDF(*names)


def unloadable(df: DataFrame, contract: TableContract) -> dict[str, str]:
    """Columns the table will not take, and why."""
    wanted = set(contract.column_names)
    reasons = {}
    for f in df.schema:
        if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)):
            reasons[f.name] = "nested type"
        elif f.name not in wanted:
            reasons[f.name] = "not in contract"
    return reasons
