"""What a stored table's schema lacks of a contract, and the other way round."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tristrata.contracts import TableContract

MISSING, SURPLUS, NARROWER, WIDER, OTHER = "missing", "surplus", "narrower", "wider", "other_type"

# Integer and floating types by width.
_WIDTHS = [
    [T.ByteType, T.ShortType, T.IntegerType, T.LongType],
    [T.FloatType, T.DoubleType],
]


@dataclass(frozen=True)
class Difference:
    """``column`` (with the path inside a nested type), what is different, and both types."""

    column: str
    kind: str
    stored: str | None
    wanted: str | None


def differences(stored: T.DataType, wanted: T.DataType, at: str = "") -> list[Difference]:
    """Differences of a ``stored`` type from the ``wanted`` one, nested ones included.

    ``missing``: only wanted; ``surplus``: only stored; ``narrower``: stored values are
    fewer than the wanted type allows, so a load may fail; ``wider``: more; ``other_type``:
    not to be compared.  Columns go by name, whatever their order and case.
    """
    if isinstance(stored, T.StructType) and isinstance(wanted, T.StructType):
        have = {f.name.lower(): f for f in stored.fields}
        want = {f.name.lower(): f for f in wanted.fields}
        found = []
        for name in dict.fromkeys([*want, *have]):
            path = f"{at}.{name}" if at else name
            if name not in have:
                found.append(Difference(path, MISSING, None, want[name].dataType.simpleString()))
            elif name not in want:
                found.append(Difference(path, SURPLUS, have[name].dataType.simpleString(), None))
            else:
                found += differences(have[name].dataType, want[name].dataType, path)
        return found
    if isinstance(stored, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return differences(stored.elementType, wanted.elementType, f"{at}[]")
    if isinstance(stored, T.MapType) and isinstance(wanted, T.MapType):
        return [
            *differences(stored.keyType, wanted.keyType, f"{at}.key"),
            *differences(stored.valueType, wanted.valueType, f"{at}.value"),
        ]
    kind = _compared(stored, wanted)
    both = stored.simpleString(), wanted.simpleString()
    return [Difference(at, kind, *both)] if kind else []


def against(stored: T.StructType, contract: TableContract) -> list[Difference]:
    """The stored table against the columns and stamps of its contract."""
    wanted = T.StructType(
        [T.StructField(c.name, T.DataType.fromDDL(c.type)) for c in contract.columns]
        + [T.StructField(name, T.TimestampType()) for name in contract.stamps]
    )
    return differences(stored, wanted)


def _compared(stored: T.DataType, wanted: T.DataType) -> str | None:
    if stored == wanted:
        return None
    if isinstance(stored, T.DecimalType) and isinstance(wanted, T.DecimalType):
        whole = stored.precision - stored.scale, wanted.precision - wanted.scale
        if whole[0] >= whole[1] and stored.scale >= wanted.scale:
            return WIDER
        if whole[0] <= whole[1] and stored.scale <= wanted.scale:
            return NARROWER
        return OTHER
    for family in _WIDTHS:
        if type(stored) in family and type(wanted) in family:
            return WIDER if family.index(type(stored)) > family.index(type(wanted)) else NARROWER
    return OTHER
