"""Stored schemas against contracts."""

import logging

import pytest
from pyspark.sql import types as T

from tristrata import jobs
from tristrata.contracts import WAREHOUSE, table
from tristrata.operators.schema_diff import Difference, against, differences
from tristrata.sinks.tables import read_table


def of(ddl):
    return T.DataType.fromDDL(f"struct<{ddl}>")


@pytest.mark.parametrize(
    "stored, wanted, expected",
    [
        ("a: int, B: string", "b: string, a: int", []),
        ("a: int", "a: bigint", [("a", "narrower", "int", "bigint")]),
        ("a: double", "a: float", [("a", "wider", "double", "float")]),
        ("a: decimal(5,2)", "a: decimal(7,2)", [("a", "narrower", "decimal(5,2)", "decimal(7,2)")]),
        ("a: decimal(9,4)", "a: decimal(7,2)", [("a", "wider", "decimal(9,4)", "decimal(7,2)")]),
        ("a: decimal(5,4)", "a: decimal(7,2)", [("a", "other_type", "decimal(5,4)", "decimal(7,2)")]),
        ("a: string", "a: date", [("a", "other_type", "string", "date")]),
        ("a: int", "b: int", [("b", "missing", None, "int"), ("a", "surplus", "int", None)]),
        (
            "a: array<struct<x: int, y: string>>, m: map<string, int>",
            "a: array<struct<x: bigint, z: string>>, m: map<string, bigint>",
            [
                ("a[].x", "narrower", "int", "bigint"),
                ("a[].z", "missing", None, "string"),
                ("a[].y", "surplus", "string", None),
                ("m.value", "narrower", "int", "bigint"),
            ],
        ),
    ],
)
def test_differences(spark, stored, wanted, expected):
    assert differences(of(stored), of(wanted)) == [Difference(*e) for e in expected]


def test_a_loaded_table_fits_its_contract(spark, tmp_path, caplog):
    rows = spark.createDataFrame([(1, "x", 2.5)], "id int, name string, rate double")
    first = table("t", "id int\nname varchar(5)\nrate decimal(5,2)", key=("id",))
    to = jobs.Delivery(str(tmp_path))
    jobs.load_table(spark, rows, first, to)
    assert against(read_table(spark, to.table("t")).schema, first) == []
    later = table("t", "id bigint\nrate decimal(4,2)\nmore string", key=("id",))
    with caplog.at_level(logging.WARNING):
        jobs.load_table(spark, rows, later, to)
    for text in ("id: narrower (stored int, wanted bigint)", "rate: wider", "more: missing", "name: surplus"):
        assert text in caplog.text
    assert against(read_table(spark, to.table("t")).schema, later) == []


def test_keys_as_statements():
    found = [c.key_statement for c in WAREHOUSE.values()]
    assert all(s.startswith("ALTER TABLE ") and s.endswith(")") for s in found)
    assert "ALTER TABLE reviews ADD PRIMARY KEY (review_id)" in found
