"""Splittable multi-line JSON against Spark's own multi-line mode and plain Python."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tristrata.sources.multiline import read_multiline, read_records
from tristrata.sources.ndjson import MALFORMED

SCHEMA = "id long, s string, tags array<string>, inner struct<a:int, b:string>"
ODD = ['plain', 'br{ack]ets}', '"quoted" \\ and {', '\\\\"}', 'é😀\n,[', '}{', '', '\\', ' "}" ']


@pytest.fixture(scope="module")
def small_splits(spark):
    """Splits of some hundred bytes, so that records cross them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, ("300", "10"), strict=True):
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def records(seed, n):
    r = random.Random(seed)
    return [
        {"id": k, "s": r.choice(ODD) * r.choice((1, 1, 40)), "tags": [r.choice(ODD) for _ in range(r.randint(0, 4))],
         "inner": {"a": k, "b": r.choice(ODD)}, "undeclared": {"x": [{}, {"y": "}"}]}}
        for k in range(n)
    ]


def found(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


@pytest.mark.parametrize("indent", [None, 1, 4])
@pytest.mark.parametrize("ascii", [True, False])
def test_arrays_are_read_as_by_spark(spark, small_splits, tmp_path, indent, ascii):
    for k in range(3):
        text = json.dumps(records(k, 40), indent=indent, ensure_ascii=ascii)
        (tmp_path / f"f{k}.json").write_text(text + "\n" * k)
    ours = read_multiline(spark, str(tmp_path), SCHEMA)
    assert ours.where(F.col(MALFORMED).isNotNull()).count() == 0
    theirs = spark.read.schema(SCHEMA).option("multiLine", True).json(str(tmp_path))
    assert found(ours.drop("source_file", MALFORMED)) == found(theirs)
    assert ours.groupBy("source_file").count().count() == 3


def test_records_keep_their_text(spark, small_splits, tmp_path):
    """Also without an array: objects one after the other."""
    rows = records(7, 60)
    texts = [json.dumps(r, indent=3) for r in rows]
    (tmp_path / "a.json").write_text(" \n".join(texts))
    (tmp_path / "b.json").write_text("﻿ [ " + ",".join(texts[:5]) + "]")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text(" [ ]\n")
    read = read_records(spark, str(tmp_path)).collect()
    by_file = {}
    for r in sorted(read, key=lambda r: (r.path, r.split, r.record)):
        by_file.setdefault(r.path[-6:], []).append(r.text)
    assert by_file == {"a.json": texts, "b.json": texts[:5]}


def test_what_does_not_fit_is_kept_as_text(spark, small_splits, tmp_path):
    good = json.dumps(records(1, 3))[1:-1]
    (tmp_path / "cut.json").write_text("[" + good + ', {"id": 9, "s": "cut off')
    (tmp_path / "bad.json").write_text("[" + good + ', {"id": "word", "s": "x"}, {"id" 5}]')
    rows = read_multiline(spark, str(tmp_path), SCHEMA).collect()
    bad = {(r.source_file, r[MALFORMED], r.s) for r in rows if r[MALFORMED]}
    assert bad == {
        ("cut.json", '{"id": 9, "s": "cut off', None),
        ("bad.json", '{"id": "word", "s": "x"}', "x"),
        ("bad.json", '{"id" 5}', None),
    }
    assert len(rows) == 9


def test_a_large_file_uses_many_tasks(spark, small_splits, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(records(3, 300), indent=2))
    read = read_records(spark, str(tmp_path))
    assert read.count() == 300
    assert read.select("split").distinct().count() > 20
    theirs = spark.read.schema(SCHEMA).option("multiLine", True).json(str(tmp_path))
    assert theirs.rdd.getNumPartitions() == 1


def test_records_cross_batches_and_splits(spark, small_splits, tmp_path):
    """A task sees a few chunks at once, a record in many pieces, and files of one split."""
    rows = [{"id": k, "s": ODD[k % len(ODD)], "x": [{"y": "}"}] * (k % 9)} for k in range(120)]
    texts = [json.dumps(r, indent=1) for r in rows]
    (tmp_path / "long.json").write_text("[" + ",\n".join(texts) + "]\n")
    (tmp_path / "cut.json").write_text("\n".join(texts)[:-3])
    for k in range(5):
        (tmp_path / f"short{k}.json").write_text(texts[k + 3] if k % 2 else f"[{texts[k]}, {texts[0]}] ")
    rows_at_once = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows_at_once)
    spark.conf.set(rows_at_once, "3")
    try:
        read = read_records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set(rows_at_once, before)
    by_file = {}
    for r in sorted(read, key=lambda r: (r.path, r.split, r.record)):
        by_file.setdefault(r.path.split("/")[-1][:-5], []).append(r.text)
    short = {f"short{k}": [texts[k + 3]] if k % 2 else [texts[k], texts[0]] for k in range(5)}
    cut = [*texts[:-1], texts[-1][:-3].rstrip(" ")]
    assert by_file == {"long": texts, "cut": cut, **short}


def test_a_split_is_not_gathered_in_a_task(spark, small_splits, tmp_path):
    """No sort, window or shuffle has the chunks of a split, whose size is that of its text:
    what is shuffled is by file, and a few rows a split."""
    (tmp_path / "one.json").write_text(json.dumps(records(3, 300), indent=2))
    read = read_records(spark, str(tmp_path))
    assert read.count() == 300
    plan = read._jdf.queryExecution().executedPlan().toString()
    by = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert by and not [b for b in by if "split" in b], by
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    # Each reading has the same splits, also if executors come or go between them.
    assert int(spark.conf.get("spark.sql.files.minPartitionNum")) >= 1
