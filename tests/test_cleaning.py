import datetime as dt

import pytest
from pyspark.sql import functions as F

from tristrata.functions import dates, sanitize
from tristrata.functions.measures import exact_mean, share
from tristrata.plans.silver import silver


def column(spark, values, ddl, make):
    df = spark.createDataFrame([(v,) for v in values], f"v {ddl}")
    return [r[0] for r in df.select(make(F.col("v"))).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dates_in_text(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    day = dt.date(2020, 1, 2)
    try:
        texts = [
            "2020-01-02",
            "2020-01-02 03:04:05",
            "2020-1-2",
            "2020-01-02T03:04",
            "bad",
            "",
            None,
            "2020-13-02",
            "2020-02-30",
            "2020-01-023",
        ]
        assert column(spark, texts, "string", dates.parse_date) == [day] * 4 + [None] * 6
        texts = [
            "2020-01-02 03:04:05",
            "2020-1-2 3:4:5",
            "2020-01-02 03:04:05.123+02:00",
            "2020-01-02",
            "2020-01-02T03:04:05",
            "2020-01-02 24:00:00",
            "2020-02-30 00:00:00",
            None,
        ]
        parsed = column(spark, texts, "string", dates.parse_timestamp)
        assert parsed == [dt.datetime(2020, 1, 2, 3, 4, 5)] * 3 + [None] * 5
        days = column(spark, texts, "string", dates.parse_date_of_timestamp)
        assert days == [day] * 3 + [None] * 5
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_null_tokens_match_whole_values_only(spark):
    values = ["nan", "None", "null", "<NA>", "", "NAN", " nan", "NaT", None, "x"]
    kept = column(spark, values, "string", sanitize.drop_null_tokens)
    assert kept == [None] * 5 + ["NAN", " nan", "NaT", None, "x"]


def test_booleans(spark):
    texts = ["1", "0", "true", "True", "false", "False", "yes", "TRUE", None]
    expected = [True, False, True, True, False, False, None, None, None]
    assert column(spark, texts, "string", sanitize.to_boolean) == expected
    assert column(spark, [1, 0, 2], "int", sanitize.to_boolean) == [True, False, None]
    assert column(spark, [True, False, None], "boolean", sanitize.to_boolean) == [
        True,
        False,
        None,
    ]


def test_not_finite_becomes_null(spark):
    values = [float("nan"), float("inf"), float("-inf"), 1.5, None]
    assert column(spark, values, "double", sanitize.finite) == [None, None, None, 1.5, None]


def test_naive_timestamp(spark):
    texts = ["2020-01-02 03:04:05", "bad", None]
    parsed = column(spark, texts, "string", sanitize.to_naive_timestamp)
    assert parsed == [dt.datetime(2020, 1, 2, 3, 4, 5), None, None]


def test_exact_mean_ignores_partitioning(spark):
    df = spark.range(10_000).select((F.col("id") % 97 / 7.0).alias("x"))
    means = {df.repartition(n).agg(exact_mean("x")).first()[0] for n in (1, 3, 8)}
    assert len(means) == 1
    assert means.pop() == pytest.approx(df.agg(F.avg("x")).first()[0], abs=1e-8)
    assert df.where("x < 0").agg(exact_mean("x")).first()[0] is None


def test_share_of_nothing_is_null(spark):
    empty = spark.range(0)
    assert empty.agg(share(F.count("id"), F.count("id"))).first()[0] is None


def bronze(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn(
        "ingestion_timestamp", F.current_timestamp()
    )


def test_business(spark):
    ddl = """business_id string, name string, address string, city string, state string,
        postal_code string, latitude double, longitude double, stars string,
        review_count string, is_open int, attributes map<string,string>, categories string"""

    def row(i, name, is_open, stars="4.0", count="3"):
        return (i, name, None, None, None, None, 1.0, 2.0, stars, count, is_open, {}, None)

    rows = [
        row("a", "A", 1),
        row("b", "", 0),
        row("c", "C", 2, stars="x", count="x"),
        row("d", "D", None),
        row("e", None, 1),
        row(None, "F", 1),
    ]
    out = silver("business", bronze(spark, rows, ddl))
    assert out.columns == [
        "business_id",
        "business_name",
        "address",
        "city",
        "state",
        "postal_code",
        "latitude",
        "longitude",
        "avg_stars",
        "review_count",
        "is_open",
        "categories",
        "ingestion_timestamp",
        "processing_timestamp",
        "data_layer",
    ]
    found = {r.business_id: r for r in out.collect()}
    assert {k: r.is_open for k, r in found.items()} == {
        "a": True,
        "b": False,
        "c": False,
        "d": False,
    }
    assert found["b"].business_name == ""
    assert (found["c"].avg_stars, found["c"].review_count) == (None, None)
    assert (found["a"].avg_stars, found["a"].review_count) == (4.0, 3)
    assert {r.data_layer for r in found.values()} == {"silver"}


def test_review(spark):
    ddl = """review_id string, user_id string, business_id string, stars double, useful int,
        funny int, cool int, text string, date string"""
    when = "2023-01-01 12:00:00"
    rows = [
        ("r1", "u", "b", 4.0, 1, 0, 1, "héé😀", when),
        ("r2", "u", "b", 4.0, 1, 0, 1, None, "2023-01-01"),
        ("r3", "u", "b", None, 1, 0, 1, "x", when),
        ("r4", None, "b", 4.0, 1, 0, 1, "x", when),
        ("r5", "u", None, 4.0, 1, 0, 1, "x", when),
        (None, "u", "b", 4.0, 1, 0, 1, "x", when),
    ]
    out = silver("review", bronze(spark, rows, ddl))
    assert out.columns == [
        "review_id",
        "user_id",
        "business_id",
        "stars",
        "useful",
        "funny",
        "cool",
        "review_text",
        "review_date",
        "ingestion_timestamp",
        "text_length",
        "processing_timestamp",
        "data_layer",
    ]
    found = {r.review_id: (r.text_length, r.review_date) for r in out.collect()}
    assert found == {"r1": (4, dt.date(2023, 1, 1)), "r2": (None, None)}


def test_user(spark):
    ddl = """user_id string, name string, review_count int, yelping_since string, useful int,
        funny int, cool int, fans int, average_stars double"""
    rows = [
        (u, None, 1, since, 1, 1, 1, 1, 4.2)
        for u, since in [("a", "2020-01-02"), ("b", "2020-01-02 03:04:05"), ("c", "bad"), (None, "")]
    ]
    out = silver("user", bronze(spark, rows, ddl))
    found = {r.user_id: r.yelping_since for r in out.collect()}
    day = dt.date(2020, 1, 2)
    assert found == {"a": day, "b": day, "c": None}


def test_checkin(spark):
    rows = [
        ("a", "2020-01-01 00:00:00, 2020-01-02 00:00:01"),
        ("b", ""),
        ("c", None),
        ("d", "2020-01-01 00:00:00, bad"),
        (None, "2020-01-01 00:00:00"),
    ]
    out = silver("checkin", bronze(spark, rows, "business_id string, date string"))
    found = sorted(
        (r.business_id, r.checkin_date, r.checkin_datetime) for r in out.collect()
    )
    first = dt.datetime(2020, 1, 1)
    assert [f for f in found if f[0] != "d"] == [
        ("a", "2020-01-01 00:00:00", first),
        ("a", "2020-01-02 00:00:01", dt.datetime(2020, 1, 2, 0, 0, 1)),
        ("b", "", None),
    ]
    assert [f for f in found if f[0] == "d"] == [
        ("d", "2020-01-01 00:00:00", first),
        ("d", "bad", None),
    ]


def test_tip_without_text_stays(spark):
    ddl = "user_id string, business_id string, text string, date string, compliment_count int"
    rows = [
        ("u", "b", None, "2020-01-02 03:04:05", 0),
        ("u", None, "x", "2020-01-02 03:04:05", 0),
        (None, "b", "x", "2020-01-02 03:04:05", 0),
    ]
    out = silver("tip", bronze(spark, rows, ddl)).collect()
    assert [(r.tip_text, r.text_length, r.tip_date) for r in out] == [
        (None, None, dt.date(2020, 1, 2))
    ]
