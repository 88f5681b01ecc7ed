import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tristrata.contracts import table
from tristrata.functions.measures import exact_mean
from tristrata.operators import conform
from tristrata.operators.columns import normalize_names, unloadable
from tristrata.operators.dedupe import duplicate_keys, keep_first
from tristrata.operators.joining import absent, insert_if_absent
from tristrata.operators import sampling
from tristrata.operators.sampling import capped_sample
from tristrata.plans import gold, rules, views


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- names --------------------------------------------------------------------


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`My Col-A` int, b int")
    assert normalize_names(df).columns == ["mycol_a", "b"]


def test_names_that_collide(spark):
    df = spark.createDataFrame([(1, 2)], "`a-b` int, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        normalize_names(df)


# --- contracts ----------------------------------------------------------------

CONTRACT = table(
    "t",
    """
    id varchar(5)
    state varchar(3)
    stars decimal(3,2)
    n int
    open boolean
    """,
    key=("id",),
)
DDL = "id string, state string, stars double, n string, open string, extra int, m map<string,string>"


def test_contract(spark):
    df = spark.createDataFrame(
        [
            ("a", "AZ", 4.125, "1", "True", 1, {}),
            ("b", "AZ  ", float("nan"), "nan", "yes", 1, {}),
            ("c", "long", 12.5, "x", "0", 1, {}),
            ("nan", "AZ", 9.995, "1", "0", 1, {}),
            ("d", None, float("inf"), None, None, 1, {}),
            ("sixsix", "AZ", -9.99, "1", "1", 1, {}),
        ],
        DDL,
    )
    assert unloadable(df, CONTRACT) == {"extra": "not in contract", "m": "nested type"}
    prepared = conform.loadable(df, CONTRACT)
    good = conform.accepted(prepared, CONTRACT)
    assert good.schema.simpleString() == (
        "struct<id:string,state:string,stars:decimal(3,2),n:int,open:boolean>"
    )
    assert rows(good) == [
        ("a", "AZ", Decimal("4.13"), 1, True),
        ("b", "AZ ", None, None, None),
        ("d", None, None, None, None),
    ]
    bad = {r.id: r.reasons for r in conform.quarantined(prepared, CONTRACT).collect()}
    assert bad == {
        "c": "too_long:state,bad_value:stars,bad_value:n",
        "nan": "null_key:id,bad_value:stars",
        "sixsix": "too_long:id",
    }


def test_missing_contract_columns_are_null(spark):
    df = spark.createDataFrame([("a",)], "id string")
    assert rows(conform.accepted(df, CONTRACT)) == [("a", None, None, None, None)]


# --- keys ---------------------------------------------------------------------


def keyed(spark):
    data = [("a", "x", 2), ("a", "x", 1), ("b", "x", 3), (None, "x", 4), (None, "x", 5)]
    return spark.createDataFrame(data, "k1 string, k2 string, v int")


def test_keep_first(spark):
    assert rows(keep_first(keyed(spark), ["k1", "k2"], ["v"])) == [
        ("a", "x", 1),
        ("b", "x", 3),
        (None, "x", 4),
        (None, "x", 5),
    ]


def test_duplicate_report_skips_null_keys(spark):
    assert rows(duplicate_keys(keyed(spark), ["k1", "k2"])) == [("a", "x", 2)]


def test_insert_twice_adds_nothing(spark):
    stored = spark.createDataFrame([("a", "x", 9)], "k1 string, k2 string, v int")
    once = insert_if_absent(stored, keyed(spark), ["k1", "k2"])
    assert rows(once) == [("a", "x", 9), ("b", "x", 3), (None, "x", 4), (None, "x", 5)]
    new = absent(once, keyed(spark).where("k1 is not null"), ["k1", "k2"])
    assert new.count() == 0


# --- sample -------------------------------------------------------------------


def numbered(spark, n, parts=8):
    return spark.range(n).select(F.col("id").cast("string").alias("id")).repartition(parts)


@pytest.mark.parametrize("total, size", [(10, 20), (20, 20), (100, 20), (5000, 700), (0, 5)])
def test_sample_size(spark, total, size):
    assert capped_sample(numbered(spark, total), size, ["id"]).count() == min(total, size)


def test_sample_is_the_lowest_digests_whatever_the_layout(spark):
    ids = sorted((str(i) for i in range(3000)), key=lambda i: hashlib.md5(i.encode()).digest())
    for parts in (1, 7):
        drawn = capped_sample(numbered(spark, 3000, parts), 100, ["id"]).collect()
        assert [r.id for r in drawn] == ids[:100]


@pytest.mark.parametrize("sorted_rows", [1, 7, 10_000])
def test_sample_refined_to_any_depth(spark, monkeypatch, sorted_rows):
    import hashlib

    monkeypatch.setattr(sampling, "SORTED_ROWS", sorted_rows)
    rows = [(k % 40, k) for k in range(400)] + [(3, 3)] * 30  # shared keys, equal rows
    df = spark.createDataFrame(rows, "id long, v long").repartition(7)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    ranked = sorted(rows, key=lambda r: (md5(str(r[0])), md5(str(r[1])), r[1]))
    for size in (1, 9, 50, 399, 430, 1000):
        drawn = capped_sample(df, size, ["id"], ["v"]).collect()
        assert sorted(tuple(r) for r in drawn) == sorted(ranked[:size])


def test_sample_compares_once_and_sorts_the_boundary_only(spark, monkeypatch):
    monkeypatch.setattr(sampling, "SORTED_ROWS", 500)
    drawn = capped_sample(numbered(spark, 20_000), 9_000, ["id"])
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Sort [") == 1 and "Join" not in plan and "Aggregate" not in plan
    assert "GlobalLimit" in plan and "GlobalLimit 9000" not in plan
    assert drawn.count() == 9_000


def test_sample_with_one_hot_key(spark):
    df = numbered(spark, 900).union(numbered(spark, 300).withColumn("id", F.lit("hot")))
    assert capped_sample(df, 250, ["id"]).count() == 250


# --- gold ---------------------------------------------------------------------

REVIEW = "review_id string, user_id string, business_id string, stars double, useful int, " \
    "funny int, cool int, text_length int"
BUSINESS = "business_id string, business_name string, city string, state string, " \
    "avg_stars double, review_count int, is_open boolean, categories string"


def businesses(spark):
    return spark.createDataFrame(
        [
            ("a", "A", "P", "AZ", 4.0, 1, True, None),
            ("b", "B", None, "AZ", 2.0, 1, False, None),
            ("c", "C", None, "AZ", None, 1, False, None),
            ("d", "D", "Q", "NV", 3.0, 1, None, None),
        ],
        BUSINESS,
    )


def reviews(spark):
    return spark.createDataFrame(
        [
            ("r1", "u", "a", 4.0, 1, None, 0, 10),
            ("r2", "u", "a", 5.0, 2, None, 0, None),
            ("r3", "v", "b", 1.0, 3, None, 0, 4),
        ],
        REVIEW,
    )


def test_business_without_reviews_has_nulls(spark):
    out = gold.business_analytics(businesses(spark), reviews(spark))
    found = {r.business_id: r for r in out.collect()}
    a, c = found["a"], found["c"]
    assert (a.actual_review_count, a.avg_review_stars, a.total_useful_votes) == (2, 4.5, 3)
    assert a.total_funny_votes is None and a.total_cool_votes == 0
    assert (c.actual_review_count, c.avg_review_stars, c.total_cool_votes) == (None,) * 3
    assert dict(out.dtypes)["total_useful_votes"] == "bigint"
    assert out.columns == gold.BUSINESS_COLUMNS + ["processing_timestamp", "data_layer"]


def test_repeated_business_keeps_both_rows(spark):
    twice = businesses(spark).union(businesses(spark).where("business_id = 'a'"))
    out = gold.business_analytics(twice, reviews(spark)).where("business_id = 'a'")
    assert [r.actual_review_count for r in out.collect()] == [2, 2]


def test_user_analytics(spark):
    users = spark.createDataFrame(
        [("u", "U", 1, None, 4.0, 1, 7, 7, 7), ("w", "W", 1, None, 4.0, 1, 7, 7, 7)],
        "user_id string, user_name string, review_count int, yelping_since date, "
        "average_stars double, fans int, useful int, funny int, cool int",
    )
    out = gold.user_analytics(users, reviews(spark))
    assert out.columns == gold.USER_COLUMNS + ["processing_timestamp", "data_layer"]
    found = {r.user_id: r for r in out.collect()}
    u, w = found["u"], found["w"]
    assert (u.useful, u.useful_votes_given, u.avg_given_stars, u.avg_review_length) == (
        7,
        3,
        4.5,
        10.0,
    )
    assert (w.actual_review_count, w.avg_review_length) == (None, None)


def test_city_summary(spark):
    analytics = gold.business_analytics(businesses(spark), reviews(spark))
    out = gold.city_summary(analytics).drop("processing_timestamp", "data_layer")
    assert rows(out) == [
        ("P", "AZ", 1, 1, 4.0, 2, 1, 0),
        ("Q", "NV", 1, 1, 3.0, None, 0, 0),
        (None, "AZ", 2, 2, 2.0, 1, 0, 2),
    ]


# --- views and rules ----------------------------------------------------------


def delivered(spark):
    analytics = gold.business_analytics(businesses(spark), reviews(spark))
    return {"business_analytics": analytics, "city_summary": gold.city_summary(analytics)}


def test_states_in_descending_order_nulls_first(spark):
    cities = spark.createDataFrame(
        [("a", "X", 1, 2.0), ("b", "X", 4, 3.0), ("c", "Y", 9, 1.0), ("d", "Z", None, None)],
        "city string, state string, total_businesses bigint, city_avg_stars double",
    )
    out = [tuple(r) for r in views.city_business_distribution(cities).collect()]
    assert out == [
        ("Z", 1, None, None, None, None),
        ("Y", 1, 9, 1.0, 9, 9),
        ("X", 2, 5, 2.5, 4, 1),
    ]


def test_views_are_registered_and_replaced(spark):
    for _ in range(2):
        made = views.register(spark, delivered(spark))
    assert made == [
        "business_analytics",
        "city_summary",
        "business_quality_summary",
        "city_business_distribution",
    ]
    row = spark.sql("SELECT * FROM business_quality_summary").first()
    assert (row.total_businesses, row.missing_cities, row.missing_ratings) == (4, 2, 1)
    assert (row.overall_avg_rating, row.open_businesses, row.closed_businesses) == (3.0, 1, 2)


def test_rules_fail_without_stopping(spark):
    checks = rules.check_thresholds(
        spark,
        delivered(spark),
        (
            rules.Threshold("enough", "business_analytics", at_least=4),
            rules.Threshold("few", "business_analytics", "city IS NULL", at_most=1),
            rules.Threshold("no table", "users", at_least=0),
            rules.Threshold("no column", "city_summary", "mayor = 1", at_most=5),
        ),
    )
    found = {r.check_name: (r.actual, r.passed) for r in checks.collect()}
    assert found == {
        "enough": (4, True),
        "few": (2, False),
        "no table": (None, False),
        "no column": (None, False),
    }
    score = rules.score(checks).first()
    assert (score.passed_checks, score.total_checks, score.score, score.ok) == (
        1,
        4,
        Decimal("25.0"),
        False,
    )


def test_one_rule_that_fails_as_it_runs_fails_alone(spark):
    rows = spark.createDataFrame([("abc",), ("7",)], "b string")
    checks = rules.check_thresholds(
        spark,
        {"t": rows},
        (
            rules.Threshold("bad", "t", "CAST(b AS INT) > 5", at_most=9),
            rules.Threshold("good", "t", at_least=2),
        ),
    )
    found = {r.check_name: (r.actual, r.passed) for r in checks.collect()}
    assert found == {"bad": (None, False), "good": (2, True)}
    rows.createOrReplaceTempView("rows_of_text")
    out = rules.run_catalog(
        spark,
        (
            ("bad", "t", "SELECT count_if(CAST(b AS INT) > 5) FROM rows_of_text", "0"),
            ("two rows", "t", "SELECT 1 FROM rows_of_text", "1"),
            ("good", "t", "SELECT count(*) FROM rows_of_text", "2"),
        ),
    )
    assert [r.status for r in out.collect()] == ["error", "error", "passed"]
    assert rules.check_thresholds(spark, {}, ()).count() == 0
    assert rules.run_catalog(spark, ()).count() == 0
    assert rules.row_counts({}).count() == 0


def test_exact_mean_of_large_values(spark):
    rows = spark.createDataFrame([(2e10,), (4e10,)], "x double")
    assert rows.agg(exact_mean("x")).first()[0] == 3e10


def test_score_over_nothing_is_null(spark):
    none = spark.createDataFrame([], "passed boolean")
    row = rules.score(none).first()
    assert (row.total_checks, row.score, row.ok) == (0, None, None)


def test_catalog(spark):
    views.register(spark, delivered(spark))
    query = "SELECT COUNT(*) FROM business_analytics WHERE city IS NULL"
    out = rules.run_catalog(
        spark,
        (
            ("none", "business_analytics", query, "0"),
            ("some", "business_analytics", query, ">0"),
            ("two", "business_analytics", query, "2"),
            ("broken", "nowhere", "SELECT COUNT(*) FROM nowhere", "0"),
            ("unreadable", "business_analytics", query, "about 2"),
        ),
    )
    found = {r.check_name: (r.actual_result, r.status) for r in out.collect()}
    assert found == {
        "none": ("2", "failed"),
        "some": ("2", "passed"),
        "two": ("2", "passed"),
        "broken": (None, "error"),
        "unreadable": (None, "error"),
    }
