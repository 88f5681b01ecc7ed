"""What the plans must look like for the work to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tristrata.operators.dedupe import keep_first
from tristrata.operators.joining import join_summary, unique_rows
from tristrata.operators.sampling import capped_sample

SF_DIR = "/root/testdata/sf0.001"

SMALL_PIECES = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_pieces(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_PIECES}
    for k, v in SMALL_PIECES.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark):
    """A third of the rows share one key, spread over many map tasks."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    return spark.range(0, 60_000, 1, 16).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


def summary(spark):
    return hot_rows(spark).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_hot_key_is_split_over_tasks(spark, small_pieces, how):
    rows, per_key = hot_rows(spark), summary(spark)
    if how == "left_anti":
        per_key = per_key.where("k <> 'hot'").select("k")
    joined = join_summary(rows, per_key, ["k"], how)
    found = joined.collect()
    final = plan(joined)
    assert "SortMergeJoin(skew=true)" in final, final
    assert len(found) == (60_000 if how == "left" else 20_000)
    if how == "left":
        assert {r.n for r in found if r.k == "hot"} == {20_000}


def test_repeated_keys_are_split_and_limited_before_ranking(spark, small_pieces):
    repeated = summary(spark).where("n > 1").select("k")
    unique = unique_rows(hot_rows(spark), repeated, ["k"], ["v"])
    assert len(unique.collect()) == 40_001
    final = plan(unique)
    assert final.count("SortMergeJoin(skew=true)") >= 2, final
    assert re.search(r"WindowGroupLimit .*Partial", final), final


def test_small_summary_is_broadcast_by_its_measured_size(spark):
    few = hot_rows(spark).where("k = 'hot'").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = join_summary(hot_rows(spark), few, ["k"])
    joined.collect()
    assert "BroadcastHashJoin" in plan(joined).split("Initial Plan")[0]


def test_first_per_key_is_limited_before_the_shuffle(spark):
    text = plan(keep_first(hot_rows(spark), ["k"], ["v"], nulls=False))
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffle:] and "Partial" in text[shuffle:]


def test_sample_ranks_only_rows_under_the_cut(spark):
    df = hot_rows(spark)
    text = plan(capped_sample(df, 100, ["v"]))
    assert "TakeOrderedAndProject" in text
    # One comparison of digests with the prefix that the histogram found.
    assert re.search(r"Filter .*substring\(.*md5.*<= [0-9a-f]{3}", text), text
    assert "Subquery" not in text


@pytest.mark.parametrize(
    "name", sorted(k for k in entry.queries() if not re.match(r"op\d+_|pipeline$", k))
)
def test_queries_stay_in_the_jvm_and_avoid_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize("name", ["gold_business_analytics", "gold_user_analytics"])
def test_gold_reads_only_what_it_needs_and_adds_up_map_side(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "partial_count" in text and "partial_avg" in text
    schemas = re.findall(r"ReadSchema: struct<([^>\n]*)", text)
    assert len(schemas) == 2
    assert not any("l_shipdate" in s or "l_extendedprice" in s for s in schemas)


def test_city_summary_counts_distinct_in_two_steps(spark):
    text = plan(entry.queries()["gold_city_summary"](spark, SF_DIR))
    # the hot city is spread by business before it is counted
    assert re.search(r"Exchange hashpartitioning\(city#\d+, state#\d+, business_id#\d+", text)


@pytest.mark.parametrize("name", ["silver_business", "silver_review", "silver_user", "silver_tip", "silver_checkin"])
def test_cleaning_does_not_shuffle(spark, name):
    assert "Exchange" not in plan(entry.queries()[name](spark, SF_DIR))
