"""The given tables, shaped like the raw datasets.

business = orders, review = lineitem, user = customer, check-in = events,
tip = conversations.  Every row of each table takes part.  Because the tables hold
no nulls and no bad text, some values are turned into them by rule, so that the
cleaning has something to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLOCK = ["ingestion_timestamp", "processing_timestamp"]


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def stamp_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, fractions of a second cut off."""
    return F.substring(moment.cast("string"), 1, 19)


def day_text(moment: Column) -> Column:
    return F.substring(moment.cast("string"), 1, 10)


def loose(text: Column) -> Column:
    """Without the leading zero of each field."""
    for separator in "- :":
        text = F.replace(text, F.lit(separator + "0"), F.lit(separator))
    return text


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice")
    unnamed = (priority == "5-LOW") & (status == "P")
    blank = (priority == "1-URGENT") & (status == "O")
    named = F.when(blank, "").otherwise(F.concat(F.lit("Order "), _text("o_orderkey")))
    return given(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("business_id"),
        F.when(~unnamed, named).alias("name"),
        F.concat(F.lit("Customer "), _text("o_custkey")).alias("address"),
        F.nullif(F.substring(_text("o_orderdate"), 1, 7), F.lit("1996-03")).alias("city"),
        status.alias("state"),
        F.substring(priority, 1, 1).alias("postal_code"),
        (price / 10000).alias("latitude"),
        (price / -5000).alias("longitude"),
        (F.floor(price / 100000) + 1).cast("double").alias("stars"),
        F.when(priority == "2-HIGH", "n/a")
        .otherwise(F.floor(price / 1000).cast("string"))
        .alias("review_count"),
        F.when(status == "O", 1).when(status == "F", 0).alias("is_open"),
        priority.alias("categories"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, shipped = F.col("l_returnflag"), F.col("l_shipdate")
    key = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    date = (
        F.when(flag == "A", stamp_text(shipped))
        .when(flag == "R", F.concat(loose(stamp_text(shipped)), F.lit(" UTC")))
        .otherwise(day_text(shipped))
    )
    return given(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", *(_text(k) for k in key)).alias("review_id"),
        _text("l_suppkey").alias("user_id"),
        _text("l_orderkey").alias("business_id"),
        F.when(F.col("l_tax") < 0.08, F.floor((F.col("l_quantity") - 1) / 10) + 1)
        .cast("double")
        .alias("stars"),
        F.col("l_linenumber").alias("useful"),
        F.col("l_quantity").alias("funny"),
        F.when(flag != "N", F.col("l_suppkey")).alias("cool"),
        F.when(
            F.col("l_linestatus") == "F",
            F.concat(flag, F.lit(" héé😀 "), _text("l_suppkey")),
        ).alias("text"),
        date.alias("date"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def user(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    joined = F.date_add(F.lit("2005-01-01").cast("date"), nation)
    since = (
        F.when(segment == "AUTOMOBILE", joined.cast("string"))
        .when(segment == "BUILDING", F.concat(joined.cast("string"), F.lit(" 03:04:05")))
        .when(segment == "MACHINERY", loose(joined.cast("string")))
        .when(segment == "FURNITURE", "bad")
    )
    return given(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") >= -900, _text("c_custkey")).alias("user_id"),
        F.when(segment == "HOUSEHOLD", "").otherwise(F.col("c_name")).alias("name"),
        nation.alias("review_count"),
        since.alias("yelping_since"),
        (nation + 1).alias("useful"),
        (nation + 2).alias("funny"),
        (nation + 3).alias("cool"),
        (nation * 2).alias("fans"),
        (F.floor((F.col("c_acctbal") + 1000) / 2500) + 1).cast("double").alias("average_stars"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def checkin(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts")
    later = ts + F.expr("INTERVAL 90 MINUTES")
    bad = F.when(kind == "error", "bad")
    packed = F.concat_ws(", ", stamp_text(ts), stamp_text(later), bad)
    return given(spark, sf_dir, "events").select(
        F.when(F.col("value") >= 10, _text("user_id")).alias("business_id"),
        F.when(kind == "purchase", "").when(kind != "signup", packed).alias("date"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )


def tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn")
    date = F.concat(F.lit("2024-1-"), (turn + 1).cast("string"), F.lit(" 0:0:0"))
    return given(spark, sf_dir, "conversations").select(
        F.nullif("role", F.lit("system")).alias("user_id"),
        _text("conv_id").alias("business_id"),
        F.when(turn != 3, F.col("text")).alias("text"),
        F.when(turn != 5, date).otherwise("2024-01-06").alias("date"),
        turn.alias("compliment_count"),
        F.current_timestamp().alias("ingestion_timestamp"),
    )
