"""Quality views over the delivered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.functions.measures import count_where, exact_mean, is_missing


def business_quality_summary(business_analytics: DataFrame) -> DataFrame:
    return business_analytics.agg(
        F.count(F.lit(1)).alias("total_businesses"),
        count_where(is_missing("business_name")).alias("missing_names"),
        count_where(is_missing("city")).alias("missing_cities"),
        count_where(F.col("avg_stars").isNull()).alias("missing_ratings"),
        exact_mean("avg_stars").alias("overall_avg_rating"),
        count_where(F.col("is_open")).alias("open_businesses"),
        count_where(~F.col("is_open")).alias("closed_businesses"),
    )


def user_quality_summary(user_analytics: DataFrame) -> DataFrame:
    return user_analytics.agg(
        F.count(F.lit(1)).alias("total_users"),
        count_where(is_missing("user_name")).alias("missing_names"),
        count_where(F.col("yelping_since").isNull()).alias("missing_join_dates"),
        F.avg("review_count").alias("avg_reviews_per_user"),
        F.avg("fans").alias("avg_fans_per_user"),
        count_where(F.col("review_count") > 0).alias("active_users"),
    )


def city_business_distribution(city_summary: DataFrame) -> DataFrame:
    """Per state; the rating is the plain mean of its cities' means."""
    per_state = city_summary.groupBy("state").agg(
        F.countDistinct("city").alias("cities_count"),
        F.sum("total_businesses").alias("state_total_businesses"),
        exact_mean("city_avg_stars").alias("state_avg_rating"),
        F.max("total_businesses").alias("max_businesses_in_city"),
        F.min("total_businesses").alias("min_businesses_in_city"),
    )
    return per_state.orderBy(F.desc_nulls_first("state_total_businesses"))


VIEWS = {
    "business_quality_summary": (business_quality_summary, "business_analytics"),
    "user_quality_summary": (user_quality_summary, "user_analytics"),
    "city_business_distribution": (city_business_distribution, "city_summary"),
}


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Create or replace a view per table given, and every quality view over them."""
    made = []
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
        made.append(name)
    for name, (view, source) in VIEWS.items():
        if source in tables:
            view(tables[source]).createOrReplaceTempView(name)
            made.append(name)
    return made
