"""Summaries per business, per user and per city.

Reviews are the large side.  They are summarised before any join, map-side first,
so neither a popular business nor a prolific user ends up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.functions.measures import count_where, total
from tristrata.operators.joining import join_summary
from tristrata.operators.stamps import stamp_processed


def business_measures() -> dict[str, Column]:
    return {
        "actual_review_count": F.count("review_id"),
        "avg_review_stars": F.avg("stars"),
        "total_useful_votes": total("useful"),
        "total_funny_votes": total("funny"),
        "total_cool_votes": total("cool"),
    }


def user_measures() -> dict[str, Column]:
    return {
        "actual_review_count": F.count("review_id"),
        "avg_given_stars": F.avg("stars"),
        "useful_votes_given": total("useful"),
        "funny_votes_given": total("funny"),
        "cool_votes_given": total("cool"),
        "avg_review_length": F.avg("text_length"),
    }


def city_measures() -> dict[str, Column]:
    return {
        "total_businesses": F.count("business_id"),
        "unique_businesses": F.countDistinct("business_id"),
        "city_avg_stars": F.avg("avg_stars"),
        "total_reviews": F.sum("actual_review_count"),
        "open_businesses": count_where(F.col("is_open")),
        "closed_businesses": count_where(~F.col("is_open")),
    }


# Column order of the two joined tables.
BUSINESS_COLUMNS = """
    business_id business_name city state avg_stars review_count
    actual_review_count avg_review_stars total_useful_votes total_funny_votes
    total_cool_votes is_open categories
""".split()
USER_COLUMNS = """
    user_id user_name review_count actual_review_count yelping_since
    average_stars avg_given_stars fans useful funny cool useful_votes_given
    funny_votes_given cool_votes_given avg_review_length
""".split()


def summarize(df: DataFrame, key: list[str], measures: dict[str, Column]) -> DataFrame:
    return df.groupBy(*key).agg(*(m.alias(name) for name, m in measures.items()))


def business_analytics(business: DataFrame, review: DataFrame) -> DataFrame:
    """Every business, with what its reviews add up to (null without reviews)."""
    stats = summarize(review, ["business_id"], business_measures())
    joined = join_summary(business, stats, ["business_id"])
    return stamp_processed(joined.select(*BUSINESS_COLUMNS), "gold")


def user_analytics(user: DataFrame, review: DataFrame) -> DataFrame:
    """Every user, with what their reviews add up to (null without reviews)."""
    stats = summarize(review, ["user_id"], user_measures())
    # Both sides count votes; the user's own columns keep their names.
    joined = join_summary(user, stats, ["user_id"])
    return stamp_processed(joined.select(*USER_COLUMNS), "gold")


def city_summary(analytics: DataFrame) -> DataFrame:
    """Per city and state, from business analytics; no city is a city of its own."""
    per_city = summarize(analytics, ["city", "state"], city_measures())
    return stamp_processed(per_city, "gold")
