"""The five cleaned datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.functions.dates import parse_date, parse_date_of_timestamp, parse_timestamp
from tristrata.operators.cleaning import CleanSpec, Pick, clean


def _flag(value):
    """1 is true; 0, any other number and no value are false."""
    return F.when(value == 1, True).otherwise(False)


def _unpack(value):
    """One row per entry of a list packed into text; no list, no rows."""
    return F.explode(F.split(value, ", "))


BUSINESS = CleanSpec(
    "business",
    picks=(
        Pick("business_id"),
        Pick("business_name", source="name"),
        Pick("address"),
        Pick("city"),
        Pick("state"),
        Pick("postal_code"),
        Pick("latitude", type="double"),
        Pick("longitude", type="double"),
        Pick("avg_stars", source="stars", type="double"),
        Pick("review_count", type="int"),
        Pick("is_open", via=_flag),
        Pick("categories"),
        Pick("ingestion_timestamp"),
    ),
    required=("business_id", "business_name"),
)

REVIEW = CleanSpec(
    "review",
    picks=(
        Pick("review_id"),
        Pick("user_id"),
        Pick("business_id"),
        Pick("stars", type="double"),
        Pick("useful", type="int"),
        Pick("funny", type="int"),
        Pick("cool", type="int"),
        Pick("review_text", source="text"),
        Pick("review_date", source="date", via=parse_date_of_timestamp),
        Pick("ingestion_timestamp"),
    ),
    required=("review_id", "user_id", "business_id", "stars"),
    derived={"text_length": lambda: F.length("review_text")},
)

USER = CleanSpec(
    "user",
    picks=(
        Pick("user_id"),
        Pick("user_name", source="name"),
        Pick("review_count", type="int"),
        Pick("yelping_since", via=parse_date),
        Pick("useful", type="int"),
        Pick("funny", type="int"),
        Pick("cool", type="int"),
        Pick("fans", type="int"),
        Pick("average_stars", type="double"),
        Pick("ingestion_timestamp"),
    ),
    required=("user_id",),
)

CHECKIN = CleanSpec(
    "checkin",
    picks=(
        Pick("business_id"),
        Pick("checkin_date", source="date", via=_unpack),
        Pick("ingestion_timestamp"),
    ),
    required=("business_id",),
    derived={"checkin_datetime": lambda: parse_timestamp("checkin_date")},
)

TIP = CleanSpec(
    "tip",
    picks=(
        Pick("user_id"),
        Pick("business_id"),
        Pick("tip_text", source="text"),
        Pick("tip_date", source="date", via=parse_date_of_timestamp),
        Pick("compliment_count", type="int"),
        Pick("ingestion_timestamp"),
    ),
    required=("user_id", "business_id"),
    derived={"text_length": lambda: F.length("tip_text")},
)

SPECS = {s.dataset: s for s in (BUSINESS, REVIEW, USER, CHECKIN, TIP)}


def silver(dataset: str, bronze: DataFrame) -> DataFrame:
    return clean(bronze, SPECS[dataset])
