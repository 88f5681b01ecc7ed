"""Declared shapes: what raw files hold and what warehouse tables accept."""

from __future__ import annotations

import re
from dataclasses import dataclass

# Field names and types of the five raw datasets.
RAW_SCHEMAS = {
    "business": """
        business_id string, name string, address string, city string, state string,
        postal_code string, latitude double, longitude double, stars double,
        review_count int, is_open int, attributes map<string,string>,
        categories string, hours map<string,string>
    """,
    "review": """
        review_id string, user_id string, business_id string, stars double,
        useful int, funny int, cool int, text string, date string
    """,
    "user": """
        user_id string, name string, review_count int, yelping_since string,
        useful int, funny int, cool int, elite string, friends string, fans int,
        average_stars double, compliment_hot int, compliment_more int,
        compliment_profile int, compliment_cute int, compliment_list int,
        compliment_note int, compliment_plain int, compliment_cool int,
        compliment_funny int, compliment_writer int, compliment_photos int
    """,
    "checkin": "business_id string, date string",
    "tip": """
        user_id string, business_id string, text string, date string,
        compliment_count int
    """,
}

DATASETS = tuple(RAW_SCHEMAS)


def raw_files(root: str, prefix: str = "") -> dict[str, str]:
    """Dataset -> path, for a folder of files called ``<prefix><dataset>.json``."""
    return {name: f"{root.rstrip('/')}/{prefix}{name}.json" for name in DATASETS}


@dataclass(frozen=True)
class ColumnRule:
    """One warehouse column: its Spark type and, for bounded text, its length."""

    name: str
    type: str
    max_len: int | None = None


@dataclass(frozen=True)
class TableContract:
    """A warehouse table: columns in order, and the columns that identify a row.

    A ``key`` may not be null.  A ``unique`` set may: rows with a null in it
    never clash, as in SQL.  ``stamps`` are load-time columns beside the contract,
    ``batch_rows`` the rows of one insert when the table goes to a database.
    """

    name: str
    columns: tuple[ColumnRule, ...]
    key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    stamps: tuple[str, ...] = ("created_at", "updated_at")
    batch_rows: int = 5000

    @property
    def identity(self) -> tuple[str, ...]:
        return self.key or self.unique

    @property
    def database_types(self) -> str:
        """Lengths and precisions of the columns, for a database that creates the table."""
        shown = {"string": "text", "bigint": "bigint", "timestamp_ntz": "timestamp"}
        return ", ".join(
            f"{c.name} varchar({c.max_len})" if c.max_len else f"{c.name} {c.type}"
            for c in self.columns
            if c.max_len or c.type not in shown
        )

    @property
    def key_statement(self) -> str:
        """DDL that a caller may run once the table is there."""
        kind = "PRIMARY KEY" if self.key else "UNIQUE"
        return f"ALTER TABLE {self.name} ADD {kind} ({', '.join(self.identity)})"

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


def table(name: str, columns: str, **options) -> TableContract:
    """Build a contract from ``"name type"`` lines; ``varchar(n)`` is bounded text."""
    rules = []
    for line in columns.strip().splitlines():
        column, type_name = line.split()
        bounded = re.fullmatch(r"varchar\((\d+)\)", type_name)
        if bounded:
            rules.append(ColumnRule(column, "string", int(bounded.group(1))))
        else:
            rules.append(ColumnRule(column, type_name))
    return TableContract(name, tuple(rules), **options)


# Warehouse columns, lengths, precisions and batch sizes.  Counts and sums are
# bigint, as Spark computes them.
WAREHOUSE = {
    c.name: c
    for c in (
        table(
            "business_analytics",
            """
            business_id varchar(50)
            business_name varchar(500)
            city varchar(100)
            state varchar(10)
            avg_stars decimal(3,2)
            review_count int
            actual_review_count bigint
            avg_review_stars decimal(3,2)
            total_useful_votes bigint
            total_funny_votes bigint
            total_cool_votes bigint
            is_open boolean
            categories string
            processing_timestamp timestamp_ntz
            data_layer varchar(20)
            """,
            key=("business_id",),
        ),
        table(
            "user_analytics",
            """
            user_id varchar(50)
            user_name varchar(200)
            review_count int
            actual_review_count bigint
            yelping_since date
            average_stars decimal(3,2)
            avg_given_stars decimal(3,2)
            fans int
            useful int
            funny int
            cool int
            useful_votes_given bigint
            funny_votes_given bigint
            cool_votes_given bigint
            avg_review_length decimal(10,2)
            processing_timestamp timestamp_ntz
            data_layer varchar(20)
            """,
            key=("user_id",),
        ),
        table(
            "city_summary",
            """
            city varchar(100)
            state varchar(10)
            total_businesses bigint
            unique_businesses bigint
            city_avg_stars decimal(3,2)
            total_reviews bigint
            open_businesses bigint
            closed_businesses bigint
            processing_timestamp timestamp_ntz
            data_layer varchar(20)
            """,
            unique=("city", "state"),
        ),
        table(
            "business_details",
            """
            business_id varchar(50)
            business_name varchar(500)
            address varchar(500)
            city varchar(100)
            state varchar(10)
            postal_code varchar(20)
            latitude decimal(10,8)
            longitude decimal(11,8)
            avg_stars decimal(3,2)
            review_count int
            is_open boolean
            categories string
            processing_timestamp timestamp_ntz
            data_layer varchar(20)
            """,
            key=("business_id",),
        ),
        table(
            "reviews",
            """
            review_id varchar(50)
            user_id varchar(50)
            business_id varchar(50)
            stars decimal(2,1)
            useful int
            funny int
            cool int
            review_text string
            review_date date
            text_length int
            processing_timestamp timestamp_ntz
            data_layer varchar(20)
            """,
            key=("review_id",),
            stamps=("created_at",),
            batch_rows=1000,
        ),
    )
}

# Shapes of the three bookkeeping tables.
PIPELINE_METRICS = """
    pipeline_run_id string, table_name string, records_processed bigint,
    processing_time_seconds decimal(10,2), status string, error_message string,
    processing_timestamp timestamp, rows_in bigint, rows_quarantined bigint,
    rows_duplicate bigint, values_unparsable bigint
"""
EXECUTION_LOG = """
    pipeline_name string, stage string, start_time timestamp, end_time timestamp,
    duration_seconds int, records_processed bigint, status string,
    error_message string
"""
QUALITY_CHECKS = """
    check_name string, table_name string, check_query string,
    expected_result string, actual_result string, status string,
    execution_time timestamp
"""
