"""Checks on delivered tables: row counts, thresholds, and rules kept as data."""

from __future__ import annotations

import contextlib
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.functions.measures import count_where, share


@dataclass(frozen=True)
class Threshold:
    """Rows of ``table`` where ``where`` holds (all, without it) against a bound."""

    name: str
    table: str
    where: str | None = None
    at_least: int | None = None
    at_most: int | None = None

    def actual(self) -> Column:
        return F.count_if(F.expr(self.where)) if self.where else F.count(F.lit(1))

    @property
    def bound(self) -> tuple[str, int]:
        return (">=", self.at_least) if self.at_least is not None else ("<=", self.at_most)


# The six standard checks.
THRESHOLDS = (
    Threshold("Business records count", "business_analytics", at_least=1000),
    Threshold("User records count", "user_analytics", at_least=1000),
    Threshold("City records count", "city_summary", at_least=10),
    Threshold("Reviews sample count", "reviews", at_least=1000),
    Threshold("Business null check", "business_analytics", "business_id IS NULL", at_most=0),
    Threshold(
        "Rating range check", "business_analytics", "avg_stars < 1 OR avg_stars > 5", at_most=0
    ),
)

# Share of checks, and of non-empty tables, that must pass.
SCORE_GATE = 80
COUNT_GATE = 20

# Rules kept as data (name, table, query, expected result).
CATALOG = (
    (
        "business_not_null_check",
        "business_analytics",
        "SELECT COUNT(*) FROM business_analytics WHERE business_id IS NULL",
        "0",
    ),
    (
        "user_not_null_check",
        "user_analytics",
        "SELECT COUNT(*) FROM user_analytics WHERE user_id IS NULL",
        "0",
    ),
    (
        "city_summary_check",
        "city_summary",
        "SELECT COUNT(*) FROM city_summary WHERE total_businesses > 0",
        ">0",
    ),
    (
        "business_stars_range",
        "business_analytics",
        "SELECT COUNT(*) FROM business_analytics WHERE avg_stars < 1 OR avg_stars > 5",
        "0",
    ),
)

CATALOG_COLUMNS = """
    check_name string, table_name string, check_query string, expected_result string
"""
_CHECK_COLUMNS = """
    check_name string, table_name string, actual bigint, op string, expected bigint,
    passed boolean
"""
_RESULT_COLUMNS = """
    check_name string, table_name string, check_query string, expected_result string,
    actual_result string, status string
"""


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, n, passed)``: a table passes if it has rows."""
    if not tables:
        names = "table_name string, n bigint, passed boolean"
        return SparkSession.active().createDataFrame([], names)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), "n", (F.col("n") > 0).alias("passed")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def check_thresholds(
    spark: SparkSession, tables: dict[str, DataFrame], rules=THRESHOLDS
) -> DataFrame:
    """One row per rule.  All rules on a table share one scan of it.

    A rule whose table is not there, whose condition does not fit the table, or
    that fails on the table's values is a failed rule, not a failed run.  The checks
    run here: one row of counts per table comes back.  If that fails, the table's rules
    are evaluated one by one.
    """
    rows = []
    for name in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == name]
        sound = [r for r in mine if name in tables and _fits(tables[name], r)]
        try:
            actual = _measured(tables[name], sound) if sound else {}
        except PySparkException:
            actual = {}
            for rule in sound:
                with contextlib.suppress(PySparkException):
                    actual |= _measured(tables[name], [rule])
        for rule in mine:
            op, limit = rule.bound
            n = actual.get(rule.name)
            passed = n is not None and (n >= limit if op == ">=" else n <= limit)
            rows.append((rule.name, rule.table, n, op, limit, passed))
    return spark.createDataFrame(rows, _CHECK_COLUMNS)


def score(checks: DataFrame, gate: float = SCORE_GATE) -> DataFrame:
    """Passed, total, the share passed in percent, and whether it reaches the gate."""
    passed, total = count_where(F.col("passed")), F.count(F.lit(1))
    percent = share(passed, total)
    return checks.agg(
        passed.alias("passed_checks"),
        total.alias("total_checks"),
        percent.cast("decimal(5,1)").alias("score"),
        (percent >= gate).alias("ok"),
    )


def catalog_rows(spark: SparkSession, rules=CATALOG) -> DataFrame:
    return spark.createDataFrame(list(rules), CATALOG_COLUMNS)


def run_catalog(spark: SparkSession, rules=CATALOG) -> DataFrame:
    """Evaluate stored rules on the registered views, as rows of the check table.

    ``rules`` are query texts, each giving one number.  A query that Spark cannot
    analyse, that fails as it runs, or that gives anything else than one number has
    status ``error``.  The queries run here, one by one.
    """
    rows = [_evaluated(spark, *rule) for rule in rules]
    found = spark.createDataFrame(rows, _RESULT_COLUMNS)
    return found.withColumn("execution_time", F.current_timestamp())


def _fits(df: DataFrame, rule: Threshold) -> bool:
    if rule.where is None:
        return True
    try:
        df.agg(rule.actual().alias("actual")).schema
    except PySparkException:
        return False
    return True


def _measured(df: DataFrame, rules: list[Threshold]) -> dict[str, int]:
    row = df.agg(*(r.actual().alias(f"r{i}") for i, r in enumerate(rules))).first()
    return {rule.name: row[i] for i, rule in enumerate(rules)}


def _evaluated(
    spark: SparkSession, name: str, table: str, query: str, expected: str
) -> tuple[str, str, str, str, str | None, str]:
    wanted = re.fullmatch(r"(>?)(\d+)", expected)
    try:
        if not wanted:
            raise ValueError(f"cannot read expected result {expected!r}")
        found = spark.sql(query).limit(2).collect()
        if len(found) != 1 or len(found[0]) != 1 or found[0][0] is None:
            raise ValueError("not one number")
        actual, limit = int(found[0][0]), int(wanted.group(2))
        holds = actual > limit if wanted.group(1) else actual == limit
        result, status = str(actual), "passed" if holds else "failed"
    except (PySparkException, ValueError):
        result, status = None, "error"
    return name, table, query, expected, result, status
