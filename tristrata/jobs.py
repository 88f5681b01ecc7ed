"""The three layer jobs: tables in, tables out.

Each returns one :class:`Outcome` per table.  A table that fails does not stop the
others; its outcome carries the reason.  Order, retries and schedules belong to
the caller.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tristrata.contracts import (
    DATASETS,
    EXECUTION_LOG,
    PIPELINE_METRICS,
    QUALITY_CHECKS,
    RAW_SCHEMAS,
    WAREHOUSE,
    TableContract,
)
from tristrata.functions.measures import share
from tristrata.operators import conform
from tristrata.operators.columns import normalize_names, unloadable
from tristrata.operators.dedupe import duplicate_keys
from tristrata.operators.joining import absent, unique_rows
from tristrata.operators.sampling import capped_sample
from tristrata.operators.schema_diff import against
from tristrata.operators.stamps import INGESTED, stamp_ingested, stamp_loaded
from tristrata.plans import gold as gold_plans
from tristrata.plans import rules, views
from tristrata.plans.silver import silver
from tristrata.sinks.jdbc import jdbc_options, load_jdbc
from tristrata.sinks.tables import Split, append, append_rows, overwrite, read_table
from tristrata.sinks.versions import TableLog
from tristrata.sources.multiline import read_multiline
from tristrata.sources.ndjson import MALFORMED, REJECT, read_raw, with_rejects

log = logging.getLogger(__name__)

SUCCESS, FAILED = "SUCCESS", "FAILED"
KEPT = "no rows: the table written before stays"

# The order of the loads.
LOAD_ORDER = (
    "business_analytics",
    "business_details",
    "user_analytics",
    "city_summary",
    "reviews",
)


@dataclass
class Outcome:
    """What became of one table in one job."""

    stage: str
    table: str
    status: str
    rows: int = 0
    error: str | None = None
    started: dt.datetime | None = None
    ended: dt.datetime | None = None
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def seconds(self) -> float:
        return (self.ended - self.started).total_seconds()


def all_succeeded(outcomes: list[Outcome]) -> bool:
    return all(o.status == SUCCESS for o in outcomes)


def _attempt(
    stage: str, table: str, work: Callable[[], dict], rows_wanted: bool = False
) -> Outcome:
    started = dt.datetime.now(dt.timezone.utc)
    try:
        counts = work()
        status, error = SUCCESS, None
        if rows_wanted and not counts["rows"]:
            status, error = FAILED, "no rows loaded"
    except Exception as e:  # recorded with its text; the other tables go on
        counts, status, error = {}, FAILED, f"{type(e).__name__}: {e}"
    ended = dt.datetime.now(dt.timezone.utc)
    return Outcome(stage, table, status, counts.get("rows", 0), error, started, ended, counts)


# --- bronze -----------------------------------------------------------------


def build_bronze(
    spark: SparkSession,
    sources: dict[str, str],
    bronze: str,
    rejects: str,
    multi_line: bool = False,
    source_names: dict[str, str] | None = None,
) -> list[Outcome]:
    """Raw JSON to parquet with provenance; lines that did not fit go to ``rejects``.

    ``sources`` maps dataset to path.  ``source_file`` is the file each row was
    read from, unless ``source_names`` gives a name for the dataset.  With ``multi_line``
    files hold arrays or records on several lines (still read by many tasks).  A missing
    path stops the job before anything is written.
    """
    opened: dict[str, DataFrame] = {}

    def open_source(dataset: str) -> dict:
        if multi_line:
            opened[dataset] = read_multiline(spark, sources[dataset], RAW_SCHEMAS[dataset])
        else:
            opened[dataset] = read_raw(spark, sources[dataset], dataset)
        return {}

    checks = [_attempt("bronze", d, lambda d=d: open_source(d)) for d in sources]
    if not all_succeeded(checks):
        for check in checks:
            check.status = FAILED
            check.error = check.error or "not started: another source is missing"
        return checks

    def ingest(dataset: str) -> dict:
        """The file is parsed once: rows and malformed lines are written together."""
        raw, path = opened[dataset], f"{bronze}/{dataset}"
        fields = [c for c in raw.columns if c not in (MALFORMED, *INGESTED)]
        stamped = stamp_ingested(raw, (source_names or {}).get(dataset))
        found = {"malformed": F.count_if(F.col(REJECT))}
        with Split(with_rejects(stamped, fields), path, REJECT, found) as split:
            overwrite(split.rows(True).select("line", "kept"), f"{rejects}/{dataset}")
            if not split.publish(False, [*fields, *INGESTED]):
                raise RuntimeError(KEPT)
        return split.counts

    return [_attempt("bronze", d, lambda d=d: ingest(d)) for d in sources]


# --- silver and gold --------------------------------------------------------


def build_silver(
    spark: SparkSession, bronze: str, silver_root: str, datasets=DATASETS
) -> list[Outcome]:
    def refine(dataset: str) -> dict:
        cleaned = silver(dataset, read_table(spark, f"{bronze}/{dataset}"))
        return _refreshed(cleaned, f"{silver_root}/{dataset}")

    return [_attempt("silver", d, lambda d=d: refine(d)) for d in datasets]


def build_gold(spark: SparkSession, silver_root: str, gold: str) -> list[Outcome]:
    """Business and user analytics, then the city summary from the written business
    table, so that the review join is not computed a second time."""

    def read(layer: str, name: str) -> DataFrame:
        return read_table(spark, f"{layer}/{name}")

    plans = {
        "business_analytics": lambda: gold_plans.business_analytics(
            read(silver_root, "business"), read(silver_root, "review")
        ),
        "user_analytics": lambda: gold_plans.user_analytics(
            read(silver_root, "user"), read(silver_root, "review")
        ),
        "city_summary": lambda: gold_plans.city_summary(read(gold, "business_analytics")),
    }
    outcomes = []
    for name, plan in plans.items():
        stale = name == "city_summary" and not all_succeeded(outcomes[:1])
        if stale:
            plan = _raising("business_analytics was not rebuilt")
        outcomes.append(
            _attempt("gold", name, lambda n=name, p=plan: _refreshed(p(), f"{gold}/{n}"))
        )
    return outcomes


def _refreshed(rows: DataFrame, path: str) -> dict:
    """Overwrite; a refresh without rows fails, and the table that was there stays."""
    counts = overwrite(rows, path, keep_if_empty=True)
    if counts.pop("kept"):
        raise RuntimeError(KEPT)
    return counts


def _raising(message: str) -> Callable[[], DataFrame]:
    def fail() -> DataFrame:
        raise RuntimeError(message)

    return fail


# --- delivery ---------------------------------------------------------------


@dataclass(frozen=True)
class Delivery:
    """Where delivered tables, and everything held back, are kept."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"

    def duplicates(self, name: str) -> str:
        return f"{self.root}/duplicates/{name}"

    @property
    def catalog(self) -> str:
        return f"{self.root}/rule_catalog"

    @property
    def metrics(self) -> str:
        return f"{self.root}/pipeline_metrics"

    @property
    def checks(self) -> str:
        return f"{self.root}/data_quality_checks"


def load_table(
    spark: SparkSession, source: DataFrame, contract: TableContract, to: Delivery
) -> dict[str, int]:
    """Contract, quarantine, unique keys, full refresh: ``source`` to a table.

    ``source`` is read once: each row is judged and written, sound rows in the table's
    columns and the others as they came, with their reasons.  Every input row ends up in one of ``rows``,
    ``quarantined`` or ``duplicate``; ``unparsable`` counts dates and timestamps that
    became null.  Keys held twice are found on the keys alone and written as a report
    first.  Only rows with a reported key are ranked against each other, so a table
    whose keys are unique is loaded without shuffling its rows, and what was written
    first becomes its next version.  Differences between the stored table and the contract
    are logged before they are replaced.  Where nothing would be
    loaded, the table keeps the rows it had.
    """
    name, key = contract.name, list(contract.identity)
    named = normalize_names(source)
    for column, reason in unloadable(named, contract).items():
        log.warning("%s: column %s is not loaded: %s", name, column, reason)
    before = TableLog(spark, to.table(name)).newest()
    for d in against(before.schema, contract) if before else ():
        log.warning(
            "%s: column %s: %s (stored %s, wanted %s)", name, d.column, d.kind, d.stored, d.wanted
        )
    prepared = conform.loadable(named, contract)
    counts = {
        "held": F.count_if(F.col(conform.HELD)),
        "unparsable": F.coalesce(F.sum(conform.UNPARSABLE), F.lit(0)),
    }
    stamped = stamp_loaded(conform.told_apart(prepared, contract), contract.stamps)
    columns = [*contract.column_names, *contract.stamps]
    with Split(stamped, to.table(name), conform.HELD, counts) as split:
        overwrite(split.rows(True).select(f"{conform.AS_IT_CAME}.*"), to.quarantine(name))
        sound, loaded = split.rows(False).select(*columns), split.counts["rows"]
        surplus = {"surplus": F.coalesce(F.sum(F.col("n") - 1), F.lit(0))}
        clashes = overwrite(duplicate_keys(sound, key), to.duplicates(name), surplus)
        if clashes["rows"]:
            repeated = read_table(spark, to.duplicates(name)).select(*key)
            unique = unique_rows(sound, repeated, key, contract.column_names)
            loaded = overwrite(unique, to.table(name), keep_if_empty=True)["rows"]
        else:
            split.publish(False, columns)
    return {
        "rows": loaded,
        "quarantined": split.counts["held"],
        "duplicate": clashes["surplus"],
        "unparsable": split.counts["unparsable"],
    }


def deliver(
    spark: SparkSession,
    silver_root: str,
    gold: str,
    to: Delivery,
    run_id: str,
    sample_rows: int | None = None,
    jdbc_url: str | None = None,
    jdbc_extra: dict[str, str] | None = None,
) -> list[Outcome]:
    """Load the five warehouse tables, record metrics, register the views.

    Every review is delivered, unless ``sample_rows`` asks for so many of them.  A table
    into which nothing was loaded counts as failed, and keeps the rows it had.
    """

    def reviews() -> DataFrame:
        review = read_table(spark, f"{silver_root}/review")
        if sample_rows is None:
            return review
        return capped_sample(review, sample_rows, ["review_id"], ties=review.columns)

    sources = {
        "business_analytics": lambda: read_table(spark, f"{gold}/business_analytics"),
        "business_details": lambda: read_table(spark, f"{silver_root}/business"),
        "user_analytics": lambda: read_table(spark, f"{gold}/user_analytics"),
        "city_summary": lambda: read_table(spark, f"{gold}/city_summary"),
        "reviews": reviews,
    }

    def load(name: str) -> dict:
        counts = load_table(spark, sources[name](), WAREHOUSE[name], to)
        if jdbc_url and counts["rows"]:
            written = read_table(spark, to.table(name))
            contract = WAREHOUSE[name]
            more = {"createTableColumnTypes": contract.database_types, **(jdbc_extra or {})}
            load_jdbc(written, jdbc_options(jdbc_url, name, contract.batch_rows, **more))
        return counts

    outcomes = [
        _attempt("delivery", name, lambda n=name: load(n), rows_wanted=True)
        for name in LOAD_ORDER
    ]
    record_metrics(spark, to.metrics, run_id, outcomes)
    views.register(spark, delivered(spark, to))
    return outcomes


def delivered(spark: SparkSession, to: Delivery) -> dict[str, DataFrame]:
    """The warehouse tables that exist."""
    found = {}
    for name in WAREHOUSE:
        try:
            found[name] = read_table(spark, to.table(name))
        except AnalysisException:
            continue
    return found


def validate(spark: SparkSession, to: Delivery, gate: float = rules.COUNT_GATE) -> DataFrame:
    """Share of the warehouse tables that have rows, against the gate."""
    counted = rules.row_counts(delivered(spark, to))
    wanted = spark.createDataFrame([(n,) for n in WAREHOUSE], "table_name string")
    each = wanted.join(counted, "table_name", "left")
    return rules.score(each.select(F.coalesce("passed", F.lit(False)).alias("passed")), gate)


def seed_catalog(spark: SparkSession, to: Delivery, seeds=rules.CATALOG) -> DataFrame:
    """Add the rules whose name the stored catalog lacks, and return the catalog."""
    seeded = rules.catalog_rows(spark, seeds)
    try:
        stored = read_table(spark, to.catalog)
        seeded = absent(stored, seeded, ["check_name"])
    except AnalysisException:
        pass  # no catalog yet
    new = [tuple(rule) for rule in seeded.collect()]
    if new:
        append_rows(spark, to.catalog, new, rules.CATALOG_COLUMNS)
    return read_table(spark, to.catalog)


def record_checks(spark: SparkSession, to: Delivery) -> DataFrame:
    """Evaluate the stored rules on the delivered tables and append the results."""
    views.register(spark, delivered(spark, to))
    stored = [tuple(rule) for rule in seed_catalog(spark, to).collect()]
    results = rules.run_catalog(spark, stored)
    columns = [c.split()[0] for c in QUALITY_CHECKS.strip().split(",")]
    append(results.select(*columns).coalesce(1), to.checks)
    return read_table(spark, to.checks)


# --- bookkeeping ------------------------------------------------------------


def record_metrics(
    spark: SparkSession, path: str, run_id: str, outcomes: list[Outcome]
) -> None:
    """One row per delivered table."""
    rows = [
        (
            run_id,
            o.table,
            o.rows,
            Decimal(f"{o.seconds:.2f}"),
            o.status,
            o.error,
            o.ended,
            sum(o.counts.get(c, 0) for c in ("rows", "quarantined", "duplicate")),
            o.counts.get("quarantined", 0),
            o.counts.get("duplicate", 0),
            o.counts.get("unparsable", 0),
        )
        for o in outcomes
    ]
    append_rows(spark, path, rows, PIPELINE_METRICS)


def record_execution(
    spark: SparkSession, path: str, pipeline: str, outcomes: list[Outcome]
) -> None:
    """One row per stage and table, for any of the jobs."""
    rows = [
        (
            pipeline,
            f"{o.stage}/{o.table}",
            o.started,
            o.ended,
            round(o.seconds),
            o.rows,
            o.status,
            o.error,
        )
        for o in outcomes
    ]
    append_rows(spark, path, rows, EXECUTION_LOG)


def run_report(entries: DataFrame) -> DataFrame:
    """Count and share of each status; no rows, over an empty log, is no error."""
    per_status = entries.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    # One row per status: their counts add up to the total without a second scan.
    every = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return per_status.withColumn("percent", share(F.col("n"), every))
