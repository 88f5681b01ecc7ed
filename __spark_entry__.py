
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import entry_inputs as inputs  # noqa: E402
from entry_inputs import CLOCK, given, loose, stamp_text  # noqa: E402
from entry_oracles import ORACLES  # noqa: E402
from tristrata import jobs  # noqa: E402
from tristrata.contracts import table  # noqa: E402
from tristrata.functions import dates, sanitize  # noqa: E402
from tristrata.functions.measures import total  # noqa: E402
from tristrata.operators import conform  # noqa: E402
from tristrata.operators.columns import normalize_names  # noqa: E402
from tristrata.operators.dedupe import duplicate_keys, keep_first  # noqa: E402
from tristrata.operators.joining import insert_if_absent, join_summary, unique_rows  # noqa: E402
from tristrata.operators.sampling import capped_sample  # noqa: E402
from tristrata.operators.stamps import stamp_ingested  # noqa: E402
from tristrata.plans import gold, rules, views  # noqa: E402
from tristrata.plans.silver import silver  # noqa: E402
from tristrata.session import shared_folder  # noqa: E402
from tristrata.sources.multiline import read_multiline  # noqa: E402
from tristrata.sources.ndjson import MALFORMED, audit_source, parse_json, readable  # noqa: E402

try:
    import corpus_pipeline
    from tristrata.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # Only the removed modules themselves may be missing, not what they need.
    if missing.name not in ("corpus_pipeline", "tristrata.llm", "tristrata.llm.queries"):
        raise
    llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return gold_business_analytics(spark, SMOKE_DIR)


# --- sources and provenance ---------------------------------------------------


def bronze_provenance(spark, sf_dir):
    return stamp_ingested(given(spark, sf_dir, "customer")).drop("ingestion_timestamp")


def _raw_events(spark, sf_dir):
    """Events as JSON text, read back under a schema; some lines do not fit it."""
    kind = F.col("event_type")
    user = F.when(kind == "purchase", "someone").otherwise(F.col("user_id").cast("string"))
    line = F.concat(
        F.lit('{"user_id": '),
        F.when(kind == "purchase", F.concat(F.lit('"'), user, F.lit('"'))).otherwise(user),
        F.lit(', "undeclared": 1, "event_type": "'),
        kind,
        F.when(kind == "error", '"').otherwise('"}'),
    )
    lines = given(spark, sf_dir, "events").select("event_id", line.alias("line"))
    return parse_json(lines, "line", "user_id bigint, event_type string")


def json_schema_read(spark, sf_dir):
    raw = _raw_events(spark, sf_dir)
    return raw.select(
        "event_id", "user_id", "event_type", F.col(MALFORMED).isNotNull().alias("is_malformed")
    )


def json_readable_rows(spark, sf_dir):
    return readable(_raw_events(spark, sf_dir), fields=["user_id", "event_type"])


def source_audit(spark, sf_dir):
    return audit_source(_raw_events(spark, sf_dir).drop("event_id"))


#: Text with everything that could be taken for a record's border.
_BORDERS = ' {"[ \\" }] \\'


def json_multiline_records(spark, sf_dir):
    """Orders as pretty-printed JSON files, read back without line borders."""
    orders = given(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat("o_orderpriority", F.lit(_BORDERS)).alias("note"),
        F.struct(F.col("o_custkey").alias("key"), F.array("o_orderstatus").alias("tags")).alias("of"),
    )
    folder = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    orders.select(F.to_json(F.struct("*"), {"pretty": "true"})).write.text(folder)
    schema = "o_orderkey bigint, note string, of struct<key:bigint,tags:array<string>>"
    return read_multiline(spark, folder, schema).select(
        "o_orderkey",
        "note",
        F.col("of.key").alias("custkey"),
        F.col("of.tags")[0].alias("status"),
        F.col(MALFORMED).isNotNull().alias("is_malformed"),
    )


def json_map_lookup(spark, sf_dir):
    props = F.from_json("props", "map<string,string>")
    return given(spark, sf_dir, "events").select(
        "event_id", props["k"].try_cast("int").alias("k")
    )


# --- cleaning -----------------------------------------------------------------


def _silver(dataset: str) -> Query:
    def query(spark, sf_dir):
        return silver(dataset, getattr(inputs, dataset)(spark, sf_dir)).drop(*CLOCK)

    return query


def silver_checkin(spark, sf_dir):
    cleaned = _silver("checkin")(spark, sf_dir)
    moment = F.col("checkin_datetime").cast("timestamp_ntz")
    return cleaned.withColumn("checkin_datetime", moment)


def split_explode_lines(spark, sf_dir):
    lines = F.explode(F.split("text", "\n"))
    return given(spark, sf_dir, "documents").select("doc_id", lines.alias("line"))


def parse_dates(spark, sf_dir):
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "P", "no date")
        .when(status == "O", loose(F.col("o_orderdate").cast("date").cast("string")))
        .otherwise(stamp_text(F.col("o_orderdate")))
    )
    return given(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.parse_date(text).alias("day"),
        dates.parse_timestamp(text).cast("timestamp_ntz").alias("moment"),
    )


def query_normalize_names(spark, sf_dir):
    customers = given(spark, sf_dir, "customer")
    return normalize_names(
        customers.select(
            F.col("c_custkey").alias("C_CustKey"),
            F.col("c_name").alias("Customer Name"),
            F.col("c_acctbal").alias("Acct-Bal"),
        )
    )


# --- gold ---------------------------------------------------------------------


def _business(spark, sf_dir):
    return gold.business_analytics(
        silver("business", inputs.business(spark, sf_dir)),
        silver("review", inputs.review(spark, sf_dir)),
    )


def _user(spark, sf_dir):
    return gold.user_analytics(
        silver("user", inputs.user(spark, sf_dir)),
        silver("review", inputs.review(spark, sf_dir)),
    )


def gold_business_analytics(spark, sf_dir):
    return _business(spark, sf_dir).drop(*CLOCK)


def gold_user_analytics(spark, sf_dir):
    return _user(spark, sf_dir).drop(*CLOCK)


def gold_city_summary(spark, sf_dir):
    return gold.city_summary(_business(spark, sf_dir)).drop(*CLOCK)


def left_join_unmatched(spark, sf_dir):
    measures = {"n_lines": F.count("l_linenumber"), "qty": total("l_quantity")}
    lines = gold.summarize(given(spark, sf_dir, "lineitem"), ["l_orderkey"], measures)
    orders = given(spark, sf_dir, "orders").select("o_orderkey")
    per_order = lines.withColumnRenamed("l_orderkey", "o_orderkey")
    return join_summary(orders, per_order, ["o_orderkey"])


# --- delivery -----------------------------------------------------------------


def sanitize_null_tokens(spark, sf_dir):
    named = F.when(F.col("event_type") == "error", "nan").when(
        F.col("event_type") == "view", "None"
    )
    kind = sanitize.drop_null_tokens(F.coalesce(named, F.col("event_type")))
    return given(spark, sf_dir, "events").select("event_id", kind.alias("event_type"))


def sanitize_boolean(spark, sf_dir):
    kind = F.col("event_type")
    spelled = (
        F.when(kind == "click", "1")
        .when(kind == "view", "True")
        .when(kind == "error", "false")
        .when(kind == "signup", "0")
        .otherwise("yes")
    )
    return given(spark, sf_dir, "events").select(
        "event_id", sanitize.to_boolean(spelled).alias("flag")
    )


def sanitize_numeric(spark, sf_dir):
    status = F.col("o_orderstatus")
    price = (
        F.when(status == "O", float("nan"))
        .when(status == "F", float("-inf"))
        .otherwise(F.col("o_totalprice"))
    )
    return given(spark, sf_dir, "orders").select(
        "o_orderkey", sanitize.finite(price).alias("price")
    )


def coerce_datetime(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", "bad").otherwise(stamp_text(F.col("ts")))
    return given(spark, sf_dir, "events").select(
        "event_id", sanitize.to_naive_timestamp(text).alias("ts2")
    )


def contract_columns(spark, sf_dir):
    contract = table("event", "event_id bigint\nevent_type varchar(20)", key=("event_id",))
    nested = F.from_json("props", "map<string,string>")
    events = given(spark, sf_dir, "events").withColumn("props", nested)
    return conform.loadable(events, contract)


def contract_cast_decimal(spark, sf_dir):
    contract = table(
        "line", "line_id string\nnote varchar(8)\nrate decimal(3,2)\nposition int"
    )
    lines = given(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
        F.concat_ws(" ", F.lit("line"), "l_suppkey", "l_linestatus").alias("note"),
        # An overflow of decimal(3,2) is a violation, as is a longer note.
        (F.col("l_quantity") / 4).alias("rate"),
        F.when(F.col("l_linenumber") == 7, "nan")
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("position"),
    )
    return conform.accepted(lines, contract)


def contract_quarantine(spark, sf_dir):
    contract = table(
        "order",
        """
        o_orderkey bigint
        o_orderpriority varchar(8)
        o_totalprice decimal(7,2)
        o_orderstatus varchar(1)
        """,
        key=("o_orderkey", "o_orderstatus"),
    )
    status = F.when(F.col("o_orderstatus") == "P", "null").otherwise(F.col("o_orderstatus"))
    orders = given(spark, sf_dir, "orders").select(*contract.column_names)
    orders = orders.withColumn("o_orderstatus", status)
    return conform.quarantined(orders, contract).drop("o_orderstatus")


LINE_KEY = ["l_orderkey", "l_linenumber"]


def unique_key_keep_first(spark, sf_dir):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    first = keep_first(given(spark, sf_dir, "lineitem"), LINE_KEY, order, nulls=False)
    return first.select(*LINE_KEY, "l_partkey")


def unique_rows_loaded(spark, sf_dir):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    lines = given(spark, sf_dir, "lineitem").select(*LINE_KEY, *order)
    return unique_rows(lines, duplicate_keys(lines, LINE_KEY), LINE_KEY, order)


def contract_dates(spark, sf_dir):
    """Bad text in a date or timestamp column loads as null."""
    contract = table("order", "o_orderkey bigint\nday date\nmoment timestamp_ntz")
    text = F.when(F.col("o_orderstatus") == "P", "bad").otherwise(stamp_text(F.col("o_orderdate")))
    orders = given(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("day"), text.alias("moment")
    )
    return conform.passed(conform.judged(orders, contract), contract)


def duplicate_key_report(spark, sf_dir):
    return duplicate_keys(given(spark, sf_dir, "lineitem"), LINE_KEY)


def sample_capped(spark, sf_dir):
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return capped_sample(orders, 1000, ["o_orderkey"])


def query_insert_if_absent(spark, sf_dir):
    orders = given(spark, sf_dir, "orders")
    is_stored = F.col("o_orderstatus") == "F"
    stored = orders.where(is_stored).select("o_custkey")
    incoming = orders.where(~is_stored).select("o_custkey")
    return insert_if_absent(
        stored.withColumn("origin", F.lit("stored")),
        incoming.withColumn("origin", F.lit("new")),
        ["o_custkey"],
    )


# --- views and checks ---------------------------------------------------------


def view_business_quality(spark, sf_dir):
    return views.business_quality_summary(_business(spark, sf_dir))


def view_user_quality(spark, sf_dir):
    return views.user_quality_summary(_user(spark, sf_dir))


def view_city_distribution(spark, sf_dir):
    return views.city_business_distribution(gold.city_summary(_business(spark, sf_dir)))


def table_row_counts(spark, sf_dir):
    names = ("part", "customer", "orders", "lineitem", "events")
    return rules.row_counts({n: given(spark, sf_dir, n) for n in names})


def _delivered(spark, sf_dir):
    business = _business(spark, sf_dir)
    return {
        "business_analytics": business,
        "user_analytics": _user(spark, sf_dir),
        "city_summary": gold.city_summary(business),
        "reviews": silver("review", inputs.review(spark, sf_dir)),
    }


def threshold_checks(spark, sf_dir):
    broken = (
        rules.Threshold("Missing table", "not_there", at_least=1),
        rules.Threshold("Missing column", "city_summary", "mayor IS NULL", at_most=0),
        rules.Threshold(
            "Fails on values", "reviews", "CAST(concat('abc', review_id) AS INT) > 5", at_most=0
        ),
    )
    return rules.check_thresholds(
        spark, _delivered(spark, sf_dir), rules.THRESHOLDS + broken
    )


def quality_score(spark, sf_dir):
    return rules.score(threshold_checks(spark, sf_dir))


def rule_catalog(spark, sf_dir):
    views.register(spark, _delivered(spark, sf_dir))
    return rules.run_catalog(spark).drop("execution_time")


def run_report(spark, sf_dir):
    log = given(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"))
    return jobs.run_report(log)


def queries() -> dict[str, Query]:
    return {
        "bronze_provenance": bronze_provenance,
        "json_schema_read": json_schema_read,
        "json_readable_rows": json_readable_rows,
        "source_audit": source_audit,
        "json_multiline_records": json_multiline_records,
        "json_map_lookup": json_map_lookup,
        "silver_business": _silver("business"),
        "silver_review": _silver("review"),
        "silver_user": _silver("user"),
        "silver_checkin": silver_checkin,
        "silver_tip": _silver("tip"),
        "split_explode_lines": split_explode_lines,
        "parse_dates": parse_dates,
        "normalize_names": query_normalize_names,
        "gold_business_analytics": gold_business_analytics,
        "gold_user_analytics": gold_user_analytics,
        "gold_city_summary": gold_city_summary,
        "left_join_unmatched": left_join_unmatched,
        "sanitize_null_tokens": sanitize_null_tokens,
        "sanitize_boolean": sanitize_boolean,
        "sanitize_numeric": sanitize_numeric,
        "coerce_datetime": coerce_datetime,
        "contract_columns": contract_columns,
        "contract_cast_decimal": contract_cast_decimal,
        "contract_quarantine": contract_quarantine,
        "unique_key_keep_first": unique_key_keep_first,
        "unique_rows_loaded": unique_rows_loaded,
        "contract_dates": contract_dates,
        "duplicate_key_report": duplicate_key_report,
        "sample_capped": sample_capped,
        "insert_if_absent": query_insert_if_absent,
        "view_business_quality": view_business_quality,
        "view_user_quality": view_user_quality,
        "view_city_distribution": view_city_distribution,
        "table_row_counts": table_row_counts,
        "threshold_checks": threshold_checks,
        "quality_score": quality_score,
        "rule_catalog": rule_catalog,
        "run_report": run_report,
        **_training_data_queries(),
    }


def _training_data_queries() -> dict[str, Query]:
    if llm_queries is None:
        return {}
    return {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    if llm_queries is not None:
        found |= llm_queries.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
