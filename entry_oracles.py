"""The same queries as DuckDB SQL."""

from __future__ import annotations

BUSINESS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS business_id,
        CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN ''
             ELSE 'Order ' || o_orderkey END AS business_name,
        'Customer ' || o_custkey AS address,
        nullif(strftime(o_orderdate, '%Y-%m'), '1996-03') AS city,
        o_orderstatus AS state,
        substring(o_orderpriority, 1, 1) AS postal_code,
        o_totalprice / 10000 AS latitude,
        o_totalprice / -5000 AS longitude,
        floor(o_totalprice / 100000) + 1 AS avg_stars,
        CASE WHEN o_orderpriority <> '2-HIGH'
             THEN CAST(floor(o_totalprice / 1000) AS INTEGER) END AS review_count,
        o_orderstatus = 'O' AS is_open,
        o_orderpriority AS categories
    FROM orders
    WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')
"""

REVIEW = """
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS review_id,
        CAST(l_suppkey AS VARCHAR) AS user_id,
        CAST(l_orderkey AS VARCHAR) AS business_id,
        floor((l_quantity - 1) / 10) + 1 AS stars,
        l_linenumber AS useful,
        CAST(l_quantity AS INTEGER) AS funny,
        CAST(CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS INTEGER) AS cool,
        CASE WHEN l_linestatus = 'F'
             THEN l_returnflag || ' héé😀 ' || l_suppkey END AS review_text,
        CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS review_date,
        CASE WHEN l_linestatus = 'F'
             THEN CAST(length(l_returnflag || ' héé😀 ' || l_suppkey) AS INTEGER)
             END AS text_length
    FROM lineitem
    WHERE l_tax < 0.08
"""

USER = """
    SELECT CAST(c_custkey AS VARCHAR) AS user_id,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_name END AS user_name,
        c_nationkey AS review_count,
        CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
             THEN DATE '2005-01-01' + c_nationkey END AS yelping_since,
        c_nationkey + 1 AS useful,
        c_nationkey + 2 AS funny,
        c_nationkey + 3 AS cool,
        c_nationkey * 2 AS fans,
        floor((c_acctbal + 1000) / 2500) + 1 AS average_stars
    FROM customer
    WHERE c_acctbal >= -900
"""

CHECKIN = """
    SELECT business_id, checkin_date,
        try_strptime(checkin_date, '%Y-%m-%d %H:%M:%S') AS checkin_datetime
    FROM (
        SELECT CAST(user_id AS VARCHAR) AS business_id,
            unnest(CASE event_type
                WHEN 'signup' THEN []
                WHEN 'purchase' THEN ['']
                WHEN 'error' THEN
                    [strftime(ts, '%Y-%m-%d %H:%M:%S'),
                     strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S'), 'bad']
                ELSE
                    [strftime(ts, '%Y-%m-%d %H:%M:%S'),
                     strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S')]
                END) AS checkin_date
        FROM events
        WHERE value >= 10
    )
"""

TIP = """
    SELECT role AS user_id, CAST(conv_id AS VARCHAR) AS business_id,
        CASE WHEN turn <> 3 THEN text END AS tip_text,
        CASE WHEN turn <> 5 THEN DATE '2024-01-01' + CAST(turn AS INTEGER) END AS tip_date,
        CAST(turn AS INTEGER) AS compliment_count,
        CASE WHEN turn <> 3 THEN CAST(length(text) AS INTEGER) END AS text_length
    FROM conversations
    WHERE role <> 'system'
"""

GOLD_BUSINESS = f"""
    SELECT b.business_id, b.business_name, b.city, b.state, b.avg_stars, b.review_count,
        r.actual_review_count, r.avg_review_stars, r.total_useful_votes,
        r.total_funny_votes, r.total_cool_votes, b.is_open, b.categories
    FROM ({BUSINESS}) b
    LEFT JOIN (
        SELECT business_id, count(review_id) AS actual_review_count,
            avg(stars) AS avg_review_stars,
            CAST(sum(useful) AS BIGINT) AS total_useful_votes,
            CAST(sum(funny) AS BIGINT) AS total_funny_votes,
            CAST(sum(cool) AS BIGINT) AS total_cool_votes
        FROM ({REVIEW}) GROUP BY business_id
    ) r ON b.business_id = r.business_id
"""

GOLD_USER = f"""
    SELECT u.user_id, u.user_name, u.review_count, r.actual_review_count,
        u.yelping_since, u.average_stars, r.avg_given_stars, u.fans, u.useful, u.funny,
        u.cool, r.useful_votes_given, r.funny_votes_given, r.cool_votes_given,
        r.avg_review_length
    FROM ({USER}) u
    LEFT JOIN (
        SELECT user_id, count(review_id) AS actual_review_count,
            avg(stars) AS avg_given_stars,
            CAST(sum(useful) AS BIGINT) AS useful_votes_given,
            CAST(sum(funny) AS BIGINT) AS funny_votes_given,
            CAST(sum(cool) AS BIGINT) AS cool_votes_given,
            avg(text_length) AS avg_review_length
        FROM ({REVIEW}) GROUP BY user_id
    ) r ON u.user_id = r.user_id
"""

GOLD_CITY = f"""
    SELECT city, state, count(business_id) AS total_businesses,
        count(DISTINCT business_id) AS unique_businesses,
        avg(avg_stars) AS city_avg_stars,
        CAST(sum(actual_review_count) AS BIGINT) AS total_reviews,
        count(CASE WHEN is_open THEN 1 END) AS open_businesses,
        count(CASE WHEN NOT is_open THEN 1 END) AS closed_businesses
    FROM ({GOLD_BUSINESS}) GROUP BY city, state
"""

_EXACT_MEAN = (
    "CAST(sum(CAST(floor({0} * 1e9 + 0.5) AS BIGINT)) AS DOUBLE) / count({0}) / 1e9"
)

# One list of checks, shared by the threshold and the score query.
_THRESHOLDS = f"""
    SELECT 'Business records count' AS check_name, 'business_analytics' AS table_name,
        count(*) AS actual, '>=' AS op, CAST(1000 AS BIGINT) AS expected,
        count(*) >= 1000 AS passed FROM ({GOLD_BUSINESS})
    UNION ALL SELECT 'User records count', 'user_analytics', count(*), '>=', 1000,
        count(*) >= 1000 FROM ({GOLD_USER})
    UNION ALL SELECT 'City records count', 'city_summary', count(*), '>=', 10,
        count(*) >= 10 FROM ({GOLD_CITY})
    UNION ALL SELECT 'Reviews sample count', 'reviews', count(*), '>=', 1000,
        count(*) >= 1000 FROM ({REVIEW})
    UNION ALL SELECT 'Business null check', 'business_analytics', count(*), '<=', 0,
        count(*) <= 0 FROM ({GOLD_BUSINESS}) WHERE business_id IS NULL
    UNION ALL SELECT 'Rating range check', 'business_analytics', count(*), '<=', 0,
        count(*) <= 0 FROM ({GOLD_BUSINESS}) WHERE avg_stars < 1 OR avg_stars > 5
    UNION ALL SELECT 'Missing table', 'not_there', CAST(NULL AS BIGINT), '>=', 1, false
    UNION ALL SELECT 'Missing column', 'city_summary', CAST(NULL AS BIGINT), '<=', 0, false
    UNION ALL SELECT 'Fails on values', 'reviews', CAST(NULL AS BIGINT), '<=', 0, false
"""


def _catalog_row(name: str, table: str, query: str, expected: str, rows: str) -> str:
    good = "> 0" if expected == ">0" else f"= {expected}"
    return f"""
        SELECT '{name}' AS check_name, '{table}' AS table_name,
            '{query}' AS check_query, '{expected}' AS expected_result,
            CAST(count(*) AS VARCHAR) AS actual_result,
            CASE WHEN count(*) {good} THEN 'passed' ELSE 'failed' END AS status
        FROM ({rows})
    """


_CATALOG = " UNION ALL ".join(
    (
        _catalog_row(
            "business_not_null_check",
            "business_analytics",
            "SELECT COUNT(*) FROM business_analytics WHERE business_id IS NULL",
            "0",
            f"SELECT * FROM ({GOLD_BUSINESS}) WHERE business_id IS NULL",
        ),
        _catalog_row(
            "user_not_null_check",
            "user_analytics",
            "SELECT COUNT(*) FROM user_analytics WHERE user_id IS NULL",
            "0",
            f"SELECT * FROM ({GOLD_USER}) WHERE user_id IS NULL",
        ),
        _catalog_row(
            "city_summary_check",
            "city_summary",
            "SELECT COUNT(*) FROM city_summary WHERE total_businesses > 0",
            ">0",
            f"SELECT * FROM ({GOLD_CITY}) WHERE total_businesses > 0",
        ),
        _catalog_row(
            "business_stars_range",
            "business_analytics",
            "SELECT COUNT(*) FROM business_analytics WHERE avg_stars < 1 OR avg_stars > 5",
            "0",
            f"SELECT * FROM ({GOLD_BUSINESS}) WHERE avg_stars < 1 OR avg_stars > 5",
        ),
    )
)

_JSON_EVENTS = """
    SELECT event_id, CASE WHEN event_type NOT IN ('error', 'purchase') THEN user_id END AS user_id,
        CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
        event_type IN ('error', 'purchase') AS is_malformed
    FROM events
"""

# Whole-number quarters of a unit: exact in binary, so both engines round alike.
_JUDGED_LINES = """
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS line_id,
        nullif(l_returnflag, 'N') AS flag,
        concat_ws(' ', 'line', l_suppkey, l_linestatus) AS note,
        try_cast(l_quantity / 4 AS DECIMAL(3,2)) AS rate,
        nullif(CAST(l_linenumber AS VARCHAR), '7') AS position
    FROM lineitem
"""

_ACCEPTED_LINES = f"""
    SELECT line_id, note, rate, CAST(position AS INTEGER) AS position
    FROM ({_JUDGED_LINES})
    WHERE length(note) <= 8 AND rate IS NOT NULL
"""

ORACLES = {
    # sources and provenance
    "bronze_provenance": """
        SELECT *, 'customer.parquet' AS source_file, 'bronze' AS data_layer FROM customer
    """,
    "json_schema_read": _JSON_EVENTS,
    "json_readable_rows": f"""
        SELECT event_id, user_id, event_type FROM ({_JSON_EVENTS})
        WHERE event_type IS NOT NULL
    """,
    "source_audit": f"""
        SELECT count(*) AS rows_read, count(CASE WHEN is_malformed THEN 1 END) AS malformed
        FROM ({_JSON_EVENTS})
    """,
    "json_multiline_records": """
        SELECT o_orderkey, o_orderpriority || ' {"[ \\" }] \\' AS note, o_custkey AS custkey,
            o_orderstatus AS status, false AS is_malformed
        FROM orders
    """,
    "json_map_lookup": """
        SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events
    """,
    # cleaning
    "silver_business": f"SELECT *, 'silver' AS data_layer FROM ({BUSINESS})",
    "silver_review": f"SELECT *, 'silver' AS data_layer FROM ({REVIEW})",
    "silver_user": f"SELECT *, 'silver' AS data_layer FROM ({USER})",
    "silver_checkin": f"SELECT *, 'silver' AS data_layer FROM ({CHECKIN})",
    "silver_tip": f"SELECT *, 'silver' AS data_layer FROM ({TIP})",
    "split_explode_lines": """
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
    """,
    "parse_dates": """
        SELECT o_orderkey,
            CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day,
            CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS moment
        FROM orders
    """,
    "normalize_names": """
        SELECT c_custkey AS c_custkey, c_name AS customername, c_acctbal AS acct_bal
        FROM customer
    """,
    # gold
    "gold_business_analytics": f"SELECT *, 'gold' AS data_layer FROM ({GOLD_BUSINESS})",
    "gold_user_analytics": f"SELECT *, 'gold' AS data_layer FROM ({GOLD_USER})",
    "gold_city_summary": f"SELECT *, 'gold' AS data_layer FROM ({GOLD_CITY})",
    "left_join_unmatched": """
        SELECT o_orderkey, n_lines, qty FROM orders LEFT JOIN (
            SELECT l_orderkey, count(l_linenumber) AS n_lines,
                CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
            FROM lineitem GROUP BY l_orderkey) r ON o_orderkey = l_orderkey
    """,
    # delivery
    "sanitize_null_tokens": """
        SELECT event_id, CASE WHEN event_type IN ('error', 'view', '') THEN NULL
            ELSE event_type END AS event_type FROM events
    """,
    "sanitize_boolean": """
        SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN true
            WHEN 'error' THEN false WHEN 'signup' THEN false END AS flag FROM events
    """,
    "sanitize_numeric": """
        SELECT o_orderkey,
            CASE o_orderstatus WHEN 'P' THEN o_totalprice END AS price FROM orders
    """,
    "coerce_datetime": """
        SELECT event_id, CASE WHEN event_type <> 'error'
            THEN date_trunc('second', ts) END AS ts2 FROM events
    """,
    "contract_columns": "SELECT event_id, event_type FROM events",
    "contract_cast_decimal": f"SELECT * FROM ({_ACCEPTED_LINES})",
    "contract_quarantine": """
        SELECT o_orderkey, o_orderpriority, o_totalprice,
            concat_ws(',',
                CASE WHEN length(o_orderpriority) > 8 THEN 'too_long:o_orderpriority' END,
                CASE WHEN o_totalprice >= 99999.995 THEN 'bad_value:o_totalprice' END,
                CASE WHEN o_orderstatus = 'P' THEN 'null_key:o_orderstatus' END) AS reasons
        FROM (SELECT * FROM orders)
        WHERE length(o_orderpriority) > 8 OR o_totalprice >= 99999.995
            OR o_orderstatus = 'P'
    """,
    "unique_key_keep_first": """
        SELECT l_orderkey, l_linenumber, l_partkey FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) rn
            FROM lineitem) WHERE rn = 1
    """,
    "unique_rows_loaded": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice,
            l_quantity FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) rn
            FROM lineitem) WHERE rn = 1
    """,
    "contract_dates": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS day,
            CASE WHEN o_orderstatus <> 'P' THEN date_trunc('second', o_orderdate) END AS moment
        FROM orders
    """,
    "duplicate_key_report": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
    "sample_capped": """
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY md5(o_orderkey::VARCHAR), o_orderkey LIMIT 1000
    """,
    "insert_if_absent": """
        SELECT o_custkey, 'stored' AS origin FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT DISTINCT o_custkey, 'new' AS origin FROM orders o
        WHERE o_orderstatus <> 'F' AND NOT EXISTS (
            SELECT 1 FROM orders b
            WHERE b.o_orderstatus = 'F' AND b.o_custkey = o.o_custkey)
    """,
    # views and checks
    "view_business_quality": f"""
        SELECT count(*) AS total_businesses,
            count(CASE WHEN business_name IS NULL OR business_name = '' THEN 1 END)
                AS missing_names,
            count(CASE WHEN city IS NULL OR city = '' THEN 1 END) AS missing_cities,
            count(CASE WHEN avg_stars IS NULL THEN 1 END) AS missing_ratings,
            {_EXACT_MEAN.format('avg_stars')} AS overall_avg_rating,
            count(CASE WHEN is_open THEN 1 END) AS open_businesses,
            count(CASE WHEN NOT is_open THEN 1 END) AS closed_businesses
        FROM ({GOLD_BUSINESS})
    """,
    "view_user_quality": f"""
        SELECT count(*) AS total_users,
            count(CASE WHEN user_name IS NULL OR user_name = '' THEN 1 END) AS missing_names,
            count(CASE WHEN yelping_since IS NULL THEN 1 END) AS missing_join_dates,
            avg(review_count) AS avg_reviews_per_user,
            avg(fans) AS avg_fans_per_user,
            count(CASE WHEN review_count > 0 THEN 1 END) AS active_users
        FROM ({GOLD_USER})
    """,
    "view_city_distribution": f"""
        SELECT state, count(DISTINCT city) AS cities_count,
            CAST(sum(total_businesses) AS BIGINT) AS state_total_businesses,
            {_EXACT_MEAN.format('city_avg_stars')} AS state_avg_rating,
            max(total_businesses) AS max_businesses_in_city,
            min(total_businesses) AS min_businesses_in_city
        FROM ({GOLD_CITY}) GROUP BY state ORDER BY state_total_businesses DESC
    """,
    "table_row_counts": """
        SELECT 'part' AS table_name, count(*) AS n, count(*) > 0 AS passed FROM part
        UNION ALL SELECT 'customer', count(*), count(*) > 0 FROM customer
        UNION ALL SELECT 'orders', count(*), count(*) > 0 FROM orders
        UNION ALL SELECT 'lineitem', count(*), count(*) > 0 FROM lineitem
        UNION ALL SELECT 'events', count(*), count(*) > 0 FROM events
    """,
    "threshold_checks": f"SELECT * FROM ({_THRESHOLDS})",
    "quality_score": f"""
        SELECT count(CASE WHEN passed THEN 1 END) AS passed_checks,
            count(*) AS total_checks,
            CAST(100.0 * count(CASE WHEN passed THEN 1 END) / count(*) AS DECIMAL(5,1))
                AS score,
            count(CASE WHEN passed THEN 1 END) * 100 >= 80 * count(*) AS ok
        FROM ({_THRESHOLDS})
    """,
    "rule_catalog": _CATALOG,
    "run_report": """
        SELECT o_orderstatus AS status, count(*) AS n,
            count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders) AS percent
        FROM orders GROUP BY o_orderstatus
    """,
}
