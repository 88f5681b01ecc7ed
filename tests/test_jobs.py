import json

import pytest
from pyspark.sql import functions as F

from tristrata import jobs
from tristrata.contracts import DATASETS, RAW_SCHEMAS, WAREHOUSE, raw_files, table
from tristrata.plans import rules
from tristrata.sinks.jdbc import jdbc_options
from tristrata.sinks.tables import overwrite, read_table
from tristrata.sources.ndjson import (
    MALFORMED,
    audit_source,
    malformed,
    parse_json,
    read_raw,
    readable,
)


def write_lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def business(i, **more):
    row = {
        "business_id": f"b{i}",
        "name": f"Name {i}",
        "address": f"{i} Harbour Road",
        "city": "Lakeside" if i % 2 else None,
        "state": "NW",
        "postal_code": "04711",
        "latitude": 45.25,
        "longitude": -101.5,
        "stars": 4.0,
        "review_count": 7,
        "is_open": 1,
        "categories": "Bakery, Tea",
    }
    return {**row, **more}


def review(i, **more):
    row = {
        "review_id": f"r{i}",
        "user_id": f"u{i % 3}",
        "business_id": f"b{i % 4}",
        "stars": 4.0,
        "useful": 1,
        "funny": 0,
        "cool": 1,
        "text": "Warm bread, cold tea.",
        "date": "2021-06-05 18:30:00",
    }
    return {**row, **more}


def user(i):
    return {
        "user_id": f"u{i}",
        "name": "None" if i == 0 else f"User {i}",
        "review_count": 12,
        "yelping_since": "2015-03-04",
        "useful": 5,
        "funny": 2,
        "cool": 3,
        "fans": 1,
        "average_stars": 3.7,
    }


RAW = {
    "business": [business(i) for i in range(10)]
    + [
        "{broken",
        business(10, review_count="many", attributes={"Parking": {"garage": False}}),
        business(1, name="again", stars=12.5),
        business(2, name="again", stars=2.5),
        business(11, name=None),
    ],
    "review": [review(i) for i in range(40)] + [review(40, stars=None)],
    "user": [user(i) for i in range(5)],
    "checkin": [
        {"business_id": "b1", "date": "2020-01-01 00:00:00, 2020-01-02 00:00:01"},
        {"business_id": "b2", "date": ""},
        {"business_id": "b3"},
    ],
    "tip": [
        {"user_id": "u1", "business_id": "b1", "text": None, "date": "2020-01-02 03:04:05"}
    ],
}


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    for name, rows in RAW.items():
        write_lines(root / "input" / f"raw_{name}.json", rows)
    sources = raw_files(str(root / "input"), prefix="raw_")
    bronze, silver, gold = (str(root / n) for n in ("bronze", "silver", "gold"))
    to = jobs.Delivery(str(root / "warehouse"))
    done = {
        "bronze": jobs.build_bronze(spark, sources, bronze, str(root / "rejects")),
        "silver": jobs.build_silver(spark, bronze, silver),
        "gold": jobs.build_gold(spark, silver, gold),
        "delivery": jobs.deliver(spark, silver, gold, to, "run-1", sample_rows=20),
    }
    return root, to, done


def counts(outcomes):
    return {o.table: o.counts for o in outcomes}


def test_all_layers_succeed(layers):
    for outcomes in layers[2].values():
        assert [o.error for o in outcomes if o.error] == []
        assert jobs.all_succeeded(outcomes)


def test_bronze(spark, layers):
    root, _, done = layers
    assert counts(done["bronze"])["business"] == {"rows": 14, "malformed": 2}
    assert counts(done["bronze"])["checkin"] == {"rows": 3, "malformed": 0}
    for name in DATASETS:
        df = read_table(spark, f"{root}/bronze/{name}")
        raw_columns = spark.createDataFrame([], RAW_SCHEMAS[name]).columns
        assert df.columns == [*raw_columns, "ingestion_timestamp", "source_file", "data_layer"]
        stamps = df.select("source_file", "data_layer").distinct().collect()
        assert [tuple(s) for s in stamps] == [(f"raw_{name}.json", "bronze")]
        assert df.select("ingestion_timestamp").distinct().count() == 1
    rejected = read_table(spark, f"{root}/rejects/business").select("line").collect()
    assert sorted(r.line[:10] for r in rejected) == ['{"business', "{broken"]
    assert read_table(spark, f"{root}/rejects/user").count() == 0


def test_bronze_of_multi_line_files_is_the_same(spark, layers, tmp_path):
    root = layers[0]
    for name, rows in RAW.items():
        sound = [r for r in rows if not isinstance(r, str)]
        (tmp_path / f"raw_{name}.json").write_text(json.dumps(sound, indent=2))
    sources = raw_files(str(tmp_path), prefix="raw_")
    at = str(tmp_path / "bronze")
    done = jobs.build_bronze(spark, sources, at, str(tmp_path / "rejects"), multi_line=True)
    assert [o.error for o in done if o.error] == []
    for name in DATASETS:
        both = [
            read_table(spark, f"{b}/{name}").drop("ingestion_timestamp")
            for b in (f"{root}/bronze", at)
        ]
        assert both[0].columns == both[1].columns
        shown = [sorted(str(r) for r in b.collect()) for b in both]
        assert shown[0] == shown[1], name


def test_a_file_with_bad_lines_is_parsed_once(spark, layers, tmp_path, monkeypatch):
    reads = []
    write = jobs.Split.__init__

    def counted(self, df, *rest):
        plan = df._jdf.queryExecution().executedPlan().toString()
        reads.append(plan.count("FileScan json"))
        write(self, df, *rest)

    monkeypatch.setattr(jobs.Split, "__init__", counted)
    overwritten = []
    keep = jobs.overwrite

    def watched(df, *rest, **more):
        overwritten.append("json" in df._jdf.queryExecution().executedPlan().toString())
        return keep(df, *rest, **more)

    monkeypatch.setattr(jobs, "overwrite", watched)
    sources = raw_files(str(layers[0] / "input"), prefix="raw_")
    done = jobs.build_bronze(spark, sources, str(tmp_path / "b"), str(tmp_path / "r"))
    assert counts(done)["business"] == {"rows": 14, "malformed": 2}
    assert reads == [1] * len(DATASETS) and not any(overwritten)


def test_one_bad_field_keeps_the_others(spark, layers):
    df = read_table(spark, f"{layers[0]}/bronze/business").where("business_id = 'b10'")
    row = df.first()
    assert row.review_count is None and row.name == "Name 10"
    assert json.loads(row.attributes["Parking"]) == {"garage": False}


def test_silver_and_gold_counts(layers):
    assert {t: c["rows"] for t, c in counts(layers[2]["silver"]).items()} == {
        "business": 13,
        "review": 40,
        "user": 5,
        "checkin": 3,
        "tip": 1,
    }
    assert {t: c["rows"] for t, c in counts(layers[2]["gold"]).items()} == {
        "business_analytics": 13,
        "user_analytics": 5,
        "city_summary": 2,
    }


def test_every_row_is_accounted_for(spark, layers):
    root, to, done = layers
    loaded = counts(done["delivery"])
    assert loaded["business_analytics"] == {
        "rows": 11,
        "quarantined": 1,
        "duplicate": 1,
        "unparsable": 0,
    }
    assert loaded["business_details"] == {
        "rows": 11,
        "quarantined": 1,
        "duplicate": 1,
        "unparsable": 0,
    }
    assert loaded["reviews"]["rows"] == 20
    for name, contract in WAREHOUSE.items():
        df = read_table(spark, to.table(name))
        assert df.columns == contract.column_names + list(contract.stamps)
        assert df.count() == loaded[name]["rows"]


def test_first_of_repeated_keys_wins(spark, layers):
    to = layers[1]
    kept = read_table(spark, to.table("business_analytics")).where("business_id = 'b2'")
    assert [(r.business_name) for r in kept.collect()] == ["Name 2"]
    report = read_table(spark, to.duplicates("business_analytics")).collect()
    assert [tuple(r) for r in report] == [("b2", 2)]


def test_null_tokens_are_nulls_in_the_warehouse(spark, layers):
    users = read_table(spark, layers[1].table("user_analytics"))
    assert users.where("user_id = 'u0'").first().user_name is None


def test_metrics_and_report(spark, layers):
    to, done = layers[1], layers[2]
    log = read_table(spark, to.metrics)
    found = {r.table_name: r for r in log.collect()}
    assert set(found) == set(WAREHOUSE)
    row = found["business_analytics"]
    assert (row.pipeline_run_id, row.rows_in, row.records_processed) == ("run-1", 13, 11)
    report = jobs.run_report(log).collect()
    assert [(r.status, r.n, r.percent) for r in report] == [("SUCCESS", 5, 100.0)]
    assert jobs.run_report(log.where("false")).count() == 0


def test_execution_log(spark, layers, tmp_path):
    path = str(tmp_path / "log")
    for outcomes in layers[2].values():
        jobs.record_execution(spark, path, "all layers", outcomes)
    log = read_table(spark, path)
    assert log.count() == 5 + 5 + 3 + 5
    assert log.where("end_time < start_time").count() == 0


def test_validation_and_stored_rules(spark, layers):
    to = layers[1]
    row = jobs.validate(spark, to).first()
    assert (row.total_checks, row.ok) == (5, True)
    first = jobs.record_checks(spark, to)
    assert {r.check_name: r.status for r in first.collect()} == {
        c[0]: "passed" for c in rules.CATALOG
    }
    again = jobs.record_checks(spark, to)
    assert again.count() == 8, "results are appended"
    assert read_table(spark, to.catalog).count() == 4, "rules are not"


def test_thresholds_on_delivered_tables(spark, layers):
    checks = rules.check_thresholds(spark, jobs.delivered(spark, layers[1]))
    passed = {r.check_name: r.passed for r in checks.collect()}
    assert passed["Business null check"] and passed["Rating range check"]
    assert not passed["Business records count"]


def test_reload_replaces(spark, layers, caplog):
    root, to, done = layers
    jobs.load_table(
        spark,
        read_table(spark, f"{root}/gold/city_summary").withColumn("Mayor-Name", F.lit("x")),
        WAREHOUSE["city_summary"],
        to,
    )
    assert "column mayor_name is not loaded: not in contract" in caplog.text
    again = jobs.load_table(
        spark,
        read_table(spark, f"{root}/gold/city_summary"),
        WAREHOUSE["city_summary"],
        to,
    )
    assert again["rows"] == read_table(spark, to.table("city_summary")).count() == 2


def test_a_failing_or_empty_refresh_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10)
    assert overwrite(rows, path)["rows"] == 10
    bad = spark.range(5).select(F.expr("raise_error('lost')").cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        overwrite(bad, path)
    assert read_table(spark, path).count() == 10
    assert overwrite(rows.limit(0), path, keep_if_empty=True) == {"rows": 0, "kept": 1}
    assert read_table(spark, path).count() == 10
    assert overwrite(read_table(spark, path).limit(3), path)["rows"] == 3
    assert read_table(spark, path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert len(list((tmp_path / "t" / "_data").iterdir())) == 2  # this version and the last


def test_nothing_sound_keeps_the_warehouse_table(spark, layers, tmp_path, monkeypatch):
    root = layers[0]
    sent = []
    monkeypatch.setattr(jobs, "load_jdbc", lambda df, options: sent.append(options["dbtable"]))
    to = jobs.Delivery(str(tmp_path / "w"))
    cities = read_table(spark, f"{root}/gold/city_summary")
    contract = WAREHOUSE["city_summary"]
    before = jobs.load_table(spark, cities, contract, to)["rows"]
    unsound = cities.withColumn("state", F.lit("far too long a state"))
    for source in (cities.limit(0), unsound):
        assert jobs.load_table(spark, source, contract, to)["rows"] == 0
        assert read_table(spark, to.table("city_summary")).count() == before
    none = str(tmp_path / "none")
    jobs.deliver(spark, none, none, to, "run", jdbc_url="jdbc:x")
    assert sent == []


def test_all_reviews_are_delivered_unless_a_number_is_asked_for(spark, layers, tmp_path):
    one = read_table(spark, f"{layers[0]}/silver/review").limit(1)
    many = one.drop("review_id").crossJoin(
        spark.range(1500).select(F.col("id").cast("string").alias("review_id"))
    )
    many.write.parquet(str(tmp_path / "s" / "review"))
    for asked, loaded in ((None, 1500), (1200, 1200)):
        to = jobs.Delivery(str(tmp_path / f"w{asked}"))
        silver, gold = str(tmp_path / "s"), str(tmp_path / "g")
        jobs.deliver(spark, silver, gold, to, "run", sample_rows=asked)
        assert read_table(spark, to.table("reviews")).count() == loaded


def test_unreadable_dates_become_null_and_are_counted(spark, tmp_path):
    contract = table("t", "id bigint\nday date\nn int", key=("id",), stamps=())
    rows = spark.createDataFrame(
        [(1, "bad", 1.9), (2, "2020-01-02", None)], "id bigint, day string, n double"
    )
    to = jobs.Delivery(str(tmp_path))
    counts = jobs.load_table(spark, rows, contract, to)
    assert counts == {"rows": 2, "quarantined": 0, "duplicate": 0, "unparsable": 1}
    found = {r.id: (str(r.day), r.n) for r in read_table(spark, to.table("t")).collect()}
    assert found == {1: ("None", 2), 2: ("2020-01-02", None)}


def test_the_catalog_grows_by_new_rules_only(spark, tmp_path):
    to = jobs.Delivery(str(tmp_path))
    for _ in range(3):
        jobs.seed_catalog(spark, to)
    assert len(list((tmp_path / "rule_catalog" / "_data").glob("*/*.parquet"))) == 1


def test_missing_source_stops_before_writing(spark, tmp_path):
    write_lines(tmp_path / "in" / "tip.json", RAW["tip"])
    sources = raw_files(str(tmp_path / "in"))
    done = jobs.build_bronze(spark, sources, str(tmp_path / "bronze"), str(tmp_path / "rej"))
    assert not jobs.all_succeeded(done)
    assert all(o.status == jobs.FAILED for o in done)
    assert "PATH_NOT_FOUND" in done[0].error
    assert not (tmp_path / "bronze").exists()


def test_one_failed_table_does_not_stop_the_others(spark, layers, tmp_path):
    root = layers[0]
    read_table(spark, f"{root}/silver/user").write.parquet(str(tmp_path / "s" / "user"))
    read_table(spark, f"{root}/silver/review").write.parquet(str(tmp_path / "s" / "review"))
    done = jobs.build_gold(spark, str(tmp_path / "s"), str(tmp_path / "g"))
    assert [o.status for o in done] == [jobs.FAILED, jobs.SUCCESS, jobs.FAILED]
    assert done[2].error == "RuntimeError: business_analytics was not rebuilt"


def test_nothing_loaded_is_a_failure_with_a_reason(spark, layers, tmp_path):
    root, _, _ = layers
    empty = read_table(spark, f"{root}/silver/review").where("false")
    empty.write.parquet(str(tmp_path / "s" / "review"))
    to = jobs.Delivery(str(tmp_path / "w"))
    done = {
        o.table: o
        for o in jobs.deliver(spark, str(tmp_path / "s"), str(tmp_path / "g"), to, "run-2")
    }
    assert done["reviews"].error == "no rows loaded"
    assert "PATH_NOT_FOUND" in done["user_analytics"].error
    log = read_table(spark, to.metrics)
    assert log.where("status = 'FAILED' AND error_message IS NOT NULL").count() == 5


def test_audit(spark, tmp_path):
    write_lines(tmp_path / "business.json", RAW["business"])
    raw = read_raw(spark, str(tmp_path / "business.json"), "business")
    assert [tuple(r) for r in audit_source(raw).collect()] == [(15, 2)]
    assert readable(raw).count() == 14
    assert malformed(raw).count() == malformed(raw).select("line").count() == 2
    kept = sorted(r.kept for r in malformed(raw).select("kept").collect())
    assert '"business_id":"b10"' in kept[0] and kept[1] == "{}"
    assert MALFORMED in raw.columns


def test_json_in_a_column_reads_like_a_file(spark):
    lines = ['{"a": 1, "b": "x"}', '{"a": "y", "b": "x"}', "{broken", "{}", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, t string")
    out = parse_json(df, "t", "a int, b string")
    assert out.columns == ["i", "a", "b", MALFORMED]
    found = {r.i: (r.a, r.b, r[MALFORMED]) for r in out.collect()}
    assert found == {
        0: (1, "x", None),
        1: (None, "x", lines[1]),
        2: (None, None, lines[2]),
        3: (None, None, None),
        4: (None, None, None),
    }
    assert sorted(r.i for r in readable(out, ["a", "b"]).collect()) == [0, 1, 3, 4]
    assert "from_json" not in plan_filters(out.where("a = 1"))


def plan_filters(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Filter" in line][0]


def test_array_files_need_multi_line(spark, tmp_path):
    (tmp_path / "tip.json").write_text(json.dumps(RAW["tip"] * 3, indent=1))
    raw = read_raw(spark, str(tmp_path / "tip.json"), "tip", multi_line=True)
    assert readable(raw).count() == 3


def test_large_file_is_read_by_many_tasks(spark, tmp_path):
    write_lines(tmp_path / "review.json", [review(i) for i in range(5000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = read_raw(spark, str(tmp_path / "review.json"), "review")
        assert raw.rdd.getNumPartitions() > 4
        assert raw.select(F.countDistinct("review_id")).first()[0] == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "reviews", batch_rows=1000, user="u")
    assert options["truncate"] == "true" and options["batchsize"] == "1000"
    assert (options["dbtable"], options["user"]) == ("reviews", "u")
    cities = WAREHOUSE["city_summary"]
    assert "city varchar(100), state varchar(10)" in cities.database_types
    assert cities.key_statement == "ALTER TABLE city_summary ADD UNIQUE (city, state)"


def test_jdbc_load_reads_the_written_table(spark, layers, tmp_path, monkeypatch):
    """No database here: what would be sent is checked, not a load."""
    root, _, _ = layers
    sent = []
    monkeypatch.setattr(jobs, "load_jdbc", lambda df, options: sent.append((df, options)))
    to = jobs.Delivery(str(tmp_path / "w"))
    jobs.deliver(
        spark,
        f"{root}/silver",
        f"{root}/gold",
        to,
        "run-3",
        sample_rows=5,
        jdbc_url="jdbc:x",
        jdbc_extra={"user": "u"},
    )
    assert [o["dbtable"] for _, o in sent] == list(jobs.LOAD_ORDER)
    assert {o["dbtable"]: o["batchsize"] for _, o in sent}["reviews"] == "1000"
    for df, options in sent:
        assert df.inputFiles()[0].startswith(f"file://{to.table(options['dbtable'])}")
