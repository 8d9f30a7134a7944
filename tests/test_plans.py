"""Physical plans: what must be pruned, pre-aggregated or kept out."""

import contextlib
import io
import re

import fixtures as X
import pytest
from helpers import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry
import retail_queries as Q
from clickmill.operators import analytics, gold, governance, ingest, oplogs, silver
from clickmill.schemas import columns
from clickmill.sources import files, readers, writers
from clickmill.streaming import streams


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


LAZY = sorted(set(Q.QUERIES) - {
    "stream_ndjson", "stream_load", "stream_to_silver", "stream_route", "stream_status_by_bin", "run_gold"})


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairwise_join(spark, name):
    text = plan(Q.QUERIES[name](spark, SF_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_slice_after_the_mark_prunes_partitions(spark):
    schema = columns(event_id="string", event_time="timestamp_ntz", user_id="int",
                     year="string", month="string", day="string")
    table = readers.read_table(spark, Q.silver_table(spark, SF_DIR), schema)
    text = plan(gold.since_hwm(table, "2024-01-20"))
    assert re.search(r"PartitionFilters: \[.*make_date", text)


@pytest.mark.parametrize("build", [gold.daily_active_users, gold.conversion_funnel, gold.product_daily])
def test_distinct_counts_do_not_multiply_rows(events, build):
    text = plan(build(events))
    assert "Expand" not in text and text.count("Exchange (") <= 4


def test_dedup_limits_groups_before_the_shuffle(events):
    text = plan(silver.dedup(events, ["event_id"], "ingestion_timestamp"))
    assert text.count("WindowGroupLimit (") == 2  # one before and one after the exchange


def test_filters_and_columns_reach_the_scan(spark):
    path = files.scratch(spark, "fact")
    X.retail_events(spark, SF_DIR).write.parquet(path)
    text = plan(analytics.revenue_range(spark.read.parquet(path), "2024-01-05", "2024-01-25"))
    assert re.search(r"ReadSchema: struct<event_date:date,event_type:string,price:decimal\(10,2\)>", text)
    for pushed in ("EqualTo(event_type,purchase)", "GreaterThanOrEqual(event_date,2024-01-05)"):
        assert pushed in text


def test_latency_report_reads_the_log_once(spark):
    log = X.table(spark, SF_DIR, "events").select(
        F.col("ts").alias("timestamp"), F.lit("validator").alias("component"),
        F.col("event_type").alias("status"), F.col("value").alias("processing_time_ms"))
    report = oplogs.latency_by_bin(log.withColumn("status", F.lit("valid")))
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_top_n_needs_no_full_sort(events):
    assert "TakeOrderedAndProject" in plan(analytics.top_products(events, 10))


def test_row_security_is_an_equality_join(spark, events):
    grants = spark.createDataFrame([("u", "US")], "user_name string, country_code string")
    text = plan(governance.row_security(events, grants, "u", "BI"))
    assert "HashJoin" in text or "SortMergeJoin" in text
    assert "Join" not in plan(governance.row_security(events, grants, "u", "ACCOUNTADMIN"))


def small_events(spark, folder):
    """One hundred events of a day; five are damaged, of which one is repaired."""
    spark.range(100).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ'2024-01-14 23:30:00' + make_interval(0, 0, 0, 0, 0, id, 0) AS ts", "id % 7 AS user_id",
        "'view' AS event_type", "10.5D AS value", """'{"k": 5}' AS props""").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_records_are_checked_once_for_both_of_their_writes(spark, tmp_path, monkeypatch):
    written, append = [], writers.append_ndjson

    def noted(df, path, date_col):
        written.append(plan(df))
        append(df, path, date_col)

    monkeypatch.setattr(writers, "append_ndjson", noted)
    found = Q.recovered_to_gold(spark, small_events(spark, tmp_path))
    assert found.filter("table_name = 'gold_daily_active_users'").agg(F.sum("first_count")).first()[0] == 96
    assert len(written) == 3 and all("InMemoryTableScan" in text for text in written[:2])


def test_sessions_are_merged_before_they_are_shuffled(spark, tmp_path, monkeypatch):
    key, ran, run = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", [], streams.run_available
    spark.conf.set(key, "false")  # as in a session that build_session has not made
    monkeypatch.setattr(streams, "run_available", lambda *args: ran.append(run(*args)))
    try:
        entry.queries()["stream_alerts"](spark, small_events(spark, tmp_path))
    finally:
        spark.conf.set(key, "true")
    assert len(ran) == 2
    for query in ran:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            query.explain()
        sent = text.getvalue().split("SessionWindowStateStoreRestore", 1)[1].split("Exchange", 1)[1]
        assert "MergingSessions" in sent


def test_a_filter_on_the_reason_does_not_repeat_the_checks(spark):
    checked = ingest.with_rejection_reason(X.retail_raw(spark, SF_DIR), X.NOW)
    rejected = checked.filter(F.col("rejection_reason").isNotNull()).select("src_id", "rejection_reason")
    text = plan(rejected, "simple")
    assert text.count("record_is_not_dict") == 1
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan(rejected, "codegen"))]
    assert max(sizes) < 8000  # the JVM leaves larger methods uncompiled
