"""Clustering on a curve, footers, daily state, the weekly model and run reports."""

import contextlib
import io
import random
from datetime import date, datetime, timedelta

import pytest
from helpers import SF_DIR, rows
from pyspark.sql import functions as F

import retail_queries as Q
from clickmill.functions import curve
from clickmill.operators import analytics, dims, gold, oplogs, silver, state
from clickmill.plans import jobs
from clickmill.schemas import PARTITION_COLUMNS
from clickmill.sources import changes, files, writers

NOW = datetime(2024, 3, 1)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_rank_is_the_number_of_bounds_below_the_value(spark):
    bounds = [1.0, 2.0, 2.0, 5.0, 5.0, 8.0, 9.0]
    values = [None, -3.0, 1.0, 1.5, 2.0, 4.9, 5.0, 8.5, 9.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.r for r in df.select(curve.rank_bucket(F.col("v"), bounds, 3).alias("r")).collect()]
    assert got == [0 if v is None else sum(b < v for b in bounds) for v in values]


def test_z_value_interleaves_the_ranks(spark):
    df = spark.range(64).selectExpr("cast(id % 8 as int) AS a", "concat('same-', chr(cast(97 + id div 8 as int))) AS b")
    got = {(r.a, ord(r.b[-1]) - 97): r.z for r in df.select("a", "b", curve.z_value(df, ["a", "b"], 3).alias("z")).collect()}
    assert len(set(got.values())) == 64
    for (a, b), z in got.items():
        assert z == sum((a >> i & 1) << 2 * i | (b >> i & 1) << 2 * i + 1 for i in range(3))


def test_text_order_follows_the_bytes(spark):
    words = ["", "a", "ab", "b", "é", "zz", "日本", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.n for r in df.select("w", curve.order_number(df, "w").alias("n")).collect()}
    known = sorted((w for w in words if w is not None), key=str.encode)
    assert [got[w] for w in known] == sorted(got[w] for w in known) and got[None] is None


def test_curve_serves_ranges_of_both_columns(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.randrange(10**6), rng.randrange(10**6)) for _ in range(8000)], "a int, b int")
    depth = {}
    for on_curve in (False, True):
        path = files.scratch(spark, "t")
        df.write.parquet(path)
        writers.compact(spark, path, 16, ("a", "b"), curve=on_curve)
        table = spark.read.parquet(path)
        assert table.exceptAll(df).isEmpty() and table.count() == 8000
        depth[on_curve] = [oplogs.layout_health(oplogs.file_ranges(table, c)).first().average_depth for c in ("a", "b")]
    assert depth[False][0] < 1.5 and depth[False][1] > 7  # plain order serves the first column only
    assert max(depth[True]) < 6


def test_footers_answer_without_reading_columns(spark):
    ranges = oplogs.footer_ranges(spark, Q.silver_table(spark, SF_DIR), PARTITION_COLUMNS, "user_id")
    text = plan(ranges)
    assert "PushedAggregation: [MIN(user_id), MAX(user_id), COUNT(*)]" in text
    assert "SinglePartition" not in plan(oplogs.layout_health(ranges)).split("Window")[0]


def test_layout_sweep_carries_counts_over_ranges(spark):
    """Many files, equal ends across all value ranges, ranges that span everything."""
    rng = random.Random(8)
    found = [(0, 1000)] * 5 + [(500, 500)] * 40 + [(lo := rng.randrange(1000), min(1000, lo + rng.choice([0, 3, 50, 400]))) for _ in range(400)]
    got = oplogs.layout_health(spark.createDataFrame([(f"f{i}", a, b) for i, (a, b) in enumerate(found)], "file string, lo int, hi int")).first()
    depth = [sum(lo <= a <= hi for lo, hi in found) for a, _ in found]
    met = [sum(lo <= b and hi >= a for lo, hi in found) - 1 for a, b in found]
    assert (got.files, got.max_depth) == (len(found), max(depth))
    assert got.average_depth == pytest.approx(sum(depth) / len(found)) and got.average_overlaps == pytest.approx(sum(met) / len(found))


# --- daily state -----------------------------------------------------------------

def test_folded_days_equal_the_daily_tables(events):
    folded = state.fold(state.daily_state(events, []), ["event_date"])
    assert rows(folded.select("event_date", "users", "events", "purchasers")) == rows(
        gold.daily_active_users(events).select("event_date", "daily_active_users", "total_events", "purchasing_users"))
    per_product = state.fold(state.daily_state(events, ["product_id"]), ["event_date", "product_id"])
    assert rows(per_product.select("event_date", "product_id", "users", "views", "cart_adds", "purchases", "revenue")) == rows(
        gold.product_daily(events).select("event_date", "product_id", "unique_users", "views", "cart_adds", "purchases", "revenue"))


def test_users_beyond_one_block_and_missing_ones(spark):
    data = [(date(2024, 1, d), u, "purchase", 1.0) for d in (1, 2) for u in (1, 32_768, 32_769, 10**6, 2**30, None)]
    df = spark.createDataFrame(data, "event_date date, user_id int, event_type string, price double")
    kept = state.daily_state(df, [])
    assert rows(state.fold(kept, ["event_date"]).select("users", "events")) == [(5, 6), (5, 6)]
    assert rows(state.fold(kept, [state.period("month")]).select("users", "events", "purchasers", "revenue")) == [(5, 12, 5, 12)]


def silver_day(spark, number, *users):
    stamp = f"2024-01-{number:02d} 10:00:00"
    df = spark.createDataFrame([(f"e{number}-{u}", stamp, u, "purchase", 7, 2.5, "mobile", "SG", stamp) for u in users],
                               "event_id string, event_time string, user_id int, event_type string, product_id int, price double, device string, country string, ingestion_timestamp string")
    return silver.add_partitions(silver.cast_types(df))


def test_refresh_touches_changed_days_only(spark):
    path, base, mark = (files.scratch(spark, n) for n in ("silver", "state", "mark"))

    def weekly():
        return rows(spark.read.parquet(f"{base}/weekly_all").select(F.col("period").cast("string"), "users", "events"))

    def paths(name):
        return {r.path.split("/")[-2]: r.path for r in files.list_files(spark, f"{base}/{name}", "*.parquet").collect()}

    writers.write_partitions(silver_day(spark, 2, 1, 2).union(silver_day(spark, 3, 2, 3)).union(silver_day(spark, 9, 1)), path, PARTITION_COLUMNS)
    assert jobs.refresh_state(spark, path, base, mark, NOW) and weekly() == [("2024-01-01", 3, 4), ("2024-01-08", 1, 1)]
    assert not jobs.refresh_state(spark, path, base, mark, NOW)
    before = paths("state_all"), paths("weekly_all")
    writers.write_partitions(silver_day(spark, 3, 1), path, PARTITION_COLUMNS)
    assert not jobs.refresh_state(spark, path, base, mark, NOW + timedelta(minutes=5), lag=timedelta(hours=1))
    assert jobs.refresh_state(spark, path, base, mark, NOW + timedelta(hours=2), lag=timedelta(hours=1))
    assert weekly() == [("2024-01-01", 2, 3), ("2024-01-08", 1, 1)]
    after = paths("state_all"), paths("weekly_all")
    assert {k for k in before[0] if before[0][k] != after[0][k]} == {"event_date=2024-01-03"}
    assert {k for k in before[1] if before[1][k] != after[1][k]} == {"period=2024-01-01"}
    # a day that loses all its rows loses its state
    gone = silver_day(spark, 9, 1).withColumn("day", F.lit("10"))
    writers.upsert_path(spark, path, gone.withColumn("event_time", F.expr("event_time + interval 1 day")), ["event_id"], PARTITION_COLUMNS)
    assert jobs.refresh_state(spark, path, base, mark, NOW + timedelta(days=1))
    assert sorted(paths("state_all")) == [f"event_date=2024-01-{d}" for d in ("02", "03", "10")]
    assert changes.newest_version(spark, path) == 3


# --- weekly model ----------------------------------------------------------------

def series(spark, values):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([(start + timedelta(days=i), v) for i, v in enumerate(values)], "ts timestamp_ntz, y double")


def test_clean_weeks_raise_nothing_and_planted_days_are_found(spark):
    rng = random.Random(1)
    values = [100 + 3 * i + [0, 10, 20, 30, 80, 150, 40][i % 7] + rng.gauss(0, 2) for i in range(70)]
    model = analytics.fit_season(series(spark, values), "2024-02-11")
    one = model.first()
    assert one.slope == pytest.approx(3, abs=0.1) and one.deviation == pytest.approx(2, abs=1) and one.training_days == 42
    clean = analytics.detect_season(series(spark, values), model, 5.0, "2024-02-11")
    assert clean.count() == 28 and clean.filter("is_anomaly").isEmpty()
    values[50] += 30
    values[61] -= 30
    found = analytics.detect_season(series(spark, values), model, 5.0, "2024-02-11").filter("is_anomaly")
    assert [r.ts.date() for r in found.orderBy("ts").collect()] == [date(2024, 2, 20), date(2024, 3, 2)]


def test_model_equals_least_squares(spark):
    import numpy as np

    rng = random.Random(2)
    values = [rng.uniform(0, 100) if i % 11 else None for i in range(40)]
    known = [(i, v) for i, v in enumerate(values) if v is not None]
    design = np.array([[float((i % 7) == k) for k in range(7)] + [float(i)] for i, _ in known])
    y = np.array([v for _, v in known])
    fit, *_ = np.linalg.lstsq(design, y, rcond=None)
    one = analytics.fit_season(series(spark, values), "2025-01-01").first()
    assert one.slope == pytest.approx(fit[7])
    assert one.deviation == pytest.approx(np.sqrt(((y - design @ fit) ** 2).sum() / (len(y) - 8)))


def test_short_training(spark):
    week = series(spark, [1.0, 2.0, 3.0])
    scored = analytics.detect_season(series(spark, [1.0, 2.0, 3.0, 9.0]), analytics.fit_season(week, "2024-01-03"))
    assert [(r.forecast, r.is_anomaly) for r in scored.orderBy("ts").collect()] == [(1.0, False), (2.0, False), (3.0, False), (None, False)]
    assert analytics.fit_season(series(spark, []), "2024-01-03").isEmpty()


# --- dimensions and reports ------------------------------------------------------

def test_usual_values_of_a_hot_user(spark):
    data = [(u, d, c) for u, n in ((1, 3000), (2, 2), (None, 2)) for i in range(n) for d, c in ((("a", "b", None)[i % 3], ("X", "Y")[i % 2]),)]
    df = spark.createDataFrame(data, "user_id int, device string, country string").selectExpr(
        "*", "timestamp'2024-01-01' AS event_time", "'purchase' AS event_type", "CAST(1 AS DECIMAL(10,2)) AS price")
    got = {r.user_id: (r.primary_device, r.primary_country, r.total_events, r.total_purchases, float(r.total_revenue)) for r in dims.dim_users(df).collect()}
    assert got == {1: ("a", "X", 3000, 3000, 3000.0), 2: ("a", "X", 2, 2, 2.0), None: ("a", "X", 2, 2, 2.0)}
    assert plan(dims.dim_users(df)).count("Exchange (") == 3  # places, values, users


def test_a_run_reports_its_expectations_in_one_scan(spark, monkeypatch):
    seen = []
    real = writers.staged_overwrite
    monkeypatch.setattr(writers, "staged_overwrite", lambda df, *a, **k: (seen.append(plan(df)), real(df, *a, **k)))
    found = {r.rule_name: (r.passed, r.failed) for r in Q.run_expectations(spark, SF_DIR).collect()}
    assert len(found) == 2 and all(f > 0 for _, f in found.values())
    assert seen[0].count("Scan json") == 2 and "CollectMetrics" in seen[0]  # once in the tree, once in its details
