"""Operators that split hot groups, against plain references on skewed rows."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from clickmill.functions.rollup import entity_rollup, exact_percentile, share_of_group, value_range
from clickmill.operators import analytics, oplogs, silver


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("width", [None, 0.5, 10.0, 1e6])
def test_percentile_equals_interpolation(spark, q, width):
    rng = random.Random(3)
    data = [("hot", round(rng.gauss(50, 20), 2)) for _ in range(600)]
    data += [(f"k{i % 7}", round(rng.expovariate(0.1), 2)) for i in range(200)]
    data += [("one", 4.25), ("nulls", None), ("same", 1.0), ("same", 1.0), ("neg", -3.5), ("neg", 2.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r.p for r in exact_percentile(df, ["k"], "v", q, "p", width).collect()}
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups) | {"nulls"} and got["nulls"] is None
    for k, values in groups.items():
        assert got[k] == pytest.approx(float(np.quantile(values, q)), abs=1e-9)


def test_value_ranges_rise_with_the_values_whatever_their_unit(spark):
    rng = random.Random(4)
    values = [sign * rng.random() * 10.0 ** rng.randint(-300, 300) for sign in (1, -1) for _ in range(400)]
    values += [0.0, -0.0, 5e-324, -5e-324, float("inf"), float("-inf"), float("nan"), 1.7976931348623157e308, None]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", value_range(F.col("v")).alias("r"))
    ranges = [r.r for r in got.filter("v IS NOT NULL").orderBy("v").collect()]
    assert None not in ranges and ranges == sorted(ranges)
    assert got.filter("v IS NULL").first().r is None
    spread = spark.range(200_000).select((F.col("id") * 1e6 + 1e9).alias("v"))
    assert 500 < spread.select(value_range(F.col("v"))).distinct().count() < 2000


def journey(rng, session, n, spread):
    at = datetime(2024, 1, 30)
    kinds = ["page_view", "add_to_cart", "checkout_complete"]
    return [
        (session, f"{session}-{i:05d}", rng.choice(kinds), at + timedelta(seconds=rng.randrange(spread)))
        for i in range(n)
    ]


def plain_time_to_cart(data, limit=3600):
    sessions, gaps = {}, []
    for s, i, kind, at in data:
        sessions.setdefault(s, []).append((at, i, kind))
    for events in sessions.values():
        events.sort()
        for (a, _, k), (b, _, n) in zip(events, events[1:]):
            gap = int((b - a).total_seconds())
            if (k, n) == ("page_view", "add_to_cart") and gap < limit:
                gaps.append(gap)
    return sum(gaps) / len(gaps) if gaps else None


@pytest.mark.parametrize("slot", [1, 60, 900, 86400])
def test_time_to_cart_does_not_depend_on_the_slot(spark, slot):
    rng = random.Random(11)
    data = journey(rng, "hot", 500, 80000)
    for i in range(100):
        data += journey(rng, f"s{i}", 5, rng.choice([30, 4000, 80000]))
    df = spark.createDataFrame(
        data, "session_id string, event_id string, event_type string, event_timestamp timestamp_ntz")
    got = analytics.time_to_cart(df, "2024-01-31", 7, slot_seconds=slot).first()[0]
    assert got == pytest.approx(plain_time_to_cart(data))


def test_time_to_cart_without_pairs_is_null(spark):
    df = spark.createDataFrame(
        [("s", "a", "page_view", datetime(2024, 1, 30))],
        "session_id string, event_id string, event_type string, event_timestamp timestamp_ntz")
    assert analytics.time_to_cart(df, "2024-01-31").first()[0] is None


def test_layout_health_equals_pairwise_counting(spark):
    rng = random.Random(5)
    ranges = []
    for i in range(60):
        lo = rng.randrange(50)
        ranges.append((f"f{i}", lo, lo + rng.choice([0, 1, 5, 40])))
    got = oplogs.layout_health(spark.createDataFrame(ranges, "file string, lo int, hi int")).first()
    depth = [sum(lo <= a <= hi for _, lo, hi in ranges) for _, a, _ in ranges]
    overlaps = [sum(lo <= b and hi >= a for _, lo, hi in ranges) - 1 for _, a, b in ranges]
    assert got.files == 60 and got.max_depth == max(depth)
    assert got.average_depth == pytest.approx(sum(depth) / 60)
    assert got.average_overlaps == pytest.approx(sum(overlaps) / 60)


def test_perfectly_clustered_files_have_depth_one(spark):
    ranges = spark.createDataFrame([(f"f{i}", 10 * i, 10 * i + 9) for i in range(5)], "file string, lo int, hi int")
    got = oplogs.layout_health(ranges).first()
    assert (got.average_depth, got.max_depth, got.average_overlaps) == (1.0, 1, 0.0)


def test_rollup_counts_distinct_entities_and_ignores_null_ones(spark):
    data = [("d1", u, t) for u in (1, 1, 2, None) for t in ("a", "b")] + [("d2", None, "a")]
    df = spark.createDataFrame(data, "d string, u int, t string")
    got = entity_rollup(
        df, ["d"], "u", distinct={"users": None, "b_users": F.col("t") == "b"}, counts={"n": None})
    assert rows(got.select("d", "users", "b_users", "n")) == [("d1", 2, 2, 8), ("d2", 0, 0, 1)]


def test_shares_add_up_within_a_group(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 5)], "g string, r string, n long")
    got = share_of_group(df, ["g"], "n", "pct")
    assert rows(got.select("g", "r", "pct")) == [("a", "x", 25.0), ("a", "y", 75.0), ("b", "x", 100.0)]


def test_a_key_with_very_many_copies_keeps_one_row(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("seq"))
    first, last = (silver.dedup(df, ["event_id"], "seq", keep=k) for k in ("first", "last"))
    assert first.count() == last.count() == df.select("event_id").distinct().count()
    assert first.filter("event_id = 'hot'").first().seq == 0
    assert last.filter("event_id = 'hot'").first().seq == 19998


def test_alert_rules_on_a_hand_made_log(spark):
    start, lines = datetime(2024, 1, 1), []
    for minute in range(0, 60):
        quarantined = 10 <= minute < 30
        lines.append((start + timedelta(minutes=minute), "quarantined" if quarantined else "valid"))
    lines += [(start + timedelta(minutes=41, seconds=s), "error") for s in range(11)]
    lines.append((start + timedelta(minutes=100), "valid"))
    df = spark.createDataFrame(lines, "timestamp timestamp_ntz, status string")
    got = {(r.alert, r.bin_start) for r in oplogs.alerts(df, as_of="2024-01-01 02:20:00").collect()}
    at = lambda m: start + timedelta(minutes=m)
    assert got == {
        ("high_quarantine_rate", at(20)), ("high_quarantine_rate", at(25)),
        ("errors", at(40)), ("no_events", at(55)), ("no_events", at(100))}
