"""Table writes: idempotence, moved rows, interrupted replacement, marks and lags."""

from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from clickmill.operators import merge, silver
from clickmill.plans import jobs
from clickmill.schemas import PARTITION_COLUMNS
from clickmill.sources import changes, files, readers, writers
from clickmill.streaming.streams import latest_by_ingestion

NOW = datetime(2024, 3, 1)


def keyed(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v int")


def silver_rows(spark, *items):
    df = spark.createDataFrame(list(items), "event_id string, event_time string, v int, ingestion_timestamp string")
    return silver.add_partitions(silver.cast_types(df))


def test_upsert_twice_is_once(spark):
    path = files.scratch(spark, "t")
    writers.upsert_path(spark, path, keyed(spark, ("a", 1), ("b", 1)), ["k"])
    for _ in range(2):
        writers.upsert_path(spark, path, keyed(spark, ("b", 2), ("c", 2)), ["k"])
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 2), ("c", 2)]


def test_partitioned_upsert_moves_a_row_and_leaves_other_days_alone(spark):
    path = files.scratch(spark, "t")
    first = silver_rows(
        spark, ("e1", "2024-01-01 10:00:00", 1, "2024-01-01 10:00:01"),
        ("e2", "2024-01-02 10:00:00", 1, "2024-01-02 10:00:01"),
        ("e3", "2024-01-03 10:00:00", 1, "2024-01-03 10:00:01"))
    moved = silver_rows(spark, ("e2", "2024-01-05 10:00:00", 2, "2024-01-06 00:00:00"))

    def put(df):
        writers.upsert_path(spark, path, df, ["event_id"], PARTITION_COLUMNS, latest_by_ingestion)

    put(first)
    untouched = {r.path for r in files.list_files(spark, path + "/year=2024/month=01/day=03").collect()}
    put(moved)
    put(moved)
    got = spark.read.parquet(path)
    assert rows(got.select("event_id", "v", "day")) == [("e1", 1, "01"), ("e2", 2, "05"), ("e3", 1, "03")]
    assert {r.path for r in files.list_files(spark, path + "/year=2024/month=01/day=03").collect()} == untouched
    assert not files.exists(spark, path + "/year=2024/month=01/day=02")


def test_an_older_copy_does_not_replace_a_newer_one(spark):
    path = files.scratch(spark, "t")
    new = silver_rows(spark, ("e1", "2024-01-01 10:00:00", 2, "2024-01-02 00:00:00"))
    old = silver_rows(spark, ("e1", "2024-01-01 10:00:00", 1, "2024-01-01 00:00:00"))
    for df in (new, old):
        writers.upsert_path(spark, path, df, ["event_id"], PARTITION_COLUMNS, latest_by_ingestion)
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]


def test_interrupted_replacement_is_finished_from_the_staged_copy(spark):
    path = files.scratch(spark, "t")
    keyed(spark, ("a", 1)).write.parquet(path)
    keyed(spark, ("a", 2), ("b", 2)).write.parquet(path + "__staged")
    writers.upsert_path(spark, path, keyed(spark, ("c", 3)), ["k"])
    assert rows(spark.read.parquet(path)) == [("a", 2), ("b", 2), ("c", 3)]
    assert not files.exists(spark, path + "__staged")


def test_upsert_cols_keeps_the_other_columns(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, first int, last int")
    new = spark.createDataFrame([("b", 9, 9), ("c", 9, None)], "k string, first int, last int")
    got = merge.upsert_cols(old, new, ["k"], ["last"])
    assert rows(got) == [("a", 1, 1), ("b", 1, 9), ("c", 9, None)]


def test_change_feed_is_null_safe(spark):
    old = spark.createDataFrame([("a", None), ("b", 1), ("c", 1)], "k string, v int")
    new = spark.createDataFrame([("a", None), ("b", None), ("d", None)], "k string, v int")
    assert rows(merge.change_feed(old, new, ["k"])) == sorted([
        ("b", 1, "update_preimage"), ("b", None, "update_postimage"),
        ("c", 1, "delete"), ("d", None, "insert")], key=repr)


def test_extra_columns_need_the_flag(spark):
    old, new = keyed(spark, ("a", 1)), keyed(spark, ("b", 2)).withColumn("extra", F.lit("x"))
    with pytest.raises(ValueError, match="extra"):
        merge.append_evolving(old, new)
    assert rows(merge.append_evolving(old, new, merge_schema=True)) == [("a", 1, None), ("b", 2, "x")]


def test_apply_changes_deletes_and_excludes(spark):
    schema = "k string, seq int, op string, v int"
    target = spark.createDataFrame([("a", 1, "u", 1), ("b", 1, "u", 1)], schema)
    changes = spark.createDataFrame([("a", 2, "d", None), ("b", 0, "u", 0), ("c", 5, "u", 5), ("c", 4, "u", 4)], schema)
    got = silver.apply_changes(target, changes, ["k"], "seq", except_cols=["op"], delete_when="op = 'd'")
    assert rows(got) == [("b", 1, 1), ("c", 5, 5)]


def test_compaction_keeps_rows_and_cuts_files(spark):
    path = files.scratch(spark, "t")
    df = spark.range(1000).withColumn("u", F.col("id") % 7)
    df.repartition(40).write.parquet(path)
    before = files.list_files(spark, path, "*.parquet").count()
    writers.compact(spark, path, 4, cluster_cols=("u",))
    after = files.list_files(spark, path, "*.parquet").count()
    assert (before, after <= 5) == (40, True)
    assert spark.read.parquet(path).exceptAll(df).count() == 0 and spark.read.parquet(path).count() == 1000


def test_compaction_spreads_one_dominant_value(spark):
    path = files.scratch(spark, "t")
    spark.range(4000).withColumn("u", F.lit(1)).write.parquet(path)
    writers.compact(spark, path, 4, cluster_cols=("u",))
    per_file = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(per_file) >= 3 and max(r["count"] for r in per_file) < 2500


def test_mark_defaults_then_takes_the_newest(spark):
    path = files.scratch(spark, "mark")
    assert writers.read_hwm(spark, path) == "2020-01-01"
    writers.write_hwm(spark, path, "2024-01-05", NOW)
    writers.write_hwm(spark, path, "2024-01-07", NOW + timedelta(hours=1))
    assert writers.read_hwm(spark, path) == "2024-01-07"


def test_refresh_waits_for_the_lag(spark):
    path, lag = files.scratch(spark, "t"), timedelta(hours=1)
    steps = [(0, 1, True), (30, 2, False), (61, 3, True)]
    for minutes, value, expected in steps:
        done = writers.refresh_if_stale(
            spark, path, lambda v=value: keyed(spark, ("a", v)), lag, NOW + timedelta(minutes=minutes))
        assert done is expected
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]


def test_staged_load_skips_unreadable_rows_and_stamps(spark):
    path = files.scratch(spark, "t")
    spark.createDataFrame([("1", "2.50"), ("x", "1"), (None, "9.999")], "a string, b string").write.parquet(path)
    got = readers.load_staged(spark, path, {"a": "int", "b": "decimal(5,2)", "c": "date"}, loaded_at=NOW)
    assert sorted(str(r.b) for r in got.collect()) == ["10.00", "2.50"]
    assert {r.loaded_at for r in got.collect()} == {NOW} and got.columns == ["a", "b", "c", "loaded_at"]


def test_dimension_refresh_keeps_first_seen(spark, events):
    base = files.scratch(spark, "dims")
    jobs.refresh_dimensions(spark, events, base, NOW)
    first = rows(spark.read.parquet(base + "/dim_users").select("user_id", "first_seen"))
    jobs.refresh_dimensions(spark, events.filter(F.col("event_date") >= "2024-01-15"), base, NOW)
    assert rows(spark.read.parquet(base + "/dim_users").select("user_id", "first_seen")) == first


def test_derived_tables_follow_their_lags(spark, events):
    base = files.scratch(spark, "derived")
    names = set(jobs.TARGET_LAGS)
    assert set(jobs.refresh_derived(spark, lambda: events, base, NOW)) == names
    assert set(jobs.refresh_derived(spark, lambda: events, base, NOW + timedelta(hours=2))) == {
        n for n, lag in jobs.TARGET_LAGS.items() if lag == timedelta(hours=1)}


def test_quarantine_recovery_twice_adds_nothing(spark):
    import fixtures
    from helpers import SF_DIR

    src, bronze, dead, mark = (files.scratch(spark, n) for n in ("q", "b", "d", "m"))
    rejected = fixtures.quarantine(spark, SF_DIR).drop("src_id")
    writers.append_ndjson(rejected, src, "_quarantine_timestamp")

    def run(mark_path):
        summary = jobs.recover_quarantine(spark, src, bronze, dead, mark_path, NOW).first()
        return summary.total_quarantined, spark.read.json(bronze).count(), spark.read.parquet(dead).count()

    total, back, lost = run(mark)
    assert total == back + lost == rejected.count()
    assert run(mark) == (0, back, lost)
    # a run that starts over without its mark repeats no dead letter
    assert run(files.scratch(spark, "m")) == (total, 2 * back, lost)


def test_compaction_keeps_partition_names_whatever_the_session_infers(spark):
    path, key = files.scratch(spark, "t"), "spark.sql.sources.partitionColumnTypeInference.enabled"
    df = silver_rows(
        spark, ("e1", "2024-01-01 10:00:00", 1, "2024-01-01 10:00:01"),
        ("e2", "2024-01-02 10:00:00", 2, "2024-01-02 10:00:01"))
    writers.write_partitions(df, path, PARTITION_COLUMNS)
    before = files.partition_folders(spark, path, 3)
    spark.conf.set(key, "true")
    try:
        writers.compact(spark, path, 1, cluster_cols=("event_id",), cols=PARTITION_COLUMNS)
        writers.upsert_path(spark, path, df.filter("v = 2"), ["event_id"], PARTITION_COLUMNS, latest_by_ingestion)
        assert rows(spark.read.parquet(path).select("event_id", "v")) == [("e1", 1), ("e2", 2)]
    finally:
        spark.conf.set(key, "false")
    assert sorted(files.partition_folders(spark, path, 3)) == sorted(before) == [
        "/year=2024/month=01/day=01", "/year=2024/month=01/day=02"]


def test_interrupted_partition_moves_are_finished(spark):
    path = files.scratch(spark, "t")
    schema = "p string, k string, v int"
    spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], schema).write.partitionBy("p").parquet(path)
    spark.createDataFrame([("b", "y", 2)], schema).write.partitionBy("p").parquet(path + "__staged")
    writers.finish_interrupted(spark, path, ("p",))
    assert rows(spark.read.parquet(path).select("p", "k", "v")) == [("a", "x", 1), ("b", "y", 2)]
    assert not files.exists(spark, path + "__staged")


def test_key_leaves_the_missing_partition(spark):
    path = files.scratch(spark, "moves")
    schema = "k int, v string, d string"
    writers.upsert_path(spark, path, spark.createDataFrame([(1, "a", None), (2, "b", "x/y=%1"), (3, "c", "NULL")], schema), ["k"], ("d",))
    writers.upsert_path(spark, path, spark.createDataFrame([(1, "a2", "x"), (2, "b2", "x")], schema), ["k"], ("d",))
    got = spark.read.schema(schema).parquet(path)
    assert sorted(map(tuple, got.select("k", "v", "d").collect())) == [(1, "a2", "x"), (2, "b2", "x"), (3, "c", "NULL")]


def test_stop_between_stage_and_delete(spark, monkeypatch):
    path, schema = files.scratch(spark, "stopped"), "k int, d string"
    writers.upsert_path(spark, path, spark.createDataFrame([(1, "a"), (2, "b")], schema), ["k"], ("d",))
    real = writers._publish
    monkeypatch.setattr(writers, "_publish", lambda *a, **k: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        writers.upsert_path(spark, path, spark.createDataFrame([(1, "b")], schema), ["k"], ("d",))
    monkeypatch.setattr(writers, "_publish", real)
    writers.finish_interrupted(spark, path, ("d",))
    assert sorted(map(tuple, spark.read.schema(schema).parquet(path).select("k", "d").collect())) == [(1, "b"), (2, "b")]
    assert changes.newest_version(spark, path) == 2
    assert changes.changed_partitions(spark, path, 1, 2) == [("a",), ("b",)]


def test_compact_keeps_partitions(spark):
    path = files.scratch(spark, "compacted")
    rows = spark.range(100).selectExpr("id", "concat('p', id % 3) AS d")
    rows.write.partitionBy("d").parquet(path)
    with pytest.raises(ValueError, match="partitioned"):
        writers.compact(spark, path, 2)
    writers.compact(spark, path, 1, cols=("d",), only=[("p1",)])
    assert spark.read.parquet(path).exceptAll(rows).count() == 0 and spark.read.parquet(path).count() == 100


def test_rejects_with_one_stamp_are_all_recovered(spark):
    from datetime import datetime

    from clickmill import schemas
    from clickmill.plans import jobs

    bad, bronze, dead, mark = (files.scratch(spark, n) for n in ("bad", "bronze", "dead", "mark"))
    at = "2024-05-05T00:00:00+00:00"

    def reject(name, reason):
        row = (name, "2024-05-04T01:02:03+00:00", 5, "login", None, 1.5, "tablet", "SG", None, None, reason, at)
        writers.append_ndjson(spark.createDataFrame([row], schemas.QUARANTINE).selectExpr("*", "timestamp'2024-05-05' AS _at"), bad, "_at")

    def recover():
        return tuple(jobs.recover_quarantine(spark, bad, bronze, dead, mark, datetime(2024, 5, 6)).first())[:2]

    reject("first-one", "anomaly_login_has_price")
    assert recover() == (1, 1)
    reject("second-one", "anomaly_login_has_price")
    reject("third-one", "user_id_not_integer")
    assert recover() == (2, 1) and recover() == (0, 0)
    fixed = spark.read.schema(schemas.BRONZE).json(bronze).select("event_id", "ingestion_timestamp").collect()
    assert sorted(map(tuple, fixed)) == [("first-one", "2024-05-06T00:00:00+00:00"), ("second-one", "2024-05-06T00:00:00+00:00")]
    assert [r.event_id for r in spark.read.parquet(dead).collect()] == ["third-one"]
