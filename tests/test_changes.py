"""Change log, remembered deletes, key filters and table history."""

import itertools
import re
from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from clickmill.operators import silver
from clickmill.plans import jobs
from clickmill.schemas import PARTITION_COLUMNS
from clickmill.sources import changes, files, key_index, readers, writers
from clickmill.streaming import streams

SCHEMA = "k string, seq int, v string, op string, p string"
BATCHES = [
    [("a", 1, "a1", "put", "x"), ("b", 1, "b1", "put", "x"), ("c", 1, "c1", "put", "y")],
    [("a", 3, None, "drop", None), ("b", 2, "b2", "put", "y"), ("d", 5, None, "drop", None)],
    [("a", 2, "a2", "put", "y"), ("c", 1, None, "drop", None), ("d", 4, "d4", "put", "x")],
    [("b", 3, None, "drop", None), ("b", 4, "b4", "put", "z"), ("e", 9, "e9", "put", "z")],
]
WANTED = [("b", 4, "b4", "z"), ("e", 9, "e9", "z")]


@pytest.mark.parametrize("order", [*itertools.islice(itertools.permutations(range(4)), 0, 24, 7)])
def test_deletes_are_remembered_in_any_order(spark, order):
    """Also when batches repeat; c is deleted at the sequence of its row, and the delete wins."""
    path, state, gone = files.scratch(spark, "t"), None, None
    for i in (*order, order[0]):
        batch = spark.createDataFrame(BATCHES[i], SCHEMA)
        state, gone = silver.apply_changes_with_deletes(state, gone, batch, ["k"], "seq", "op = 'drop'", ["op"])
        writers.apply_changes_path(spark, path, batch, ["k"], "seq", ("p",), "op = 'drop'", ["op"])
    assert rows(state.select("k", "seq", "v", "p")) == WANTED
    assert rows(gone) == [("a", 3), ("c", 1), ("d", 5)]
    assert rows(spark.read.parquet(path).select("k", "seq", "v", "p")) == WANTED


def test_an_old_row_after_its_delete_stays_out_until_the_delete_is_forgotten(spark):
    path = files.scratch(spark, "t")

    def put(*found):
        writers.apply_changes_path(spark, path, spark.createDataFrame(list(found), SCHEMA), ["k"], "seq", ("p",), "op = 'drop'", ["op"])
        return [r.v for r in spark.read.parquet(path).collect()] if files.is_table(spark, path) else []

    assert put(("a", 5, "new", "put", "x"), ("z", 1, "z", "put", "y")) in (["new", "z"], ["z", "new"])
    assert put(("a", 6, None, "drop", None)) == ["z"]
    assert put(("a", 5, "new", "put", "x")) == ["z"]
    writers.forget_deletes(spark, path, "seq", 6)
    assert put(("a", 4, "old", "put", "y")) == ["z"]
    writers.forget_deletes(spark, path, "seq", 7)
    assert sorted(put(("a", 4, "old", "put", "y"))) == ["old", "z"]


def test_a_stop_after_the_deletes_is_mended_by_the_repeated_batch(spark, monkeypatch):
    path, real = files.scratch(spark, "t"), writers.upsert_path
    batch = spark.createDataFrame([("a", 2, None, "drop", None), ("b", 2, "b2", "put", "x")], SCHEMA)

    def put(df):
        writers.apply_changes_path(spark, path, df, ["k"], "seq", ("p",), "op = 'drop'", ["op"])

    put(spark.createDataFrame([("a", 1, "a1", "put", "x"), ("b", 1, "b1", "put", "x")], SCHEMA))

    def stops(spark_, target, *args, **kwargs):
        if target == path:
            raise OSError("stopped")
        return real(spark_, target, *args, **kwargs)

    monkeypatch.setattr(writers, "upsert_path", stops)
    with pytest.raises(OSError):
        put(batch)
    monkeypatch.setattr(writers, "upsert_path", real)
    put(batch)
    assert rows(spark.read.parquet(path).select("k", "v")) == [("b", "b2")]


def test_stream_remembers_deletes(spark):
    landing, target, checkpoint = (files.scratch(spark, n) for n in ("landing", "silver", "checkpoint"))
    row = "{{\"event_id\": \"e1\", \"event_time\": \"2024-01-01T10:00:00+00:00\", \"event_type\": \"{}\", \"ingestion_timestamp\": \"2024-01-0{}T00:00:00+00:00\"}}"
    for kind, day, left in (("login", 2, 1), ("logout", 4, 0), ("login", 3, 0), ("login", 5, 1)):
        spark.createDataFrame([(row.format(kind, day),)], "value string").coalesce(1).write.mode("append").text(landing)
        streams.stream_to_silver(spark, landing, target, checkpoint, delete_when="event_type = 'logout'")
        assert (spark.read.parquet(target).count() if files.is_table(spark, target) else 0) == left


# --- versions ------------------------------------------------------------------

def test_versions_count_when_all_has_moved(spark, monkeypatch):
    """A reader between the note and the last move sees no new version; the next write takes the partitions up."""
    path, schema = files.scratch(spark, "t"), "k int, d string"
    writers.write_partitions(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], schema), path, ("d",))
    assert changes.newest_version(spark, path) == 1
    real, seen = files.replace, []

    def stops(spark_, source, target):
        if target == path + "/d=b":
            seen.append(changes.newest_version(spark, path))
            raise OSError("stopped")
        real(spark_, source, target)

    monkeypatch.setattr(files, "replace", stops)
    with pytest.raises(OSError):
        writers.write_partitions(spark.createDataFrame([(5, "a"), (6, "b")], schema), path, ("d",))
    monkeypatch.setattr(files, "replace", real)
    assert seen == [1] and changes.newest_version(spark, path) == 1
    writers.write_partitions(spark.createDataFrame([(7, "c")], schema), path, ("d",))
    newest = changes.newest_version(spark, path)
    assert changes.changed_partitions(spark, path, 1, newest) == [("a",), ("b",), ("c",)]
    assert rows(spark.read.parquet(path).select("k", "d")) == [(5, "a"), (6, "b"), (7, "c")]


def day(spark, number, *items):
    df = spark.createDataFrame([(f"e{i}", f"2024-01-{number:02d} 10:00:00", u, "login", None, None, "mobile", "SG", f"2024-01-{number:02d} 11:00:00") for i, u in items],
                               "event_id string, event_time string, user_id int, event_type string, product_id int, price double, device string, country string, ingestion_timestamp string")
    return silver.add_partitions(silver.cast_types(df))


def test_gold_follows_partition_writes_and_ignores_compaction(spark):
    path, out, mark = (files.scratch(spark, n) for n in ("silver", "gold", "mark"))

    def users():
        return rows(readers.read_table(spark, f"{out}/gold_daily_active_users").select(F.col("event_date").cast("string"), "daily_active_users"))

    now = datetime(2024, 3, 1)
    writers.write_partitions(day(spark, 1, (1, 1), (2, 2)).union(day(spark, 2, (3, 1))), path, PARTITION_COLUMNS)
    assert jobs.run_gold(spark, path, out, mark, now) and users() == [("2024-01-01", 2), ("2024-01-02", 1)]
    writers.compact(spark, path, 1, ("user_id",), PARTITION_COLUMNS)
    assert not jobs.run_gold(spark, path, out, mark, now)
    writers.write_partitions(day(spark, 2, (3, 1), (4, 2), (5, 3)), path, PARTITION_COLUMNS)
    assert jobs.run_gold(spark, path, out, mark, now) and users() == [("2024-01-01", 2), ("2024-01-02", 3)]


def folders_of(df):
    return sorted({f.split("/p=")[1].split("/")[0] for f in df.inputFiles()})


def test_history_and_feed_read_changed_partitions_only(spark):
    path, schema = files.scratch(spark, "t"), spark.createDataFrame([], "k string, v int, p string").schema

    def table(*found):
        return spark.createDataFrame(list(found), schema)

    writers.write_partitions(table(("a", 1, "x"), ("b", 1, "y"), ("c", 1, "z")), path, ("p",))
    with pytest.raises(ValueError, match="history"):
        changes.version_feed(spark, path, ["k"], 0, 1, schema)
    changes.keep_history(spark, path)
    writers.upsert_path(spark, path, table(("b", 2, "y"), ("d", 2, "w")), ["k"], ("p",))
    writers.upsert_path(spark, path, table(("b", 3, "w")), ["k"], ("p",))
    feed = changes.version_feed(spark, path, ["k"], 1, 3, schema)
    assert rows(feed.select("k", "v", "p", "_change_type")) == [
        ("b", 1, "y", "update_preimage"), ("b", 3, "w", "update_postimage"), ("d", 2, "w", "insert")]
    assert folders_of(feed) == ["w", "y"]
    states = {1: [("a", 1), ("b", 1), ("c", 1)], 2: [("a", 1), ("b", 2), ("c", 1), ("d", 2)], 3: [("a", 1), ("b", 3), ("c", 1), ("d", 2)]}
    for version, wanted in states.items():
        assert rows(changes.read_version(spark, path, ("p",), version, schema).select("k", "v")) == wanted
    assert rows(changes.version_feed(spark, path, ["k"], 2, 2, schema)) == []
    changes.forget_history(spark, path, 2)
    assert rows(changes.read_version(spark, path, ("p",), 2, schema).select("k", "v")) == states[2]
    with pytest.raises(ValueError, match="history"):
        changes.read_version(spark, path, ("p",), 1, schema)


# --- key filters ---------------------------------------------------------------

def test_filters_miss_no_key_and_pass_few_others(spark, monkeypatch):
    monkeypatch.setattr(key_index, "LIST_KEYS", 300)
    table = spark.range(60_000).selectExpr("concat('key-', id) AS k", "id % 7 AS n", "concat('p', id % 5) AS p")
    filters = key_index.build(table, ["k", "n"], ("p",)).persist()
    assert filters.count() == 5 * 2  # 12,000 keys need two blocks
    held = table.sample(0.01, seed=3)
    assert rows(key_index.passing(filters, held, ["k", "n"], ("p",), 1000)) == [(f"p{i}",) for i in range(5)]
    for i in range(3):
        one = table.where(f"p = 'p{i}'").limit(400)
        assert rows(key_index.passing(filters, one, ["k", "n"], ("p",), 400)) == [(f"p{i}",)]
    others = spark.range(2000).selectExpr("concat('other-', id) AS k", "id AS n")
    assert key_index.passing(filters, others, ["k", "n"], ("p",), 2000).count() <= 1
    filters.unpersist()


def test_upsert_reads_keys_where_the_filter_lets_one_pass(spark):
    path = files.scratch(spark, "t")
    schema = "k string, v int, p string"

    def put(*found):
        writers.upsert_path(spark, path, spark.createDataFrame(list(found), schema), ["k"], ("p",))

    put(*[(f"{p}{i}", 0, p) for p in "abcdef" for i in range(50)])

    def scanned(*keys):
        """Partitions whose keys are read, as the scan's partition filter names them."""
        incoming = spark.createDataFrame([(k,) for k in keys], "k string")
        target = spark.read.schema(schema).parquet(path)
        held = writers.held_partitions(spark, path, target, incoming, ["k"], ("p",))
        plan = held._jdf.queryExecution().toString()
        if "PartitionFilters" not in plan:
            return []
        named = sorted(set(re.findall(r"\[=(\w)\]", re.search(r"PartitionFilters: .*", plan)[0])))
        assert set(rows(held)) <= {(p,) for p in named}
        return named

    assert scanned("c7", "e1") == ["c", "e"] and scanned("nowhere") == []
    put(("c7", 1, "a"))  # moves, and both partitions get new filters
    assert rows(spark.read.parquet(path).where("k = 'c7'").select("v", "p")) == [(1, "a")]
    assert scanned("c7") == ["a"] and scanned("c8", "a0") == ["a", "c"]
    files.delete(spark, key_index.index_path(path) + "/p=d")
    assert scanned("c8") == ["c", "d"]  # without its filter a partition may hold any key
    writers.write_partitions(spark.createDataFrame([("new", 1, "f")], schema), path, ("p",))
    put(("new", 2, "b"))
    assert rows(spark.read.parquet(path).where("k = 'new'").select("v", "p")) == [(2, "b")]
    assert spark.read.parquet(path).where("p = 'f'").count() == 0


def test_missing_partition_values_have_filters(spark):
    path, schema = files.scratch(spark, "t"), "k string, v int, p string"
    for found in ([("a", 1, None), ("b", 1, "x=1")], [("a", 2, "y"), ("b", 2, None)]):
        writers.upsert_path(spark, path, spark.createDataFrame(found, schema), ["k"], ("p",))
    assert rows(spark.read.schema(schema).parquet(path).select("k", "v", "p")) == [("a", 2, "y"), ("b", 2, None)]


def test_buckets_of_other_keys_are_left_alone(spark):
    path = files.scratch(spark, "t")
    one = spark.range(200).selectExpr("id AS k", "0 AS v")
    writers.upsert_bucketed(spark, path, one, ["k"], 16)
    before = {r.path for r in files.list_files(spark, path, "*.parquet").collect()}
    writers.upsert_bucketed(spark, path, spark.createDataFrame([(3, 1), (900, 1)], "k long, v int"), ["k"], 16)
    after = {r.path for r in files.list_files(spark, path, "*.parquet").collect()}
    assert len(before & after) >= len(before) - 2
    got = writers.read_bucketed(spark, path)
    assert got.columns == ["k", "v"] and got.count() == 201 and rows(got.where("v = 1").select("k")) == [(3,), (900,)]
    with pytest.raises(ValueError, match="buckets"):
        writers.upsert_bucketed(spark, path, one, ["k"], 8)


def test_dimensions_dealt_by_key(spark, events):
    plain, dealt = files.scratch(spark, "dims"), files.scratch(spark, "dims")
    for part in (events.where("event_date < '2024-01-10'"), events.where("event_date >= '2024-01-08'")):
        jobs.refresh_dimensions(spark, part, plain, datetime(2024, 3, 1))
        jobs.refresh_dimensions(spark, part, dealt, datetime(2024, 3, 1), buckets=8)
    for name in ("dim_users", "dim_products"):
        one, other = spark.read.parquet(f"{plain}/{name}"), writers.read_bucketed(spark, f"{dealt}/{name}")
        assert one.count() == other.count() and one.exceptAll(other.select(*one.columns)).isEmpty()
