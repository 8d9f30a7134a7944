"""The registered queries: each operator applied to the whole test tables."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import fixtures as X
from clickmill import constants as C
from clickmill import schemas
from clickmill.operators import analytics as A
from clickmill.operators import dims, gold, governance, ingest, merge, oplogs, quality, silver
from clickmill.plans import jobs
from clickmill.sources import changes, files, readers, writers
from clickmill.streaming import streams

LO, HI = "2024-01-05", "2024-01-25"
CLOCK = datetime(2024, 3, 1)
EVENT_COLUMNS = ["event_id", "user_id", "event_type", "product_id", "price", "device", "country"]


def wire_rows(df: DataFrame) -> DataFrame:
    """Event rows the way they travel as JSON: times as text, prices as numbers."""
    return df.select(
        "event_id", X.zulu("event_time").alias("event_time"), "user_id", "event_type", "product_id",
        F.col("price").cast("double").alias("price"), "device", "country",
        X.zulu("ingestion_timestamp").alias("ingestion_timestamp"),
        F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("processing_date"),
    )


def bronze_files(spark: SparkSession, sf_dir: str) -> str:
    path = files.scratch(spark, "bronze")
    wire_rows(X.retail_bronze(spark, sf_dir)).write.json(path)
    return path


def silver_table(spark: SparkSession, sf_dir: str) -> str:
    path = files.scratch(spark, "silver")
    rows = silver.add_partitions(X.retail_events(spark, sf_dir).drop("src_id", "value"))
    writers.write_partitions(rows, path, schemas.PARTITION_COLUMNS)
    return path


def staged_files(spark: SparkSession, sf_dir: str) -> str:
    """Columnar files whose price is text and unreadable on tablet purchases."""
    path = files.scratch(spark, "staged")
    broken = (F.col("event_type") == "purchase") & (F.col("device") == "tablet")
    rows = X.retail_events(spark, sf_dir).withColumns({
        "price": F.when(broken, "n/a").otherwise(F.col("price").cast("string")),
        "user_id": F.col("user_id").cast("string"),
    })
    rows.drop("src_id", "event_date", "value").write.parquet(path)
    return path


def silver_rows(spark: SparkSession, path: str) -> DataFrame:
    """The silver table with its partition columns as text, whatever the session infers."""
    found = spark.read.parquet(path).schema
    kinds = {c: T.StringType() for c in schemas.PARTITION_COLUMNS}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])
    return readers.read_table(spark, path, schema).select(*EVENT_COLUMNS, *schemas.PARTITION_COLUMNS)


# --- sources and sinks -------------------------------------------------------

def read_ndjson(spark, sf_dir):
    return readers.read_ndjson(spark, bronze_files(spark, sf_dir), schemas.BRONZE)


def stream_ndjson(spark, sf_dir):
    source, target = bronze_files(spark, sf_dir), files.scratch(spark, "streamed")
    rows = streams.stream_ndjson(spark, source, schemas.BRONZE, max_files=2)
    writer = rows.writeStream.format("parquet").option("path", target)
    streams.run_available(writer, files.scratch(spark, "checkpoint"))
    return spark.read.parquet(target)


def infer_and_pin_schema(spark, sf_dir):
    source, pin = bronze_files(spark, sf_dir), files.scratch(spark, "schema")
    streams.infer_and_pin_schema(spark, source, pin)
    return readers.read_ndjson(spark, source, streams.infer_and_pin_schema(spark, source, pin))


def read_table(spark, sf_dir):
    rows = readers.read_table(spark, f"{sf_dir}/events.parquet")
    return rows.select("event_id", "user_id", "event_type", "value", "props")


def scan_table(spark, sf_dir):
    gold.daily_active_users(X.retail_events(spark, sf_dir)).createOrReplaceTempView("gold_dau_view")
    return readers.scan_table(spark, "gold_dau_view")


def load_staged(spark, sf_dir):
    loaded = readers.load_staged(
        spark, staged_files(spark, sf_dir), schemas.STAGED_CASTS["fact_events"], loaded_at=CLOCK
    )
    return loaded.drop("loaded_at")


def stream_load(spark, sf_dir):
    target = files.scratch(spark, "fact")
    streams.stream_load(
        spark, staged_files(spark, sf_dir), target, files.scratch(spark, "checkpoint"),
        schemas.STAGED_CASTS["fact_events"],
    )
    return spark.read.parquet(target)


def read_hwm(spark, sf_dir):
    path = files.scratch(spark, "mark")
    days = X.retail_events(spark, sf_dir)
    first = writers.read_hwm(spark, path)
    mark = days.agg(F.max("event_date").cast("string")).first()[0]
    writers.write_hwm(spark, path, "2024-01-02", CLOCK)
    writers.write_hwm(spark, path, mark, CLOCK + timedelta(days=1))
    return days.agg(F.count("*").alias("events")).select(
        F.lit(first).alias("before"), F.lit(writers.read_hwm(spark, path)).alias("after"), "events"
    )


def write_partitions(spark, sf_dir):
    path = silver_table(spark, sf_dir)
    late = X.retail_bronze(spark, sf_dir).filter(F.col("event_date") >= "2024-01-20")
    fixed = silver.dedup(late, ["event_id"], "ingestion_timestamp", keep="last").drop("src_id", "value")
    writers.write_partitions(silver.add_partitions(fixed), path, schemas.PARTITION_COLUMNS)
    return silver_rows(spark, path)


def append_ndjson(spark, sf_dir):
    path, events = files.scratch(spark, "appended"), X.retail_events(spark, sf_dir)
    shopping = F.col("price").isNotNull()
    for part in (events.filter(shopping), events.filter(~shopping)):
        writers.append_ndjson(wire_rows(part), path, "event_time")
    return readers.read_ndjson(spark, path, schemas.BRONZE).select(*EVENT_COLUMNS)


def append_table(spark, sf_dir):
    path = files.scratch(spark, "dead")
    rejected = X.quarantine(spark, sf_dir).drop("src_id")
    writers.append_table(quality.dead_letter(rejected, CLOCK), path)
    writers.append_table(quality.dead_letter(rejected, CLOCK + timedelta(days=1)), path)
    return spark.read.parquet(path).groupBy("rejection_reason").agg(
        F.count("*").alias("rows"), F.count_distinct("dead_lettered_at").alias("runs")
    )


def export_table(spark, sf_dir):
    path, revenue = files.scratch(spark, "export"), gold.daily_revenue(X.retail_events(spark, sf_dir))
    for _ in range(2):
        writers.export_table(revenue, "orc", {"path": path})
    return spark.read.orc(path)


def revenue_before_and_after(spark, sf_dir):
    before = X.retail_events(spark, sf_dir).filter(F.col("event_date") < "2024-01-16")
    after = X.retail_bronze(spark, sf_dir).filter(F.col("event_date") >= "2024-01-10")
    return gold.daily_revenue(before), gold.daily_revenue(after)


def upsert(spark, sf_dir):
    return merge.upsert(*revenue_before_and_after(spark, sf_dir), ["event_date"])


def upsert_cols(spark, sf_dir):
    events = X.retail_events(spark, sf_dir)
    old = dims.dim_users(events.filter(F.col("event_date") < "2024-01-16"))
    new = dims.dim_users(events.filter(F.col("event_date") >= "2024-01-10"))
    changing = [c for c in new.columns if c not in ("user_id", "first_seen")]
    return merge.upsert_cols(old, new, ["user_id"], changing)


def upsert_path(spark, sf_dir):
    path = files.scratch(spark, "gold")
    for part in revenue_before_and_after(spark, sf_dir):
        writers.upsert_path(spark, path, part, ["event_date"])
    return spark.read.parquet(path)


def list_files(spark, sf_dir):
    found = files.list_files(spark, sf_dir, "*.parquet")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length")


def append_evolving(spark, sf_dir):
    events = X.retail_events(spark, sf_dir).select(*EVENT_COLUMNS, "event_date")
    old = events.filter(F.col("event_date") < "2024-01-16")
    new = events.filter(F.col("event_date") >= "2024-01-16").withColumn(
        "session_id", F.concat(F.lit("sess-"), F.col("user_id").cast("string"))
    )
    return merge.append_evolving(old, new, merge_schema=True)


def compact(spark, sf_dir):
    path = silver_table(spark, sf_dir)
    writers.compact(spark, path, 4, cluster_cols=("user_id",), cols=schemas.PARTITION_COLUMNS)
    return silver_rows(spark, path)


def as_of(spark, sf_dir):
    known = merge.as_of(X.retail_bronze(spark, sf_dir), "ingestion_timestamp", "2024-01-20 12:00:00")
    return known.agg(F.count("*").alias("row_count_before_incident"))


def restore(spark, sf_dir):
    rows = merge.restore(
        X.retail_bronze(spark, sf_dir), ["event_id"], "ingestion_timestamp", "2024-01-20 12:00:00"
    )
    return rows.select(*EVENT_COLUMNS, "ingestion_timestamp")


def change_feed(spark, sf_dir):
    bronze = X.retail_bronze(spark, sf_dir)
    columns = [*EVENT_COLUMNS, "event_date"]
    old = silver.dedup(bronze, ["event_id"], "ingestion_timestamp", keep="first")
    new = silver.dedup(bronze, ["event_id"], "ingestion_timestamp", keep="last")
    return merge.change_feed(
        old.filter(F.col("event_date") < "2024-01-28").select(*columns),
        new.filter(F.col("country") != "KR").select(*columns), ["event_id"],
    )


def date_spine(spark, sf_dir):
    events = X.retail_events(spark, sf_dir)
    bought = gold.daily_revenue(events).select(F.col("event_date").alias("date_key"), "purchase_count")
    return dims.spine_over(events, "event_date").join(bought, "date_key", "left")


def literal_rows(spark, sf_dir):
    base = X.retail_events(spark, sf_dir).select(*EVENT_COLUMNS)
    schema = schemas.columns(
        event_id="string", user_id="int", event_type="string", product_id="int", price="money",
        device="string", country="string", session_id="string",
    )
    rows = [
        ("added-row-a", 880001, "logout", None, None, "tablet", "MY", "visit-7"),
        ("added-row-b", 880002, "add_to_cart", 905, Decimal("3.50"), "mobile", "TH", "visit-8"),
        ("added-row-c", 880003, "login", None, None, "desktop", "SG", None),
    ]
    return merge.append_evolving(base, spark.createDataFrame(rows, schema), merge_schema=True)


def insert_missing(spark, sf_dir):
    known = X.user_regions(spark, sf_dir)
    seen = X.retail_events(spark, sf_dir).select("user_id", F.lit("UNKNOWN").alias("region")).distinct()
    return merge.insert_missing(known, seen, "user_id")


def refresh_if_stale(spark, sf_dir):
    path, events = files.scratch(spark, "derived"), X.retail_events(spark, sf_dir)
    lag, early = timedelta(hours=1), events.filter(F.col("event_date") < "2024-01-16")
    built = [
        writers.refresh_if_stale(spark, path, lambda: gold.daily_active_users(early), lag, CLOCK),
        writers.refresh_if_stale(
            spark, path, lambda: gold.daily_active_users(events), lag, CLOCK + timedelta(minutes=30)),
        writers.refresh_if_stale(
            spark, path, lambda: gold.daily_active_users(events), lag, CLOCK + timedelta(hours=2)),
    ]
    return spark.read.parquet(path).drop("loaded_at").withColumn("rebuilds", F.lit(sum(built)))


# --- ingestion quality -------------------------------------------------------

def checked(spark, sf_dir):
    return ingest.with_rejection_reason(X.retail_raw(spark, sf_dir), X.NOW)


def decode_payload(spark, sf_dir):
    """Payloads as base64, those of tablet users cut short so they no longer decode to JSON."""
    e = X.retail_raw(spark, sf_dir, "device")
    data = F.when(F.col("device") == "tablet", F.lit("%%%")).otherwise(F.base64(F.encode("payload", "utf-8")))
    decoded = ingest.parse_payload(ingest.decode_payload(e.select("src_id", data.alias("data"))))
    return decoded.select(
        "src_id", F.col("record").isNotNull().alias("is_json"),
        F.try_variant_get("record", "$.event_id", "string").alias("event_id"),
    )


def family(name):
    def run(spark, sf_dir):
        return ingest.check_family(X.retail_raw(spark, sf_dir), name, X.NOW).select("src_id", "reason")

    return run


def with_rejection_reason(spark, sf_dir):
    return checked(spark, sf_dir).select("src_id", "rejection_reason")


def enrich(spark, sf_dir):
    valid = checked(spark, sf_dir).filter(F.col("rejection_reason").isNull())
    return ingest.enrich(valid.select("src_id"), X.INGESTED)


def route(spark, sf_dir):
    valid, bad, broken = ingest.route(checked(spark, sf_dir), X.INGESTED)
    columns = ["event_id", "event_time", *EVENT_COLUMNS[1:]]
    return (
        valid.select(*columns, F.lit("bronze").alias("route"))
        .unionByName(bad.select(*columns, F.lit("quarantine").alias("route")))
    )


def ingest_summary(spark, sf_dir):
    return ingest.ingest_summary(checked(spark, sf_dir))


RULES = {
    "valid_event_id": "event_id IS NOT NULL", "valid_price": "price >= 5",
    "known_product": "product_id IS NOT NULL",
}


def expect_or_drop(spark, sf_dir):
    return quality.expect_or_drop(X.retail_events(spark, sf_dir), RULES).select(*EVENT_COLUMNS)


def expectation_counts(spark, sf_dir):
    return quality.expectation_counts(X.retail_events(spark, sf_dir), RULES)


QUARANTINE_OUT = ["src_id", "event_id", "event_time", *EVENT_COLUMNS[1:]]


def classify(spark, sf_dir):
    return quality.classify(X.quarantine(spark, sf_dir)).select("src_id", "rejection_reason", "is_repairable")


def repair_price(spark, sf_dir):
    return quality.repair_price(X.quarantine(spark, sf_dir)).select(*QUARANTINE_OUT)


def repair_time(spark, sf_dir):
    return quality.repair_time(X.quarantine(spark, sf_dir)).select(*QUARANTINE_OUT)


def recovered(spark, sf_dir):
    return quality.recovered(X.quarantine(spark, sf_dir)).select(*QUARANTINE_OUT)


def dead_letter(spark, sf_dir):
    return quality.dead_letter(X.quarantine(spark, sf_dir), CLOCK).select(
        *QUARANTINE_OUT, "rejection_reason", "dead_lettered_at"
    )


def reason_breakdown(spark, sf_dir):
    return quality.reason_breakdown(X.quarantine(spark, sf_dir))


def recovery_summary(spark, sf_dir):
    return quality.recovery_summary(X.quarantine(spark, sf_dir))


def quarantine_trend(spark, sf_dir):
    raw = ingest.with_rejection_reason(X.retail_raw(spark, sf_dir, "event_date"), X.NOW)
    return quality.quarantine_trend(raw.filter(F.col("rejection_reason").isNotNull()))


# --- silver ------------------------------------------------------------------

def cast_types(spark, sf_dir):
    text = wire_rows(X.retail_events(spark, sf_dir))
    broken = F.when(F.col("device") == "tablet", "soon").otherwise(F.col("ingestion_timestamp"))
    return silver.cast_types(text.withColumn("ingestion_timestamp", broken)).select(
        "event_id", "event_time", "ingestion_timestamp"
    )


def duplicate_keys(spark, sf_dir):
    return silver.duplicate_keys(X.retail_bronze(spark, sf_dir), "event_id")


def dedup(spark, sf_dir):
    rows = silver.dedup(X.retail_bronze(spark, sf_dir), ["event_id"], "ingestion_timestamp", keep="first")
    return rows.select(*EVENT_COLUMNS, "ingestion_timestamp")


def apply_changes(spark, sf_dir):
    bronze = X.retail_bronze(spark, sf_dir)
    first_days = F.col("event_date") < "2024-01-16"
    target = silver.dedup(bronze.filter(first_days), ["event_id"], "ingestion_timestamp", keep="first")
    rows = silver.apply_changes(
        target, bronze.filter(F.col("event_date") >= "2024-01-10"), ["event_id"], "ingestion_timestamp",
        except_cols=["src_id"], delete_when="event_type = 'logout' AND country = 'KR'",
    )
    return rows.select(*EVENT_COLUMNS, "ingestion_timestamp")


def silver_changes(spark, sf_dir):
    """Both copies of every event as typed silver rows; some of the later ones stand for deletes."""
    rows = X.retail_bronze(spark, sf_dir).withColumn("price", F.col("price").cast("double"))
    return silver.add_partitions(rows.drop("event_date", "value"))


DELETES = "device = 'tablet' AND src_id % 50 = 0"


def apply_changes_with_deletes(spark, sf_dir):
    """Deletes arrive before the rows they delete, and one batch twice."""
    path, rows = files.scratch(spark, "silver"), silver_changes(spark, sf_dir)
    late, odd = F.col("device") == "tablet", F.col("src_id") % 2 == 1
    for part in (late, ~late & odd, ~late & ~odd, ~late & odd):
        writers.apply_changes_path(
            spark, path, rows.filter(part), ["event_id"], "ingestion_timestamp", schemas.PARTITION_COLUMNS,
            delete_when=DELETES, except_cols=["src_id"])
    return spark.read.parquet(path).select(*EVENT_COLUMNS, "ingestion_timestamp")


def deletes_in_memory(spark, sf_dir):
    """The same with both states carried from call to call, the last batch first."""
    rows = silver_changes(spark, sf_dir)
    state, gone = None, None
    for day in (21, 11, 1):
        batch = rows.filter((F.dayofmonth("event_time") >= day) & (F.dayofmonth("event_time") < day + (10 if day < 21 else 99)))
        state, gone = silver.apply_changes_with_deletes(
            state, gone, batch, ["event_id"], "ingestion_timestamp", DELETES, except_cols=["src_id"])
    return state.select(*EVENT_COLUMNS, "ingestion_timestamp").withColumn("is_deleted", F.lit(False)).unionByName(
        gone.withColumn("is_deleted", F.lit(True)), allowMissingColumns=True)


def upsert_bucketed(spark, sf_dir):
    path = files.scratch(spark, "dealt")
    for part in revenue_before_and_after(spark, sf_dir):
        writers.upsert_bucketed(spark, path, part, ["event_date"], 8)
    return writers.read_bucketed(spark, path)


def three_versions(spark, sf_dir):
    """A silver table whose history holds first copies, then later copies and new days, then a day without one country."""
    path = files.scratch(spark, "versions")
    bronze = X.retail_bronze(spark, sf_dir).drop("src_id", "value")
    first = silver.add_partitions(silver.dedup(bronze, ["event_id"], "ingestion_timestamp", keep="first"))
    last = silver.add_partitions(silver.dedup(bronze, ["event_id"], "ingestion_timestamp", keep="last"))
    writers.write_partitions(first.filter(F.col("event_date") < "2024-01-28"), path, schemas.PARTITION_COLUMNS)
    changes.keep_history(spark, path)
    writers.upsert_path(spark, path, last.filter(F.col("event_date") >= "2024-01-10"), ["event_id"], schemas.PARTITION_COLUMNS)
    fifth = first.filter((F.col("event_date") == "2024-01-05") & (F.col("country") != "KR"))
    writers.write_partitions(fifth, path, schemas.PARTITION_COLUMNS)
    return path, first.schema


def version_feed(spark, sf_dir):
    path, schema = three_versions(spark, sf_dir)
    feed = changes.version_feed(spark, path, ["event_id"], 1, 3, schema)
    return feed.select(*EVENT_COLUMNS, "_change_type")


def read_version(spark, sf_dir):
    path, schema = three_versions(spark, sf_dir)
    rows = [changes.read_version(spark, path, schemas.PARTITION_COLUMNS, v, schema).groupBy("event_date", "device").agg(
        F.count("*").alias("events")).withColumn("version", F.lit(v)) for v in (1, 2, 3)]
    return reduce(DataFrame.unionByName, rows)


def corrected_to_gold(spark, sf_dir):
    """Gold over a silver table whose later days are replaced, then compacted."""
    path, out, mark = (files.scratch(spark, n) for n in ("silver", "gold", "mark"))
    rows = X.retail_bronze(spark, sf_dir).withColumn("price", F.col("price").cast("double"))
    for keep, since in (("first", "2024-01-01"), ("last", "2024-01-20")):
        part = silver.dedup(rows.filter(F.col("event_date") >= since), ["event_id"], "ingestion_timestamp", keep=keep)
        part = part.withColumns({c: F.col(c).cast("timestamp") for c in ("event_time", "ingestion_timestamp")})
        writers.write_partitions(silver.add_partitions(part.drop("src_id", "event_date", "value")), path, schemas.PARTITION_COLUMNS)
        jobs.run_gold(spark, path, out, mark, CLOCK)
        writers.compact(spark, path, 4, ("user_id",), schemas.PARTITION_COLUMNS)
    again = jobs.run_gold(spark, path, out, mark, CLOCK)
    return spark.read.parquet(f"{out}/gold_events_by_device").drop("processing_timestamp").withColumn("ran_after_compaction", F.lit(again))


def stream_to_silver(spark, sf_dir):
    """Bronze files in two deliveries, the second repeating part of the first."""
    landing, target = files.scratch(spark, "landing"), files.scratch(spark, "silver")
    checkpoint = files.scratch(spark, "checkpoint")
    rows = wire_rows(X.retail_bronze(spark, sf_dir))
    first, second = rows.filter(F.col("device") != "tablet"), rows.filter(F.col("device") != "mobile")
    for delivery in (first, second):
        delivery.write.mode("append").json(landing)
        streams.stream_to_silver(spark, landing, target, checkpoint)
    return spark.read.parquet(target).select(*EVENT_COLUMNS, "event_time", "ingestion_timestamp")


def add_partitions(spark, sf_dir):
    return silver.add_partitions(X.retail_events(spark, sf_dir)).select("event_id", "year", "month", "day")


def event_distribution(spark, sf_dir):
    return silver.event_distribution(X.retail_bronze(spark, sf_dir))


def distinct_partitions(spark, sf_dir):
    return silver.distinct_partitions(silver.add_partitions(X.retail_events(spark, sf_dir)))


def reconcile(spark, sf_dir):
    bronze = X.retail_bronze(spark, sf_dir)
    return silver.reconcile(bronze, silver.dedup(bronze, ["event_id"], "ingestion_timestamp"))


def to_fact(spark, sf_dir):
    return silver.to_fact(X.retail_events(spark, sf_dir).withColumn("price", F.col("price").cast("double")))


def bronze_to_silver(spark, sf_dir):
    path = files.scratch(spark, "silver")
    rows = jobs.bronze_to_silver(spark, bronze_files(spark, sf_dir), path)
    return rows.select(*EVENT_COLUMNS, "event_time", "ingestion_timestamp", "year", "month", "day")


def stream_route(spark, sf_dir):
    """Raw lines through the streaming router; the result is what landed where."""
    source = files.scratch(spark, "raw")
    out = {n: files.scratch(spark, n) for n in ("bronze", "quarantine", "unparseable")}
    X.retail_raw(spark, sf_dir).select("payload").write.text(source)
    streams.stream_route(
        spark, source, out["bronze"], out["quarantine"], out["unparseable"],
        files.scratch(spark, "checkpoint"), CLOCK.replace(year=2026, month=12), max_files=2,
    )
    valid = spark.read.schema(schemas.BRONZE).json(out["bronze"]).select(
        "event_id", F.lit("bronze").alias("route"), F.lit(None).cast("string").alias("rejection_reason"))
    bad = spark.read.schema(schemas.QUARANTINE).json(out["quarantine"]).select(
        "event_id", F.lit("quarantine").alias("route"), "rejection_reason")
    return valid.unionByName(bad)


def recover_quarantine(spark, sf_dir):
    """The recovery job end to end; rows it wrote, per destination and event type."""
    src, bronze, dead, mark = (files.scratch(spark, n) for n in ("quarantine", "bronze", "dead", "mark"))
    writers.append_ndjson(X.quarantine(spark, sf_dir).drop("src_id"), src, "_quarantine_timestamp")
    jobs.recover_quarantine(spark, src, bronze, dead, mark, CLOCK)
    back = spark.read.schema(schemas.BRONZE).json(bronze).select("event_type", F.lit("bronze").alias("route"))
    lost = spark.read.parquet(dead).select("event_type", F.lit("dead_letter").alias("route"))
    return back.unionByName(lost).groupBy("route", "event_type").agg(F.count("*").alias("rows"))


# --- gold and dimensions -----------------------------------------------------

def over_events(build):
    return lambda spark, sf_dir: build(X.retail_events(spark, sf_dir))


def since_hwm(spark, sf_dir):
    table = readers.read_table(
        spark, silver_table(spark, sf_dir),
        schemas.columns(
            event_id="string", event_time="timestamp_ntz", user_id="int", event_type="string",
            year="string", month="string", day="string",
        ),
    )
    return gold.since_hwm(table, "2024-01-20").drop("year", "month", "day")


def gold_frames(spark, sf_dir):
    events = X.retail_events(spark, sf_dir)
    return {name: table.build(events) for name, table in gold.GOLD_TABLES.items()}


def row_counts(spark, sf_dir):
    events = X.retail_events(spark, sf_dir)
    tables = gold_frames(spark, sf_dir)
    tables["dim_users"] = events.select("user_id").distinct()
    tables["fact_events"] = events
    return gold.row_counts(tables)


def dim_date(spark, sf_dir):
    """The calendar of two years, with how many events fell on each day."""
    daily = gold.daily_active_users(X.retail_events(spark, sf_dir)).select(
        F.col("event_date").alias("date_key"), "total_events"
    )
    return dims.dim_date(spark).join(daily, "date_key", "left")


def run_gold(spark, sf_dir):
    """Two incremental runs over a growing silver table; the product table after both."""
    table, out = files.scratch(spark, "silver"), files.scratch(spark, "gold")
    mark = files.scratch(spark, "mark")
    rows = silver.dedup(X.retail_bronze(spark, sf_dir), ["event_id"], "ingestion_timestamp")
    rows = silver.add_partitions(rows.withColumns({
        c: F.col(c).cast("timestamp") for c in ("event_time", "ingestion_timestamp")
    }).withColumn("price", F.col("price").cast("double")).drop("src_id", "event_date", "value"))
    cut = F.lit("2024-01-15 12:00:00").cast("timestamp")
    for i, part in enumerate((F.col("ingestion_timestamp") <= cut, F.col("ingestion_timestamp") > cut)):
        writers.upsert_path(spark, table, rows.filter(part), ["event_id"], schemas.PARTITION_COLUMNS, fixed_partition=True)
        jobs.run_gold(spark, table, out, mark, CLOCK + timedelta(days=i))
    return spark.read.parquet(f"{out}/gold_top_products").drop("processing_timestamp")


RECOVERED_AT = CLOCK + timedelta(days=3)


def recovered_to_gold(spark, sf_dir):
    """Route, silver, gold, recovery, silver, gold; all five daily tables as one."""
    bronze, bad, dead, table, out, mark, seen = (
        files.scratch(spark, n) for n in ("bronze", "quarantine", "dead", "silver", "gold", "mark", "seen"))
    # Checked once and kept for both writes, without what neither needs: the VARIANT and the texts.
    checked = ingest.with_rejection_reason(X.retail_raw(spark, sf_dir), X.NOW).select(
        "event", F.lit(None).cast("string").alias("payload"), "rejection_reason").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        valid, quarantined, _ = ingest.route(checked, X.INGESTED)
        stamp = ingest.as_instant(X.INGESTED)
        writers.append_ndjson(valid.withColumn("_at", stamp), bronze, "_at")
        writers.append_ndjson(quarantined.drop("payload").withColumn("_at", stamp), bad, "_at")
    finally:
        checked.unpersist()
    for again in (False, True):
        if again:
            jobs.recover_quarantine(spark, bad, bronze, dead, seen, RECOVERED_AT)
        jobs.bronze_to_silver(spark, bronze, table)
        jobs.run_gold(spark, table, out, mark, RECOVERED_AT)
    shape = {
        "gold_daily_active_users": ("''", "total_events", "daily_active_users", "NULL"),
        "gold_conversion_funnel": ("''", "viewers", "cart_adders", "NULL"),
        "gold_daily_revenue": ("''", "purchase_count", "purchase_count", "total_revenue"),
        "gold_top_products": ("string(product_id)", "total_interactions", "unique_users", "revenue"),
        "gold_events_by_device": ("device", "event_count", "unique_users", "revenue"),
    }
    parts = [spark.read.parquet(f"{out}/{name}").selectExpr(
        f"'{name}' AS table_name", "string(event_date) AS event_date", f"{k} AS item", f"bigint({a}) AS first_count",
        f"bigint({b}) AS second_count", f"double({c}) AS amount") for name, (k, a, b, c) in shape.items()]
    return reduce(lambda x, y: x.unionByName(y), parts)


def silver_expectations(spark, sf_dir):
    """Passed and failed rows per silver rule, every seventh time unreadable, some ids missing."""
    path = files.scratch(spark, "bronze")
    rows = X.retail_bronze(spark, sf_dir).withColumns({
        "event_time": F.when(F.col("src_id") % 7 == 0, "2031-44-55T66:77:88").otherwise(X.zulu("event_time")),
        "ingestion_timestamp": X.zulu("ingestion_timestamp"),
        "event_id": F.when(F.col("src_id") % 11 != 0, F.col("event_id"))})
    writers.append_ndjson(rows.drop("src_id", "value", "event_date").withColumn("_at", ingest.as_instant(X.INGESTED)), path, "_at")
    return jobs.silver_expectations(spark, path)


# --- analyst queries ---------------------------------------------------------

def weekday_sales(spark, sf_dir):
    return A.weekday_sales(X.retail_events(spark, sf_dir), dims.dim_date(spark))


def kpi_join(spark, sf_dir):
    events = X.retail_events(spark, sf_dir)
    return A.kpi_join(gold.daily_revenue(events), gold.daily_active_users(events), 10)


def revenue_anomalies(spark, sf_dir):
    series = A.revenue_series(gold.daily_revenue(X.retail_events(spark, sf_dir)))
    scored = A.revenue_anomalies(series, window=7, k=1.5)
    bounds = ["forecast", "lower_bound", "upper_bound"]
    return scored.select("ts", "y", *[F.round(c, 4).alias(c) for c in bounds], "is_anomaly")


def seasonal_anomalies(spark, sf_dir):
    """A model of the first three weeks, applied to the days after them."""
    series = A.revenue_series(gold.daily_revenue(X.retail_events(spark, sf_dir)))
    scored = A.detect_season(series, A.fit_season(series, "2024-01-21"), k=1.0, after="2024-01-21")
    bounds = ["forecast", "lower_bound", "upper_bound"]
    return scored.select("ts", "y", *[F.round(c, 3).alias(c) for c in bounds], "is_anomaly")


# --- governance --------------------------------------------------------------

def mask_column(spark, sf_dir):
    rows = X.retail_events(spark, sf_dir).select("event_id", "country")
    return A_and_B(
        governance.mask_column(rows, "country", "BI_ANALYST_ROLE", ["ACCOUNTADMIN", "BI_ANALYST_ROLE"]),
        governance.mask_column(rows, "country", "MARKETING_ROLE", ["ACCOUNTADMIN", "BI_ANALYST_ROLE"]),
    )


def A_and_B(privileged: DataFrame, other: DataFrame) -> DataFrame:
    """The same view as two roles see it."""
    return privileged.withColumn("seen_by", F.lit("analyst")).unionByName(
        other.withColumn("seen_by", F.lit("marketing"))
    )


def hash_mask(spark, sf_dir):
    users = dims.dim_users(X.retail_events(spark, sf_dir)).select(
        "user_id", "primary_device", "primary_country"
    )
    cols, allowed = ["primary_device", "primary_country"], ["ACCOUNTADMIN", "BI_ANALYST_ROLE"]
    return A_and_B(
        governance.hash_mask(users, cols, "BI_ANALYST_ROLE", allowed),
        governance.hash_mask(users, cols, "MARKETING_ROLE", allowed),
    )


def mask_user_id(spark, sf_dir):
    governance.register_mask_user_id(spark)
    X.retail_events(spark, sf_dir).createOrReplaceTempView("retail_events_view")
    return spark.sql("""
        SELECT event_id, mask_user_id(CAST(user_id AS STRING), array('data_engineers')) AS engineer_sees,
               mask_user_id(CAST(user_id AS STRING), array('data_analysts')) AS analyst_sees
        FROM retail_events_view""")


def row_security(spark, sf_dir):
    grants = spark.createDataFrame(
        [("ana", "BR"), ("ana", "AU"), ("ben", "JP"), ("chief", "ALL")],
        "user_name STRING, country_code STRING",
    )
    events = X.retail_events(spark, sf_dir).select("event_id", "country")
    seen = None
    for user, role in (("ana", "BI"), ("ben", "BI"), ("chief", "BI"),
                       ("nobody", "BI"), ("root", "ACCOUNTADMIN")):
        rows = governance.row_security(events, grants, user, role).groupBy("country").agg(
            F.count("*").alias("rows")).withColumn("viewer", F.lit(user))
        seen = rows if seen is None else seen.unionByName(rows)
    return seen


# --- operational logs --------------------------------------------------------

LOG_AS_OF = "2001-08-02 00:00:00"


def over_log(build):
    return lambda spark, sf_dir: build(X.component_log(spark, sf_dir))


def latency_by_bin(spark, sf_dir):
    report = oplogs.latency_by_bin(X.component_log(spark, sf_dir), "6 hours")
    return report.select(
        "bin_start", F.round("avg_ms", 6).alias("avg_ms"), "max_ms", "records",
        F.round("p95_ms", 6).alias("p95_ms"),
    )


def alerts(spark, sf_dir):
    rules = {"width_minutes": 60, "quarantine_pct": 2.0, "sustained_bins": 3, "max_errors": 4,
             "silent_minutes": 20}
    fired = oplogs.alerts(X.component_log(spark, sf_dir), rules, as_of="2024-01-31 00:00:00")
    return fired.withColumn("metric", F.round("metric", 6))


def freshness(spark, sf_dir):
    meta = X.retail_events(spark, sf_dir).groupBy(
        F.concat(F.lit("gold.product_"), F.col("product_id").cast("string")).alias("table_name")
    ).agg(
        F.max("event_time").alias("last_modified"), F.sum("src_id").alias("size_in_bytes"),
        F.count("*").alias("num_files"),
    ).filter(F.col("table_name").isNotNull())
    return oplogs.freshness(meta, "2024-01-31 00:00:00")


def layout_health(spark, sf_dir):
    """Overlap of the user id ranges of the days, by the ranges that the footers give."""
    path = silver_table(spark, sf_dir)
    return oplogs.layout_health(oplogs.footer_ranges(spark, path, schemas.PARTITION_COLUMNS, "user_id"))


def footer_ranges(spark, sf_dir):
    return oplogs.footer_ranges(spark, silver_table(spark, sf_dir), schemas.PARTITION_COLUMNS, "product_id")


def compact_on_curve(spark, sf_dir):
    """Files along a curve of two columns: the rows stay, and a range of the second meets fewer files than in plain order."""
    depth, path = [], ""
    for curve in (False, True):
        path = files.scratch(spark, "clustered")
        X.retail_events(spark, sf_dir).select(*EVENT_COLUMNS).write.parquet(path)
        writers.compact(spark, path, 16, ("user_id", "event_id"), curve=curve)
        ranges = oplogs.file_ranges(spark.read.parquet(path), "event_id")
        depth.append(oplogs.layout_health(ranges).first().average_depth)
    return spark.read.parquet(path).withColumn("fewer_files", F.lit(depth[1] < depth[0]))


def refresh_state(spark, sf_dir):
    """State and folded tables after a first load, later copies of some days, and a day without one country."""
    path, base, mark = (files.scratch(spark, n) for n in ("silver", "state", "mark"))
    rows = X.retail_bronze(spark, sf_dir).withColumn("price", F.col("price").cast("double")).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("event_time", "ingestion_timestamp")}).drop("src_id", "value")
    first, last = (silver.add_partitions(silver.dedup(rows, ["event_id"], "ingestion_timestamp", keep=k)) for k in ("first", "last"))
    steps = (first.filter(F.col("event_date") < "2024-01-28"), last.filter(F.col("event_date") >= "2024-01-20"),
             first.filter((F.col("event_date") == "2024-01-05") & (F.col("country") != "KR")))
    for i, step in enumerate(steps):
        writers.write_partitions(step.drop("event_date"), path, schemas.PARTITION_COLUMNS)
        jobs.refresh_state(spark, path, base, mark, CLOCK + timedelta(days=i))

    def figures(name, day, item):
        return spark.read.parquet(f"{base}/{name}").select(
            F.lit(name).alias("name"), F.col(day).cast("string").alias("day"), item.cast("string").alias("item"),
            "users", "viewers", "purchasers", "events", "purchases", "revenue")

    return reduce(DataFrame.unionByName, [
        figures("daily_all", "event_date", F.lit("")), figures("weekly_all", "period", F.lit("")),
        figures("daily_device", "event_date", F.col("device")), figures("weekly_device", "period", F.col("device")),
        figures("weekly_product", "period", F.col("product_id"))])


def run_expectations(spark, sf_dir):
    """What a bronze-to-silver run itself reports of its expectations, read from its event log."""
    bronze, log = files.scratch(spark, "bronze"), files.scratch(spark, "log")
    broken = {"event_id": F.when(F.col("device") != "tablet", F.col("event_id")),
              "event_time": F.when(F.col("country") == "KR", F.lit("soon")).otherwise(F.col("event_time"))}
    wire_rows(X.retail_bronze(spark, sf_dir)).withColumns(broken).write.json(bronze)
    jobs.bronze_to_silver(spark, bronze, files.scratch(spark, "silver"), now=CLOCK, log=log)
    return oplogs.expectation_report(spark.read.parquet(log))


def export_gold(spark, sf_dir):
    """Every gold table that a run has made, handed to another format twice; rows per table and day."""
    path, out, target, mark = (files.scratch(spark, n) for n in ("silver", "gold", "export", "mark"))
    rows = X.retail_events(spark, sf_dir).withColumn("price", F.col("price").cast("double")).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("event_time", "ingestion_timestamp")})
    writers.write_partitions(silver.add_partitions(rows.drop("src_id", "event_date", "value")), path, schemas.PARTITION_COLUMNS)
    jobs.run_gold(spark, path, out, mark, CLOCK)
    for _ in range(2):
        jobs.export_gold(spark, out, "orc", lambda name: {"path": f"{target}/{name}"})
    return reduce(DataFrame.unionByName, [
        spark.read.orc(f"{target}/{name}").groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
            F.count("*").alias("exported")).withColumn("name", F.lit(name)) for name in gold.GOLD_TABLES])


def stream_status_by_bin(spark, sf_dir):
    source, target = files.scratch(spark, "log"), files.scratch(spark, "bins")
    X.component_log(spark, sf_dir).write.parquet(source)
    schema = spark.read.parquet(source).schema
    bins = streams.stream_status_by_bin(spark.readStream.schema(schema).parquet(source), "1 hour")
    writer = bins.writeStream.format("parquet").option("path", target).outputMode("append")
    streams.run_available(writer, files.scratch(spark, "checkpoint"))
    return spark.read.parquet(target)


def stream_alerts(spark, sf_dir):
    """The log arrives in two parts; the second run goes on from the first one's checkpoint."""
    source, target, checkpoint = (files.scratch(spark, name) for name in ("log", "alerts", "checkpoint"))
    log = X.component_log(spark, sf_dir)
    rules = {"width_minutes": 60, "quarantine_pct": 2.0, "sustained_bins": 3, "max_errors": 4, "silent_minutes": 40}
    for part in ("timestamp < '2024-01-15'", "timestamp >= '2024-01-15'"):
        log.filter(part).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(log.schema).parquet(source)
        fired = streams.stream_alerts(arriving, rules, "30 minutes")
        streams.run_available(fired.writeStream.format("parquet").option("path", target).outputMode("append"), checkpoint)
    return spark.read.parquet(target).withColumn("metric", F.round("metric", 6))


QUERIES = {f.__name__: f for f in (
    read_ndjson, stream_ndjson, infer_and_pin_schema, read_table, scan_table, load_staged, stream_load,
    read_hwm, write_partitions, append_ndjson, append_table, export_table, upsert, upsert_cols,
    upsert_path, list_files, append_evolving, compact, as_of, restore, change_feed, date_spine,
    literal_rows, insert_missing, refresh_if_stale,
    decode_payload, with_rejection_reason, enrich, route, ingest_summary, expect_or_drop,
    expectation_counts, classify, repair_price, repair_time, recovered, dead_letter, reason_breakdown,
    recovery_summary, quarantine_trend,
    cast_types, duplicate_keys, dedup, apply_changes, apply_changes_with_deletes, deletes_in_memory, upsert_bucketed,
    version_feed, read_version, corrected_to_gold, stream_to_silver, add_partitions,
    event_distribution, distinct_partitions, reconcile, to_fact, bronze_to_silver, stream_route,
    recover_quarantine, since_hwm, row_counts, dim_date, run_gold, recovered_to_gold, silver_expectations,
    weekday_sales, kpi_join, revenue_anomalies,
    mask_column, hash_mask, mask_user_id, row_security,
    latency_by_bin, alerts, freshness, layout_health, footer_ranges, compact_on_curve, refresh_state, run_expectations,
    export_gold, seasonal_anomalies, stream_status_by_bin, stream_alerts,
)}
QUERIES.update({f"{n}_reason": family(n) for n in ("schema", "type", "enum", "anomaly")})
QUERIES.update({
    "daily_active_users": over_events(gold.daily_active_users),
    "conversion_funnel": over_events(gold.conversion_funnel),
    "daily_revenue": over_events(gold.daily_revenue),
    "product_daily": over_events(gold.product_daily),
    "device_daily": over_events(gold.device_daily),
    "dim_users": over_events(dims.dim_users),
    "dim_products": over_events(dims.dim_products),
    "dau_range": over_events(lambda e: A.dau_range(e, LO, HI)),
    "dau_range_from_gold": over_events(lambda e: A.between_dates(gold.daily_active_users(e), LO, HI)),
    "funnel_range": over_events(lambda e: A.funnel_range(e, LO, HI)),
    "revenue_range": over_events(lambda e: A.revenue_range(e, LO, HI)),
    "top_products": over_events(lambda e: A.top_products(e, 10)),
    "device_share": over_events(A.device_share),
    "duplicate_audit": lambda s, d: A.duplicate_audit(X.retail_bronze(s, d), 20),
    "abandoned_cart": lambda s, d: A.abandoned_cart(X.session_facts(s, d), X.AS_OF, 30),
    "time_to_cart": lambda s, d: A.time_to_cart(X.session_facts(s, d), X.AS_OF, 7),
    "cumulative_revenue": lambda s, d: A.cumulative_revenue(
        X.session_facts(s, d), X.user_regions(s, d), X.AS_OF),
    "orphans": lambda s, d: A.orphans(X.session_facts(s, d), X.user_regions(s, d)),
    "incomplete_sessions": lambda s, d: A.incomplete_sessions(X.session_facts(s, d), 10),
    "last_days": over_events(lambda e: A.last_days(gold.conversion_funnel(e), X.AS_OF, 7)),
    "partner_products": over_events(lambda e: A.partner_products(gold.product_daily(e), "2024-02-15")),
    "run_history": lambda s, d: oplogs.run_history(X.pipeline_log(s, d), 7),
    "expectation_report": lambda s, d: oplogs.expectation_report(X.pipeline_log(s, d)),
    "sla_report": lambda s, d: oplogs.sla_report(X.pipeline_log(s, d)),
    "status_by_bin": over_log(oplogs.status_by_bin),
    "top_reasons": over_log(lambda log: oplogs.top_reasons(log, 10)),
    "throughput": over_log(oplogs.throughput),
    "throttles": over_log(oplogs.throttles),
    "slow_queries": lambda s, d: oplogs.slow_queries(X.query_history(s, d), LOG_AS_OF, 10, hours=720),
    "query_costs": lambda s, d: oplogs.query_costs(X.query_history(s, d), LOG_AS_OF, 20, days=365),
    "credits": lambda s, d: oplogs.credits(X.query_history(s, d), LOG_AS_OF, 2.0, days=70),
    "table_lineage": lambda s, d: oplogs.table_lineage(X.lineage_log(s, d), "shop.gold.gold_daily_revenue"),
    "lineage_map": lambda s, d: oplogs.lineage_map(X.lineage_log(s, d), "shop."),
    "column_lineage": lambda s, d: oplogs.column_lineage(
        X.lineage_log(s, d), "shop.gold.gold_daily_revenue", "total_revenue"),
    "access_audit": lambda s, d: oplogs.access_audit(
        X.audit_log(s, d), "shop.gold.", "2024-01-31 00:00:00"),
    "history_slice": lambda s, d: oplogs.history_slice(
        X.query_history(s, d), "bytes_scanned > 0 AND execution_status = 'SUCCESS'", "start_time"
    ).select("query_id", "start_time", "warehouse_name", "bytes_scanned"),
})


def plain(df: DataFrame) -> DataFrame:
    """Types both engines hand over alike: decimals as doubles, dates as text, times without zone."""
    def same(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)

    return df.select(*[same(f) for f in df.schema.fields])
