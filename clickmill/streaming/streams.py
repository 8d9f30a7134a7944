"""Structured Streaming: file discovery, routing, loading and silver upserts."""

from __future__ import annotations

from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickmill.operators import ingest, oplogs, quality, silver
from clickmill.schemas import BRONZE, PARTITION_COLUMNS
from clickmill.sources import files
from clickmill.sources.readers import cast_staged
from clickmill.sources.writers import append_ndjson, apply_changes_path, upsert_path


def stream_ndjson(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Unbounded JSON-lines input; the query's checkpoint remembers files it has seen."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def infer_and_pin_schema(
    spark: SparkSession, path: str, schema_loc: str, sampling: float = 1.0
) -> T.StructType:
    """Infer column types once and reuse them on every later run."""
    if files.is_table(spark, schema_loc):
        return T.StructType.fromJson(_json(spark.read.text(schema_loc).first()[0]))
    schema = spark.read.option("samplingRatio", sampling).json(path).schema
    pinned = spark.range(1).select(F.lit(schema.json()).alias("value"))
    pinned.coalesce(1).write.mode("overwrite").text(schema_loc)
    return schema


def _json(text: str) -> dict:
    import json

    return json.loads(text)


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, then stop; a failed batch is replayed on the next run."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_load(
    spark: SparkSession, path: str, target: str, checkpoint: str, casts: dict[str, str],
    glob: str = "*.parquet",
) -> StreamingQuery:
    """Load each new staged file exactly once into a columnar table."""
    staged = spark.read.option("pathGlobFilter", glob).parquet(path).schema
    source = spark.readStream.schema(staged).option("pathGlobFilter", glob).parquet(path)
    writer = cast_staged(source, casts).writeStream.format("parquet").option("path", target)
    return run_available(writer.outputMode("append"), checkpoint)


def clean_bronze(bronze: DataFrame) -> DataFrame:
    """Typed, complete bronze rows with their partition columns."""
    return clean_typed(silver.cast_types(bronze))


def clean_typed(typed: DataFrame) -> DataFrame:
    complete = typed.filter(F.col("event_id").isNotNull() & F.col("event_time").isNotNull())
    return silver.add_partitions(complete.drop("processing_date"))


#: What silver expects of a typed row; the name of the first rule that fails is the reason.
SILVER_RULES = {"event_id_missing": "event_id IS NOT NULL", "event_time_unreadable": "event_time IS NOT NULL"}


def refused_bronze(bronze: DataFrame, now: datetime) -> DataFrame:
    """The rows ``clean_bronze`` leaves out as quarantine rows, times as the text they came as."""
    reasons = quality.failure(silver.cast_types(bronze.withColumns(
        {f"_{c}": F.col(c) for c in ("event_time", "ingestion_timestamp")})), SILVER_RULES)
    texts = {c: F.col(f"_{c}") for c in ("event_time", "ingestion_timestamp")}
    stamped = reasons.withColumns({**texts, "_quarantine_timestamp": ingest.iso_text(ingest.as_instant(now))})
    return stamped.drop("_event_time", "_ingestion_timestamp").withColumn("_at", ingest.as_instant(now))


def latest_by_ingestion(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    return silver.apply_changes(target, changes, keys, "ingestion_timestamp")


def stream_to_silver(
    spark: SparkSession, src: str, dst: str, checkpoint: str,
    schema: T.StructType = BRONZE, max_files: int | None = None, fixed_partition: bool = False,
    quarantine: str | None = None, now: datetime | None = None, delete_when: str | None = None,
) -> StreamingQuery:
    """Bronze files to silver, one row per event id, the latest ingestion kept.

    Rows without an id or a readable time go to ``quarantine`` if it is given, stamped ``now``.

    ``foreachBatch`` may replay a batch. The outcome depends on the rows alone,
    not on batch order, so replays and files delivered twice change nothing.
    With ``fixed_partition`` (an event id never changes its day) a batch reads only
    the days it brings; else also the days whose key filter lets one of its ids pass.
    Rows that match ``delete_when`` delete their event, and the delete is remembered.
    """

    def merge_batch(batch: DataFrame, _: int) -> None:
        if quarantine is not None:
            append_ndjson(refused_bronze(batch, now), quarantine, "_at")
        if delete_when is not None:
            apply_changes_path(
                batch.sparkSession, dst, clean_bronze(batch), ["event_id"], "ingestion_timestamp",
                PARTITION_COLUMNS, delete_when, fixed_partition=fixed_partition)
            return
        upsert_path(
            batch.sparkSession, dst, clean_bronze(batch), ["event_id"],
            cols=PARTITION_COLUMNS, merge=latest_by_ingestion, fixed_partition=fixed_partition,
        )

    arriving = stream_ndjson(spark, src, schema, max_files)
    return run_available(arriving.writeStream.foreachBatch(merge_batch), checkpoint)


def stream_route(
    spark: SparkSession, src: str, bronze: str, quarantine: str, unparseable: str,
    checkpoint: str, now: datetime, max_files: int | None = None,
) -> StreamingQuery:
    """Raw JSON text files to bronze, quarantine and undecodable lines.

    Each batch is checked once and kept for its three writes. Appends may repeat
    when a batch is replayed; deduplication by event id takes place in silver.
    """

    def route_batch(batch: DataFrame, _: int) -> None:
        checked = ingest.with_rejection_reason(batch, now).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid, bad, broken = ingest.route(checked, now)
            append_ndjson(valid.withColumn("_at", ingest.as_instant(now)), bronze, "_at")
            append_ndjson(bad.withColumn("_at", ingest.as_instant(now)), quarantine, "_at")
            broken.select("payload").write.mode("append").text(unparseable)
        finally:
            checked.unpersist()

    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(src).select(F.col("value").alias("payload"))
    return run_available(lines.writeStream.foreachBatch(route_batch), checkpoint)


def stream_status_by_bin(
    log: DataFrame, width: str = "5 minutes", lateness: str = "10 minutes",
    component: str = "validator",
) -> DataFrame:
    """The streaming form of the status report: closed bins only, late lines up to ``lateness``."""
    stamped = log.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return oplogs.status_by_bin(stamped.withWatermark("timestamp", lateness), width, component)


def stream_alerts(log: DataFrame, rules: dict | None = None, lateness: str = "10 minutes") -> DataFrame:
    """The alert rules over an arriving log: component, bin_start, alert and metric, each row once.

    Share and errors follow from bins that have closed, runs of bins from windows that slide over
    them; both are of the whole log, with a null component. Silence is the gap that ends a session
    of one component; it fires when the gap has reached its limit, which is its metric, and names
    the bin of the last line. Lines without a time or a component say nothing about silence.
    """
    r = {**oplogs.ALERT_RULES, **(rules or {})}
    width, bins_in_run, silent = r["width_minutes"], r["sustained_bins"], r["silent_minutes"]
    lines = log.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", lateness)
    bins = lines.groupBy(F.window("timestamp", f"{width} minutes").alias("bin")).agg(
        F.count_if(F.col("status").isin("valid", "quarantined")).alias("checked"),
        F.count_if(F.col("status") == "quarantined").alias("quarantined"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )
    share = F.coalesce(F.try_divide(F.col("quarantined") * F.lit(100.0), F.col("checked")), F.lit(0.0))
    runs = bins.groupBy(
        F.window(F.window_time("bin"), f"{bins_in_run * width} minutes", f"{width} minutes").alias("run")
    ).agg(
        F.count("*").alias("bins"), F.min(share).alias("least_share"),
        F.max(F.struct(F.col("bin.start").alias("start"), "errors")).alias("newest"),
    ).withColumn("bin_start", F.col("run.end") - F.expr(f"INTERVAL {width} MINUTES"))
    errors = F.col("newest.errors")
    checks = {
        "high_quarantine_rate": (
            (F.col("bins") == bins_in_run) & (F.col("least_share") > r["quarantine_pct"]), F.col("least_share")),
        "errors": ((F.col("newest.start") == F.col("bin_start")) & (errors > r["max_errors"]), errors.cast("double")),
    }
    fired = F.array_compact(F.array(*[
        F.when(test, F.struct(F.lit(name).alias("alert"), metric.alias("metric")))
        for name, (test, metric) in checks.items()
    ]))
    broken = runs.select(F.lit(None).cast("string").alias("component"), "bin_start", F.inline(fired))
    seconds = 60 * width
    gap = 60_000_000 * silent - 1  # lines exactly the limit apart end a session too
    quiet = lines.filter(F.col("component").isNotNull()).groupBy(
        "component", F.session_window("timestamp", f"{gap} microseconds").alias("session")
    ).agg(F.max("timestamp").alias("tail")).select(
        "component",
        F.timestamp_seconds(F.floor(F.unix_timestamp("tail") / seconds) * seconds).alias("bin_start"),
        F.lit("no_events").alias("alert"), F.lit(float(silent)).alias("metric"),
    )
    return broken.unionByName(quiet)
