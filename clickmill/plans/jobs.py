"""Jobs: the operators joined up into runs that own their input and output paths."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import partial, reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickmill import schemas
from clickmill.operators import dims, gold, ingest, merge, oplogs, quality, silver, state
from clickmill.sources import changes, files, readers, writers
from clickmill.streaming.streams import SILVER_RULES, clean_typed, refused_bronze


def bronze_to_silver(
    spark: SparkSession, bronze: str, dst: str, quarantine: str | None = None, now: datetime | None = None,
    log: str | None = None,
) -> DataFrame:
    """Batch run: type, keep the earliest copy, replace partitions.

    Rows that fail a silver expectation (no event id, no readable time) go to
    ``quarantine`` if it is given, stamped ``now``. With ``log`` the run counts, while it
    writes, how many records pass and fail each expectation, and adds them to that event log.
    """
    raw = readers.read_ndjson(spark, bronze, schemas.BRONZE)
    seen = Observation("expectations")
    watched = quality.observed(silver.cast_types(raw), SILVER_RULES, seen) if log is not None else silver.cast_types(raw)
    unique = silver.dedup(clean_typed(watched), ["event_id"], "ingestion_timestamp", keep="first")
    writers.staged_overwrite(unique, dst, schemas.PARTITION_COLUMNS)
    if log is not None:
        counts = quality.observed_counts(seen.get, SILVER_RULES)
        writers.append_table(oplogs.expectation_events(counts, "events_silver", "events_bronze", now, spark), log)
    if quarantine is not None:
        writers.append_ndjson(refused_bronze(raw, now), quarantine, "_at")
    return readers.read_table(spark, dst, schemas.SILVER)


def silver_expectations(spark: SparkSession, bronze: str) -> DataFrame:
    """Passed and failed bronze rows per rule that silver expects to hold."""
    raw = readers.read_ndjson(spark, bronze, schemas.BRONZE)
    return quality.expectation_counts(silver.cast_types(raw), SILVER_RULES)


def run_gold(spark: SparkSession, silver_path: str, gold_dir: str, hwm_path: str, now: datetime) -> bool:
    """Re-aggregate every event date whose silver partition was replaced since the mark, then move it.

    The mark is a version of the silver table, not a time: each write notes the partitions
    it replaces under the next version, so a late row, a repaired one and one without an
    arrival time bring back their whole day alike, and nothing of the table is read to find
    them. The mark moves only after every table is written; repeating a run rewrites the
    same values. Returns False if no partition changed.
    """
    mark = int(writers.read_hwm(spark, hwm_path, default="0"))
    newest = changes.newest_version(spark, silver_path)
    touched = changes.changed_partitions(spark, silver_path, mark, newest)
    if not touched:
        return False
    events = readers.read_table(spark, silver_path, schemas.SILVER)
    days = events.filter(merge.touched_predicate(schemas.PARTITION_COLUMNS, touched)).select(
        "event_time", "user_id", "event_type", "product_id", "price", "device")
    dates = [date(*map(int, v)) for v in touched if None not in v]
    for name, table in gold.GOLD_TABLES.items():
        fresh = table.build(days).withColumn("processing_timestamp", F.lit(str(now)).cast("timestamp"))
        # the date is part of every key, so a row never changes its partition
        writers.upsert_path(
            spark, f"{gold_dir}/{name}", fresh, table.keys, table.partitions,
            merge=partial(_replace_days, dates=dates), fixed_partition=True,
            also=[(d,) for d in dates] if table.partitions else None,
        )
    writers.write_hwm(spark, hwm_path, str(newest), now)
    return True


def _replace_days(target: DataFrame, source: DataFrame, keys: list[str], dates: list[date]) -> DataFrame:
    """All source rows, plus the target rows of other days."""
    return source.unionByName(target.filter(~F.col("event_date").isin(*dates)) if dates else target)


def recover_quarantine(
    spark: SparkSession, quarantine: str, bronze: str, dead: str, mark_path: str, now: datetime
) -> DataFrame:
    """Repair what can be repaired back into bronze; the rest goes to the dead-letter table.

    Each run takes the rows quarantined at or after the mark that no run has handled:
    stamps have whole seconds and batches share them. Repaired rows carry ``now`` as their
    arrival time, after the time repair has used their own. If a run stops before its rows
    are noted as handled, its dead letters are not written again, and events that reach
    bronze twice are one event in silver.
    """
    mark = writers.read_hwm(spark, mark_path)
    stamp = F.col("_quarantine_timestamp")
    since = stamp.isNull() | (stamp >= mark)
    noted = f"{mark_path.rstrip('/')}__handled"
    rejected = readers.read_ndjson(spark, quarantine, schemas.QUARANTINE).select(*schemas.QUARANTINE.names).filter(since)
    print_of = [F.xxhash64(*schemas.QUARANTINE.names).alias("h1"), F.hash(*schemas.QUARANTINE.names).alias("h2")]
    rejected = rejected.select("*", *print_of)
    if files.is_table(spark, noted):
        known = spark.read.parquet(noted).filter(since).select("h1", "h2").distinct()
        rejected = rejected.join(known, ["h1", "h2"], "left_anti")
    rejected = rejected.persist(StorageLevel.MEMORY_AND_DISK)
    newest = rejected.agg(F.max(stamp)).first()[0]
    rows = rejected.drop("h1", "h2")
    fixed = quality.recovered(rows).drop("_quarantine_timestamp").withColumn(
        "ingestion_timestamp", ingest.iso_text(ingest.as_instant(now)))
    writers.append_ndjson(fixed.withColumn("_at", F.lit(str(now)).cast("timestamp")), bronze, "_at")
    lost = quality.dead_letter(rows, now)
    if files.is_table(spark, dead):
        known = readers.read_table(spark, dead).filter(since)
        same = [lost[c].eqNullSafe(known[c]) for c in schemas.QUARANTINE.names]
        lost = lost.join(known, same, "left_anti")
    writers.append_table(lost, dead)
    summary = quality.recovery_summary(rows)
    # Before the rows are noted as handled: a write refreshes what is kept of its table's readers.
    found = spark.createDataFrame(summary.collect(), summary.schema)
    writers.append_table(rejected.select("_quarantine_timestamp", "h1", "h2"), noted)
    if newest is not None:
        writers.write_hwm(spark, mark_path, newest, now)
    rejected.unpersist()
    return found


def refresh_dimensions(
    spark: SparkSession, fact: DataFrame, base: str, now: datetime, buckets: int | None = None
) -> None:
    """Merge user and product dimensions; known keys keep their first_seen.

    With ``buckets`` the tables are dealt by key, and a refresh rewrites only the folders of
    the keys in ``fact``; ``writers.read_bucketed`` reads them.
    """
    for name, build, key in (
        ("dim_users", dims.dim_users, "user_id"), ("dim_products", dims.dim_products, "product_id")
    ):
        fresh = build(fact).withColumn("updated_at", F.lit(str(now)).cast("timestamp"))
        changing = [c for c in fresh.columns if c not in (key, "first_seen")]
        keep_first = partial(_keep_first_seen, update_cols=changing)
        if buckets:
            writers.upsert_bucketed(spark, f"{base}/{name}", fresh, [key], buckets, keep_first)
        else:
            writers.upsert_path(spark, f"{base}/{name}", fresh, [key], merge=keep_first)


def _keep_first_seen(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str]):
    return merge.upsert_cols(target, source, keys, update_cols)


# Target lag per derived table: key figures hourly, product and device reports less often.
TARGET_LAGS = {
    "gold_daily_active_users": timedelta(hours=1),
    "gold_daily_revenue": timedelta(hours=1),
    "gold_conversion_funnel": timedelta(hours=1),
    "gold_top_products": timedelta(hours=4),
    "gold_events_by_device": timedelta(hours=12),
}


def refresh_derived(spark: SparkSession, fact: Callable[[], DataFrame], base: str, now: datetime) -> list[str]:
    """Recompute the derived tables that are past their lag; returns their names."""
    done = []
    for name, lag in TARGET_LAGS.items():
        build = gold.GOLD_TABLES[name].build
        if build is gold.product_daily:
            build = partial(build, null_as_zero=True)
        if writers.refresh_if_stale(spark, f"{base}/{name}", lambda b=build: b(fact()), lag, now):
            done.append(name)
    return done


#: Grains of the daily state, and the folded tables kept from each: per day, and over a period.
STATE_GRAINS: dict[str, list[str]] = {"all": [], "device": ["device"], "product": ["product_id"]}
STATE_PERIOD = "week"


def refresh_state(
    spark: SparkSession, silver_path: str, base: str, mark_path: str, now: datetime, lag: timedelta | None = None,
) -> bool:
    """Bring the daily state and the tables folded from it up to date with a silver table.

    Only partitions that the change log names since the mark are read; their days' state is
    replaced, the daily figures of these days and the figures of the weeks they lie in are
    folded from the state. With ``lag`` nothing is done while the last run is younger. The
    mark moves last, and a repeated run rewrites the same. Returns whether it ran.
    """
    mark = int(writers.read_hwm(spark, mark_path, default="0"))
    newest = changes.newest_version(spark, silver_path)
    touched = changes.changed_partitions(spark, silver_path, mark, newest)
    if not touched:
        return False
    if lag is not None and files.is_table(spark, mark_path):
        last = spark.read.schema(writers.HWM_SCHEMA).json(mark_path).agg(F.max("updated_at").cast("string")).first()[0]
        if last is not None and now - datetime.fromisoformat(last) < lag:
            return False
    events = readers.read_table(spark, silver_path, schemas.SILVER)
    fresh = events.filter(merge.touched_predicate(schemas.PARTITION_COLUMNS, touched))
    dates = [date(*map(int, v)) for v in touched if None not in v]
    for grain, by in STATE_GRAINS.items():
        where = f"{base}/state_{grain}"
        _replace_dates(spark, state.daily_state(fresh, by), where, "event_date", dates)
        if not files.is_table(spark, where):
            continue
        schema = state.daily_state(fresh.limit(0), by).schema
        kept = readers.read_table(spark, where, schema)
        days = kept.filter(F.col("event_date").isin(dates))
        _replace_dates(spark, state.fold(days, ["event_date", *by]), f"{base}/daily_{grain}", "event_date", dates)
        firsts = sorted({d - timedelta(days=d.weekday()) for d in dates})
        in_weeks = reduce(Column.__or__, [F.col("event_date").between(d, d + timedelta(days=6)) for d in firsts], F.lit(False))
        weeks = state.fold(kept.filter(in_weeks), [state.period(STATE_PERIOD), *by])
        _replace_dates(spark, weeks, f"{base}/weekly_{grain}", "period", firsts)
    writers.write_hwm(spark, mark_path, str(newest), now)
    return True


def _replace_dates(spark: SparkSession, df: DataFrame, path: str, column: str, dates: list[date]) -> None:
    """Replace the named dates' partitions; a date without rows any more loses its partition."""
    writers.finish_interrupted(spark, path, (column,))
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    left = {r[0] for r in df.select(column).distinct().collect()}
    writers.staged_overwrite(df, path, (column,), emptied=[(d,) for d in dates if d not in left])
    df.unpersist()


def export_gold(
    spark: SparkSession, gold_dir: str, fmt: str, options: Callable[[str], dict[str, str]],
    mode: str = "overwrite",
) -> None:
    """Send every gold table that exists to an external sink."""
    for name in gold.GOLD_TABLES:
        path = f"{gold_dir}/{name}"
        if files.is_table(spark, path):
            writers.export_table(readers.read_table(spark, path), fmt, options(name), mode)
