"""Writing tables: partition overwrites, appends, staged replacement, upserts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.constants import FIRST_HIGH_WATER_MARK
from clickmill.functions.curve import z_value
from clickmill.operators import silver
from clickmill.operators.merge import touched_predicate, upsert
from clickmill.operators.silver import add_partitions
from clickmill.sources import changes, files, key_index

Merge = Callable[[DataFrame, DataFrame, list[str]], DataFrame]


def sized(df: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Even output files: large partitions are split and small ones joined at run time."""
    return df.hint("rebalance", *columns)


def write_partitions(df: DataFrame, path: str, cols: tuple[str, ...]) -> None:
    """Replace only the partitions present in ``df``; they count as changed."""
    finish_interrupted(df.sparkSession, path, cols)
    staged_overwrite(df, path, cols)


def append_ndjson(df: DataFrame, path: str, date_col: str) -> None:
    """Append JSON lines under year=/month=/day= of ``date_col``."""
    dated = add_partitions(df, date_col)
    dated.write.partitionBy("year", "month", "day").mode("append").json(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_table(df: DataFrame, fmt: str, options: dict[str, str], mode: str = "overwrite") -> None:
    """Hand a table to any registered sink; overwriting makes a repeated export safe."""
    df.write.format(fmt).options(**options).mode(mode).save()


def _stage(path: str) -> str:
    return path.rstrip("/") + "__staged"


def _emptied(path: str) -> str:
    return path.rstrip("/") + "__emptied"


def _publish(spark: SparkSession, path: str, cols: tuple[str, ...], same_rows: bool = False) -> None:
    """Move the staged partitions, or the whole staged table, into place.

    Moving keeps the file layout and writes the data once. What is to change is noted
    first, partitions that have become empty are deleted from the list kept beside the
    stage, and partitions moved before an interruption are no longer staged, so repeating
    this is safe. The version counts for readers when all has moved. With ``same_rows``
    (only the files change) there is no new version, and key filters stay valid.
    """
    stage, path = _stage(path), path.rstrip("/")
    if cols:
        gone = []
        if files.exists(spark, _emptied(path)):
            gone = [r.value for r in spark.read.text(_emptied(path)).collect()]
        folders = files.partition_folders(spark, stage, len(cols))
        if same_rows:
            for folder in folders:
                files.replace(spark, stage + folder, path + folder)
        elif folders or gone:
            version = changes.begin(spark, path, [*folders, *gone])
            index = key_index.index_path(path)
            filters = _stage(index) if files.exists(spark, _stage(index) + "/_SUCCESS") else None
            for folder in [*gone, *folders]:
                # without its filter a partition may hold any key, so a stop in between misleads nobody
                files.delete(spark, index + folder)
                changes.put_aside(spark, path, folder, version)
                if folder in gone:
                    continue
                files.replace(spark, stage + folder, path + folder)
                if filters and files.exists(spark, filters + folder):
                    files.replace(spark, filters + folder, index + folder)
            changes.finish(spark, path, version)
            files.delete(spark, _stage(index))
        files.delete(spark, stage)
        files.delete(spark, _emptied(path))
    else:
        files.replace(spark, stage, path)
    spark.catalog.refreshByPath(path)


def finish_interrupted(spark: SparkSession, path: str, cols: tuple[str, ...] = ()) -> None:
    """Redo a replacement whose staged copy is complete but was not published."""
    if files.exists(spark, _stage(path) + "/_SUCCESS"):
        _publish(spark, path, cols)


def staged_overwrite(
    df: DataFrame, path: str, cols: tuple[str, ...] = (), emptied: list[tuple] | None = None,
    index: list[str] | None = None,
) -> None:
    """Replace a table, or the partitions in ``df``, from data that reads the table.

    The result is written aside in full before anything is replaced, so no plan
    reads what it overwrites and an interrupted run can be finished from the copy.
    Replacement is not atomic across partitions. A table has one writer at a time.
    ``index`` names key columns whose filter is written with each partition.
    """
    spark = df.sparkSession
    files.delete(spark, _stage(path))
    files.delete(spark, _stage(key_index.index_path(path)))
    files.delete(spark, _emptied(path))
    if emptied:
        # written before the stage is complete, so that a stop in between loses none of it
        lines = [(files.folder_of(cols, values),) for values in emptied]
        spark.createDataFrame(lines, "value STRING").coalesce(1).write.text(_emptied(path))
    writer = sized(df, cols).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*cols) if cols else writer).parquet(_stage(path))
    if index and cols and files.partition_folders(spark, _stage(path), len(cols)):
        staged = spark.read.schema(df.schema).parquet(_stage(path))
        filters = key_index.build(staged, index, cols)
        filters.write.partitionBy(*cols).option("partitionOverwriteMode", "static").mode("overwrite").parquet(
            _stage(key_index.index_path(path)))
    _publish(spark, path, cols)


def partition_values(df: DataFrame, cols: tuple[str, ...]) -> list[tuple]:
    """Distinct partition values: as many rows as the table has partition folders."""
    return [tuple(r) for r in df.select(*cols).distinct().collect()]


def upsert_path(
    spark: SparkSession, path: str, df: DataFrame, keys: list[str],
    cols: tuple[str, ...] = (), merge: Merge = upsert, fixed_partition: bool = False,
    also: list[tuple] | None = None, landing: Column | None = None,
) -> None:
    """Create the table from ``df``, or merge ``df`` into it.

    On a partitioned table only the partitions that receive rows or already hold
    one of the keys are read in full and rewritten. The second kind is found by
    scanning just the key columns of the partitions whose key filter lets one pass, so a
    key whose row moves to another partition leaves no old copy behind. ``fixed_partition``
    skips that for tables whose keys are known never to move (and writes no filters);
    ``also`` names partitions to merge besides; ``landing`` tells which rows of ``df`` may
    enter the table, if not all do.
    """
    finish_interrupted(spark, path, cols)
    index = None if fixed_partition else keys
    if not files.is_table(spark, path):
        nothing = spark.createDataFrame([], df.schema)
        staged_overwrite(merge(nothing, df, keys), path, cols, index=index)
        return
    target = spark.read.schema(_table_schema(spark, path, df.schema, cols)).parquet(path)
    if not cols:
        staged_overwrite(merge(target, df, keys), path)
        return
    incoming = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        enters = (incoming if landing is None else incoming.filter(landing)).select(*cols)
        if not fixed_partition:
            enters = enters.union(held_partitions(spark, path, target, incoming, keys, cols))
        touched = partition_values(enters, cols)
        touched += [v for v in also or [] if v not in touched]
        if not touched:
            return
        affected = target.filter(touched_predicate(cols, touched))
        merged = merge(affected, incoming, keys).persist(StorageLevel.MEMORY_AND_DISK)
        left = set(partition_values(merged, cols))
        staged_overwrite(merged, path, cols, emptied=[v for v in touched if v not in left], index=index)
        merged.unpersist()
    finally:
        incoming.unpersist()


def held_partitions(
    spark: SparkSession, path: str, target: DataFrame, incoming: DataFrame, keys: list[str], cols: tuple[str, ...]
) -> DataFrame:
    """Partition values of the target rows with a key of ``incoming``, from the partitions whose filter lets one pass."""
    passed = key_index.candidates(spark, path, incoming, keys, cols)
    if passed is not None:
        target = target.filter(touched_predicate(cols, passed))
    return target.select(*keys, *cols).join(incoming.select(*keys), keys, "left_semi").select(*cols)


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


#: Partition column of tables that are dealt by key.
BUCKET = "key_bucket"


def upsert_bucketed(
    spark: SparkSession, path: str, df: DataFrame, keys: list[str], buckets: int, merge: Merge = upsert
) -> None:
    """Upsert into a table without natural partitions, dealt into ``buckets`` folders by key.

    A batch rewrites the folders of its keys only. The number of folders is fixed for a table.
    """
    noted = path.rstrip("/") + "__buckets"
    if not files.exists(spark, noted):
        files.write_text(spark, noted, str(buckets))
    elif int(files.read_text(spark, noted)) != buckets:
        raise ValueError(f"{path} has {files.read_text(spark, noted)} buckets, not {buckets}")
    upsert_path(spark, path, _bucketed(df, keys, buckets), keys, (BUCKET,), merge, fixed_partition=True)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def deletes_path(path: str) -> str:
    return path.rstrip("/") + "__deleted"


#: Folders of the remembered deletes of a table.
DELETE_BUCKETS = 16


def apply_changes_path(
    spark: SparkSession, path: str, changed: DataFrame, keys: list[str], sequence_by: str,
    cols: tuple[str, ...] = (), delete_when: str = "false", except_cols: list[str] | None = None,
    fixed_partition: bool = False,
) -> None:
    """Change application to a stored table that remembers deletes.

    A deleted key and the sequence of its delete are kept beside the table, dealt by key, and
    a later batch takes the deletes of its own keys into account: rows older than their
    delete stay out, whenever they arrive. Deletes are written before the table, so a run
    that stops in between and is repeated ends in the same state.
    """
    gone = deletes_path(path)
    marked = silver.mark_deletes(changed, delete_when)
    fresh = marked.filter(silver.DELETED).groupBy(*keys).agg(F.max(sequence_by).alias(sequence_by))
    finish_interrupted(spark, gone, (BUCKET,))
    if not fresh.isEmpty():
        upsert_bucketed(spark, gone, fresh, keys, DELETE_BUCKETS, partial(_latest_delete, sequence_by=sequence_by))
    if files.is_table(spark, gone):
        wanted = _bucketed(changed.select(*keys), keys, DELETE_BUCKETS)
        touched = partition_values(wanted, (BUCKET,))
        known = spark.read.schema(_bucketed(fresh, keys, DELETE_BUCKETS).schema).parquet(gone).filter(touched_predicate((BUCKET,), touched))
        known = known.drop(BUCKET).join(changed.select(*keys), keys, "left_semi")
        marked = marked.unionByName(silver.mark_deletes(known, "true"), allowMissingColumns=True)
    upsert_path(
        spark, path, marked, keys, cols, fixed_partition=fixed_partition, landing=~F.col(silver.DELETED),
        merge=partial(_merge_remembering, sequence_by=sequence_by, except_cols=except_cols or []),
    )


def _latest_delete(target: DataFrame, source: DataFrame, keys: list[str], sequence_by: str) -> DataFrame:
    return target.unionByName(source).groupBy(*keys, BUCKET).agg(F.max(sequence_by).alias(sequence_by)).select(*source.columns)


def _merge_remembering(target: DataFrame, source: DataFrame, keys: list[str], sequence_by: str, except_cols: list[str]):
    merged = silver.latest_state(target, source, keys, sequence_by, except_cols)
    return merged.filter(~F.col(silver.DELETED)).drop(silver.DELETED, *except_cols)


def forget_deletes(spark: SparkSession, path: str, sequence_by: str, before) -> None:
    """Drop remembered deletes older than ``before``: rows older still must no longer arrive."""
    gone = deletes_path(path)
    finish_interrupted(spark, gone, (BUCKET,))
    if not files.is_table(spark, gone):
        return
    known = spark.read.parquet(gone)
    kept = known.filter(F.col(sequence_by) >= F.lit(before))
    every = {tuple(r) for r in known.select(BUCKET).distinct().collect()}
    left = {tuple(r) for r in kept.select(BUCKET).distinct().collect()}
    staged_overwrite(kept, gone, (BUCKET,), emptied=sorted(every - left))


def _table_schema(
    spark: SparkSession, path: str, like: T.StructType, cols: tuple[str, ...]
) -> T.StructType:
    """Table schema with its partition columns typed as in the incoming rows ("01" stays text)."""
    return T.StructType([
        like[f.name] if f.name in cols else f for f in spark.read.parquet(path).schema
    ])


def compact(
    spark: SparkSession, path: str, target_files: int,
    cluster_cols: tuple[str, ...] = (), cols: tuple[str, ...] = (), only: list[tuple] | None = None,
    curve: bool = False,
) -> None:
    """Rewrite a table, or ``only`` some of its partitions, into about ``target_files`` files.

    Files are ordered by ``cluster_cols``, the first above the second and so on; with
    ``curve`` along a Z-order curve that serves ranges of each of them. ``cols`` are the
    table's partition columns; a partitioned table is not taken for one without.

    A row hash ends the range key, so one value that fills much of the table is
    spread over several files instead of one task.
    """
    finish_interrupted(spark, path, cols)
    # partition values are read as text, so folders keep their names ("01" stays "01")
    text = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    found = [f.split("=")[0].strip("/") for f in files.partition_folders(spark, path, 1) if "=" in f]
    if found and (not cols or found[0] != cols[0]):
        raise ValueError(f"{path} is partitioned by {found[0]}, not by {cols}")
    schema = _table_schema(spark, path, text, cols)
    table = spark.read.schema(schema).parquet(path)
    if only is not None:
        table = table.filter(touched_predicate(cols, only))
    order = [*map(F.col, cols), *([z_value(table, cluster_cols)] if curve else map(F.col, cluster_cols))]
    if order:
        row_hash = F.xxhash64(*table.columns)
        table = table.repartitionByRange(target_files, *order, row_hash).sortWithinPartitions(*order)
    else:
        table = table.repartition(target_files)
    stage = table.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (stage.partitionBy(*cols) if cols else stage).parquet(_stage(path))
    _publish(spark, path, cols, same_rows=True)


HWM_SCHEMA = "last_processed STRING, updated_at TIMESTAMP"


def read_hwm(spark: SparkSession, path: str, default: str = FIRST_HIGH_WATER_MARK) -> str:
    """The newest mark, or the default on the first run."""
    if not files.is_table(spark, path):
        return default
    newest = spark.read.schema(HWM_SCHEMA).json(path).agg(F.max_by("last_processed", "updated_at"))
    return newest.first()[0] or default


def write_hwm(spark: SparkSession, path: str, mark: str, now: datetime) -> None:
    """Add a mark. Adding, not replacing, keeps the old one if the write fails."""
    row = spark.range(1).select(
        F.lit(str(mark)).alias("last_processed"), F.lit(str(now)).cast("timestamp").alias("updated_at")
    )
    row.coalesce(1).write.mode("append").json(path)


def refresh_if_stale(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], lag: timedelta, now: datetime
) -> bool:
    """Recompute a derived table once it is older than its target lag."""
    finish_interrupted(spark, path)
    if files.is_table(spark, path):
        newest = spark.read.parquet(path).agg(F.max("loaded_at").cast("long")).first()[0]
        stamp = spark.range(1).select(F.lit(str(now)).cast("timestamp").cast("long")).first()[0]
        if newest is not None and stamp - newest < lag.total_seconds():
            return False
    staged_overwrite(build().withColumn("loaded_at", F.lit(str(now)).cast("timestamp")), path)
    return True
