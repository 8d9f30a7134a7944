"""Typing, deduplication and change application between bronze and silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions.rollup import pick_per_key


def cast_types(df: DataFrame, columns: tuple[str, ...] = ("event_time", "ingestion_timestamp")) -> DataFrame:
    """Text to timestamps; unreadable text becomes NULL for an expectation to drop."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in columns})


def duplicate_keys(df: DataFrame, key: str = "event_id") -> DataFrame:
    counted = df.groupBy(key).agg(F.count("*").alias("occurrences"))
    return counted.filter(F.col("occurrences") > 1)


def content_hash(df: DataFrame) -> Column:
    """Last tie-break: a fixed order between rows that differ in any column."""
    hashable = [f.name for f in df.schema if f.dataType.typeName() not in ("variant", "map")]
    return F.xxhash64(*[F.col(c) for c in hashable])


def dedup(
    df: DataFrame, keys: list[str], order: str, keep: str = "first", tie: list[str] | None = None
) -> DataFrame:
    """One row per key: the earliest (``first``) or latest (``last``) by ``order``."""
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    direction = F.col(order).asc_nulls_last() if keep == "first" else F.col(order).desc_nulls_last()
    ties = [F.col(t) for t in tie] if tie else [content_hash(df)]
    return pick_per_key(df, keys, [direction, *ties])


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    sequence_by: str,
    except_cols: list[str] | None = None,
    delete_when: str | None = None,
    tie: list[str] | None = None,
) -> DataFrame:
    """Type-1 change application: the highest sequence per key wins.

    The result depends only on the set of rows seen, so replaying a batch, or a
    file delivered twice, changes nothing. ``delete_when`` removes keys whose
    latest row matches it; the removal is not remembered, so an older row that
    arrives in a later call brings its key back (``apply_changes_with_deletes``
    remembers).
    """
    excluded = except_cols or []
    merged = changes
    if target is not None:
        merged = target.unionByName(changes, allowMissingColumns=True)
    latest = dedup(merged, keys, sequence_by, keep="last", tie=tie)
    if delete_when:
        latest = latest.filter(~F.coalesce(F.expr(delete_when), F.lit(False)))
    return latest.drop(*excluded)


#: Marks rows that stand for the delete of their key.
DELETED = "_deleted"


def mark_deletes(df: DataFrame, delete_when: str) -> DataFrame:
    return df.withColumn(DELETED, F.coalesce(F.expr(delete_when), F.lit(False)))


def latest_state(
    target: DataFrame | None, changes: DataFrame, keys: list[str], sequence_by: str, except_cols: list[str]
) -> DataFrame:
    """The row or delete with the highest sequence of each key; on a tie the delete.

    The order of rows does not look at ``except_cols``, which a target no longer has.
    """
    merged = changes if target is None else changes.unionByName(target, allowMissingColumns=True)
    merged = merged.withColumn(DELETED, F.coalesce(DELETED, F.lit(False)))
    known = merged.drop(DELETED, *except_cols)
    return pick_per_key(merged, keys, [F.col(sequence_by).desc_nulls_last(), F.col(DELETED).desc(), content_hash(known)])


def apply_changes_with_deletes(
    target: DataFrame | None,
    deleted: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    sequence_by: str,
    delete_when: str,
    except_cols: list[str] | None = None,
    forget_before=None,
) -> tuple[DataFrame, DataFrame]:
    """Type-1 change application that remembers deletes: the rows, and the deleted keys with their sequence.

    Both results go into the next call. The outcome depends on the set of changes seen alone,
    whatever their batches, order and repetition; a row older than the delete of its key stays
    out. Deletes of a sequence below ``forget_before`` are dropped from the memory.
    """
    excluded = except_cols or []
    marked = mark_deletes(changes, delete_when)
    if deleted is not None:
        marked = marked.unionByName(mark_deletes(deleted, "true"), allowMissingColumns=True)
    state = latest_state(target, marked, keys, sequence_by, excluded)
    gone = state.filter(DELETED).select(*keys, sequence_by)
    if forget_before is not None:
        gone = gone.filter(F.col(sequence_by) >= F.lit(forget_before))
    return state.filter(~F.col(DELETED)).drop(DELETED, *excluded), gone


def add_partitions(df: DataFrame, ts: str = "event_time") -> DataFrame:
    patterns = {"year": "yyyy", "month": "MM", "day": "dd"}
    return df.withColumns({c: F.date_format(F.col(ts), p) for c, p in patterns.items()})


def event_distribution(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("event_type").agg(F.count("*").alias("events"))
        .orderBy(F.desc("events"), "event_type")
    )


def distinct_partitions(df: DataFrame) -> DataFrame:
    return df.select("year", "month", "day").distinct()


def reconcile(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: bronze rows, silver rows and how many were removed between them."""
    layers = bronze.select(F.lit(True).alias("raw")).union(silver.select(F.lit(False).alias("raw")))
    return layers.agg(
        F.count_if("raw").alias("bronze_rows"), F.count_if(~F.col("raw")).alias("silver_rows")
    ).withColumn("removed_rows", F.col("bronze_rows") - F.col("silver_rows"))


def to_fact(silver: DataFrame) -> DataFrame:
    """Serving fact: one row per silver event with its date and a decimal price."""
    return silver.select(
        "event_id", "event_time", F.to_date("event_time").alias("event_date"),
        F.col("user_id").cast("int").alias("user_id"), "event_type",
        F.col("product_id").cast("int").alias("product_id"),
        F.col("price").try_cast("decimal(10,2)").alias("price"),
        "device", "country", "ingestion_timestamp",
    )
