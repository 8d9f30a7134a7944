"""Relational upserts, change feeds and point-in-time reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.operators.silver import dedup


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All source rows, plus the target rows whose key the source does not hold."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return source.unionByName(kept)


def upsert_cols(
    target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str]
) -> DataFrame:
    """Matched rows take ``update_cols`` from the source and keep the rest."""
    t = target.withColumn("_in_target", F.lit(True))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in target.columns if c not in keys],
                      F.lit(True).alias("_in_source"))
    joined = t.join(s, keys, "full_outer")

    def pick(c: str):
        fresh, old = F.col(f"_s_{c}"), F.col(c)
        take = F.col("_in_target").isNull()
        if c in update_cols:
            take = take | F.col("_in_source").isNotNull()
        return F.when(take, fresh).otherwise(old).alias(c)

    return joined.select(*[F.col(c) if c in keys else pick(c) for c in target.columns])


def insert_missing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target plus the source rows whose key it does not hold yet."""
    return target.unionByName(source.join(target.select(key), key, "left_anti"))


def append_evolving(target: DataFrame, new: DataFrame, merge_schema: bool = False) -> DataFrame:
    """Append; extra columns are refused unless ``merge_schema``, then old rows get NULL."""
    extra = [c for c in new.columns if c not in target.columns]
    if extra and not merge_schema:
        raise ValueError(f"schema mismatch: {extra} not in the target; pass merge_schema=True")
    return target.unionByName(new, allowMissingColumns=True)


def as_of(df: DataFrame, ts_col: str, ts: str) -> DataFrame:
    """What an append-only input held at ``ts``."""
    return df.filter(F.col(ts_col) <= F.lit(ts).cast(df.schema[ts_col].dataType))


def restore(df: DataFrame, keys: list[str], ts_col: str, ts: str) -> DataFrame:
    """The table as it stood at ``ts``: the latest row per key known by then."""
    return dedup(as_of(df, ts_col, ts), keys, ts_col, keep="last")


def change_feed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Row changes from ``old`` to ``new`` with ``_change_type``.

    Both sides are keyed uniquely. An update yields its image before and after;
    rows that are equal, NULLs included, yield nothing.
    """
    columns = [c for c in new.columns if c not in keys]
    before = old.select(*keys, F.struct(*columns).alias("before"))
    after = new.select(*keys, F.struct(*columns).alias("after"))
    both = before.join(after, keys, "full_outer")
    gone, came = F.col("after").isNull(), F.col("before").isNull()

    def image(kind: str, row: str):
        return F.struct(F.lit(kind).alias("_change_type"), F.col(row).alias("row"))

    images = (
        F.when(came, F.array(image("insert", "after")))
        .when(gone, F.array(image("delete", "before")))
        .otherwise(F.array(image("update_preimage", "before"), image("update_postimage", "after")))
    )
    changed = both.filter(~F.col("before").eqNullSafe(F.col("after")))
    return changed.select(*keys, F.inline(images)).select(*keys, "row.*", "_change_type")


def touched_predicate(columns: tuple[str, ...], values: list[tuple]) -> Column:
    """Partition filter for a list of partition values, evaluated while listing files.

    Values are compared one by one, a missing one only with a missing one.
    """
    def marked(value) -> str:
        return "-" if value is None else f"={value}"

    own = F.array(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns])
    return own.isin(*[F.array(*[F.lit(marked(v)) for v in row]) for row in values]) if values else F.lit(False)
