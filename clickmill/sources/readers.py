"""Reading files and tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newline-delimited JSON with a given schema.

    The reader returns NULL where a value does not fit, also for columns declared
    NOT NULL; an expectation has to filter those rows.
    """
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def cast_staged(raw: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Project and cast; a row with a value that cannot be cast is skipped."""
    have = set(raw.columns)
    cast = {c: F.col(c).try_cast(t) if c in have else F.lit(None).cast(t) for c, t in casts.items()}
    sound = [F.col(c).isNull() | cast[c].isNotNull() for c in casts if c in have]
    return raw.filter(reduce(lambda a, b: a & b, sound, F.lit(True))).select(
        *[expr.alias(c) for c, expr in cast.items()]
    )


def load_staged(
    spark: SparkSession, path: str, casts: dict[str, str], glob: str = "*.parquet",
    loaded_at: datetime | str | Column | None = None,
) -> DataFrame:
    """Staged columnar files as typed rows, stamped with the load time if given."""
    raw = spark.read.option("pathGlobFilter", glob).parquet(path)
    loaded = cast_staged(raw, casts)
    if loaded_at is None:
        return loaded
    stamp = loaded_at if isinstance(loaded_at, Column) else F.lit(str(loaded_at)).cast("timestamp")
    return loaded.withColumn("loaded_at", stamp)
