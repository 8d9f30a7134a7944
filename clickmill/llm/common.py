"""Tables, row keys and Arrow helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.sources.files import scratch, shared_folder

BATCH_ROWS = 50_000

__all__ = ["BATCH_ROWS", "batches", "keyed", "scratch", "settle", "shared_folder", "ship", "table", "texts"]

#: Texts differ much in length: record batches are bounded by bytes as well as by rows.
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library's source to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "clickmill.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, "16m")
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Write a result that several jobs read to the shared folder and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.partitionBy(*partitions).parquet(path) if partitions else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, whole: bool = False) -> tuple[DataFrame, int]:
    """doc_id, text and a `doc_key` that no two rows share, and the key's step; if `whole`, all columns as struct `row`.

    Where doc_id is unique, doc_key is doc_id and the step 1. Rows repeating an id are
    numbered by their text and doc_key is doc_id * step + number, so doc_key // step still
    orders by doc_id. A missing doc_id counts as one below the smallest.
    """
    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                         *([F.struct(*docs.columns).alias("row")] if whole else []))
    ids = wanted.groupBy("doc_id").count().agg(
        F.max("count").alias("copies"), F.min("doc_id").alias("low"),
        F.max(F.col("doc_id").isNull()).alias("missing")).first()
    step = int(ids["copies"] or 1)
    floor = (ids["low"] if ids["low"] is not None else 1) - 1
    key = F.coalesce("doc_id", F.lit(floor)) if ids["missing"] else F.col("doc_id")
    if step > 1:
        from pyspark.sql import Window

        number = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
        key = key * step + number - 1
    return wanted.withColumn("doc_key", key), step


#: Option of the C library for the size from which memory is mapped on its own, and that size.
_MAP_FROM, _MAPPED_BYTES = -3, 1 << 18
_SET: list[bool] = []


def _give_back() -> None:
    """Return freed memory to the system: workers live on from stage to stage.

    Large arrays are mapped on their own and go back when freed; by itself the C library
    raises the size from which it does that with each one it frees.
    """
    pa.default_memory_pool().release_unused()
    try:
        library = ctypes.CDLL(None)
        if not _SET:
            _SET.append(bool(library.mallopt(_MAP_FROM, _MAPPED_BYTES)))
        library.malloc_trim(0)
    except AttributeError:  # another C library
        pass


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a missing text is empty."""
    _give_back()
    flat = pc.fill_null(column.cast(pa.large_string()), "")
    start, n = flat.offset, len(flat)
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[start:start + n + 1] if n else np.zeros(1, np.int64)
    data = flat.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def batches(columns: dict[str, np.ndarray | pa.Array], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Columns of equal length as record batches of bounded size."""
    whole = pa.table({k: v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v)
                      for k, v in columns.items()})
    yield from whole.to_batches(max_chunksize=rows)
