"""A Bloom filter of the keys of each partition, kept beside the table.

An upsert has to find the partitions that already hold one of its keys. The filter rules out
nearly all others, so only the rest is read. A partition whose filter is missing (written by
other means, or by a write that was interrupted) counts as one that may hold any key.

A partition's filter has blocks of HASHES slices of 32,768 bits, enough blocks for
BITS_PER_KEY bits a key. A key sets one bit in each slice of one block: a key that is not there passes with a chance
of about 6 in a million. Filters are built and probed by Spark's own bitmap functions; a
batch's keys travel in lists of bounded size, one comparison loop for each filter block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.sources import files

BITS_PER_KEY, HASHES, SLICE_BITS = 32, 8, 32_768
KEYS_PER_BLOCK = HASHES * SLICE_BITS // BITS_PER_KEY
#: Chance that a key passes a filter that does not hold it, and keys compared in one list.
FALSE_PASS, LIST_KEYS = 6e-6, 20_000


def index_path(path: str) -> str:
    return path.rstrip("/") + "__keys"


def _hashes(keys: list[str]) -> list[Column]:
    own = [F.col(k) for k in keys]
    return [F.xxhash64(*own).alias("h"), F.xxhash64(F.lit(1), *own).alias("h1"), F.xxhash64(F.lit(2), *own).alias("h2")]


def _bit(h1: Column, h2: Column, i: int) -> Column:
    """Place of a key in slice i."""
    return F.shiftrightunsigned(h1 if i < HASHES // 2 else h2, 15 * (i % (HASHES // 2))).bitwiseAND(F.lit(SLICE_BITS - 1))


def build(rows: DataFrame, keys: list[str], cols: tuple[str, ...]) -> DataFrame:
    """Filter blocks of every partition of ``rows``."""
    hashed = rows.select(*cols, *_hashes(keys))
    needed = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n") / F.lit(float(KEYS_PER_BLOCK))))).cast("int")
    sizes = hashed.groupBy(*cols).agg(F.count("*").alias("n")).select(
        *[F.col(c).alias(f"_{c}") for c in cols], F.call_function("shiftleft", F.lit(1), needed).alias("blocks"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols])
    placed = hashed.join(sizes, same).withColumn("block", F.pmod("h", "blocks").cast("int"))
    return placed.groupBy(*cols, "blocks", "block").agg(
        *[F.bitmap_construct_agg(_bit(F.col("h1"), F.col("h2"), i)).alias(f"s{i}") for i in range(HASHES)])


def _holds(slice_: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(slice_, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def passing(index: DataFrame, incoming: DataFrame, keys: list[str], cols: tuple[str, ...], count: int) -> DataFrame:
    """Partitions of the index whose filter lets a key of ``incoming`` pass."""
    sizes = [r.blocks for r in index.select("blocks").distinct().collect()]  # powers of two: a few dozen at most
    if not sizes:
        return index.select(*cols)
    lists = F.lit(-(-count // LIST_KEYS))
    wanted = (
        incoming.select(*_hashes(keys)).distinct()
        .withColumn("blocks", F.explode(F.array(*map(F.lit, sizes))))
        .groupBy("blocks", F.pmod("h", "blocks").cast("int").alias("block"), F.pmod("h1", lists).alias("list"))
        .agg(F.collect_list(F.struct("h1", "h2")).alias("wanted"))
    )

    def may_hold(key: Column) -> Column:
        return reduce(Column.__and__, [_holds(F.col(f"s{i}"), _bit(key["h1"], key["h2"], i)) for i in range(HASHES)])

    met = index.join(wanted, ["blocks", "block"]).filter(F.exists("wanted", may_hold))
    return met.select(*cols).distinct()


def candidates(
    spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], cols: tuple[str, ...]
) -> list[tuple] | None:
    """Values of the partitions that may hold a key of ``incoming``; None where the filters would rule out nothing."""
    known = set(files.partition_folders(spark, index_path(path), len(cols))) if files.exists(spark, index_path(path)) else set()
    count = incoming.count()
    if not known or count * FALSE_PASS > 1:
        return None
    every = set(files.partition_folders(spark, path, len(cols)))
    text = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    stored = spark.read.parquet(index_path(path)).schema
    schema = T.StructType([text[f.name] if f.name in cols else f for f in stored])
    index = spark.read.schema(schema).parquet(index_path(path))
    found = {tuple(r) for r in passing(index, incoming, keys, cols, max(1, count)).collect()}
    return [files.values_of(f) for f in sorted(every) if f not in known or files.values_of(f) in found]
