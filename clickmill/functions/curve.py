"""Ranks of values among quantiles, and their place on a space-filling curve."""

from __future__ import annotations

from functools import reduce
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order_number(df: DataFrame, name: str, skip: int = 0) -> Column:
    """A double that grows with the column: numbers and times themselves, texts by six bytes after the first ``skip``."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        bytes_ = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1 + skip, 6)), 12, "0")
        return F.conv(bytes_, 16, 10).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return F.col(name).cast("timestamp").cast("double")
    return F.col(name).cast("double")


def shared_prefix(df: DataFrame, names: list[str] | tuple[str, ...]) -> dict[str, int]:
    """Bytes that all values of a text column begin with: those that the least and the greatest share."""
    texts = [n for n in names if isinstance(df.schema[n].dataType, (T.StringType, T.BinaryType))]
    if not texts:
        return {}
    ends = df.agg(*[f(F.col(n).cast("binary")).alias(f"{k}{i}") for i, n in enumerate(texts) for k, f in (("a", F.min), ("b", F.max))]).first()
    return {n: len(commonprefix([bytes(ends[f"a{i}"] or b""), bytes(ends[f"b{i}"] or b"")])) for i, n in enumerate(texts)}


def quantile_bounds(df: DataFrame, numbers: dict[str, Column], bits: int, accuracy: int = 10_000) -> dict[str, list[float]]:
    """Bounds that cut each number into about 2**bits ranges of like row count; 2**bits - 1 numbers each reach the driver."""
    parts = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(c, parts, accuracy).alias(n) for n, c in numbers.items()]).first()
    return {n: list(found[n] or []) for n in numbers}


def rank_bucket(number: Column, bounds: list[float], bits: int) -> Column:
    """How many bounds are below the number, by binary search; a missing number has rank 0."""
    if not bounds:
        return F.lit(0).cast("long")
    known = F.array(*map(F.lit, bounds))
    steps = F.array(*[F.lit(1 << b).cast("long") for b in reversed(range(bits))])

    def step(at: Column, width: Column) -> Column:
        return at + F.when(F.element_at(known, (at + width).cast("int")) < number, width).otherwise(F.lit(0).cast("long"))

    return F.aggregate(steps, F.lit(0).cast("long"), step)


def z_value(df: DataFrame, names: list[str] | tuple[str, ...], bits: int | None = None) -> Column:
    """Place on the Z-order curve of the columns' ranks among their quantiles.

    Ranks make columns of any scale and skew count alike. One pass over the columns finds
    the quantiles (one more what all texts of a column begin with); the value itself is an
    expression of shifts.
    """
    bits = bits or min(10, 62 // len(names))
    skip = shared_prefix(df, names)
    numbers = {n: order_number(df, n, skip.get(n, 0)) for n in names}
    bounds = quantile_bounds(df, numbers, bits)
    place = F.lit(0).cast("long")
    for j, n in enumerate(names):
        rank = rank_bucket(numbers[n], bounds[n], bits)
        place = place.bitwiseOR(F.aggregate(F.array(rank), F.lit(0).cast("long"), _spread(bits, len(names), j)))
    return place


def _spread(bits: int, columns: int, j: int):
    """Bit b of a rank becomes bit b * columns + j; the rank is a lambda's argument, so it is computed once."""
    def spread(_: Column, rank: Column) -> Column:
        every = [F.call_function("shiftleft", F.call_function("shiftright", rank, F.lit(b)).bitwiseAND(F.lit(1).cast("long")),
                                 F.lit(b * columns + j)) for b in range(bits)]
        return reduce(Column.bitwiseOR, every)

    return spread
