"""Aggregation building blocks that stay exact and balanced on hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def entity_rollup(
    df: DataFrame,
    keys: list[str],
    entity: str,
    distinct: dict[str, Column | None],
    counts: dict[str, Column | None] | None = None,
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Counts, sums and several distinct counts of one entity in two aggregations.

    The first step keeps one row per (keys, entity), combined on the map side, so
    a key holding a large share of all rows is spread over its entities. The
    second step only adds up flags. Several ``count(DISTINCT CASE ..)`` in one
    SELECT would instead copy every input row once per distinct expression.

    ``distinct`` and ``counts`` map an output name to a row predicate, or None
    for "all rows".
    """
    counts, sums = counts or {}, sums or {}
    inner = [F.count("*").alias(f"_c_{n}") if p is None else F.count_if(p).alias(f"_c_{n}")
             for n, p in counts.items()]
    inner += [F.sum(e).alias(f"_s_{n}") for n, e in sums.items()]
    inner += [F.max(p.cast("int")).alias(f"_d_{n}") for n, p in distinct.items() if p is not None]
    per_entity = df.groupBy(*keys, entity).agg(*(inner or [F.count("*").alias("_rows")]))

    known = F.col(entity).isNotNull()
    outer = [
        F.count_if(known if p is None else known & (F.col(f"_d_{n}") == 1)).alias(n)
        for n, p in distinct.items()
    ]
    outer += [F.sum(f"_c_{n}").alias(n) for n in counts]
    outer += [F.sum(f"_s_{n}").alias(n) for n in sums]
    return per_entity.groupBy(*keys).agg(*outer)


def share_of_group(agg: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Percentage of ``value`` within each ``by`` group of an aggregated frame.

    Group totals are aggregated again and joined back, so a group with very many
    members is not gathered into one window partition.
    """
    totals = agg.groupBy(*by).agg(F.sum(value).alias("_group_total"))
    pct = F.round(F.try_divide(F.col(value) * F.lit(100.0), F.col("_group_total")), 2)
    return agg.join(totals, by).withColumn(name, pct).drop("_group_total")


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows collapsed to (key, value, count) on the map side; NULL is a value too."""
    return df.groupBy(*keys, F.col(value).cast("double").alias("value")).agg(F.count("*").alias("n"))


#: Ranges in which a value may double; no value has more than 2100 doublings below it and as many above zero.
RANGES_A_DOUBLING = 128


def value_range(value: Column, width: float | None = None) -> Column:
    """Number of the range a value lies in, rising with the value: of equal ``width``, else as fine as the value is large.

    The second kind follows the unit and spread of the data by itself: milliseconds, nanoseconds or
    far outliers give a few hundred ranges alike.
    """
    if width:
        return F.floor(value / F.lit(float(width)))
    doublings = F.least(F.log2(F.abs(value)), F.lit(1025.0))
    away = F.floor(doublings * F.lit(float(RANGES_A_DOUBLING))) + F.lit(1 << 20)
    return F.when(value.isNull(), F.lit(None)).when(value == 0, F.lit(0).cast("long")).when(value > 0, away).otherwise(-away)


def percentile_of_counts(
    counts: DataFrame, keys: list[str], q: float, name: str, width: float | None = None
) -> DataFrame:
    """Interpolated percentile per key without ordering a whole group in one task.

    Counts per value range (`value_range`) locate the one or two ranges that hold the
    wanted ranks; only the values in those ranges are ordered. Range totals are
    ordered per key, and their number is set by the magnitudes of the values, not by
    the row count. NULLs weigh nothing, and a key with nothing else gets NULL; to
    filter them here would make Spark read the input once more for the values.
    """
    weighed = counts.select(
        *keys, "value", F.when(F.col("value").isNull(), 0).otherwise(F.col("n")).alias("_n"),
        F.coalesce(value_range(F.col("value"), width), F.lit(-(2 ** 63))).alias("_range"),
    )
    ordered = Window.partitionBy(*keys).orderBy("_range")
    whole = Window.partitionBy(*keys)
    ranges = (
        weighed.groupBy(*keys, "_range").agg(F.sum("_n").alias("_rn"))
        .withColumn("_upto", F.sum("_rn").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_all", F.sum("_rn").over(whole))
        .withColumn("_rank", (F.col("_all") - 1) * F.lit(float(q)))
        .withColumn("_before", F.col("_upto") - F.col("_rn"))
        .filter((F.col("_all") == 0)
                | ((F.floor("_rank") < F.col("_upto")) & (F.ceil("_rank") >= F.col("_before"))))
        .select(*keys, "_range", "_before", "_rank")
    )
    inside = Window.partitionBy(*keys, "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        weighed.join(ranges, [*keys, "_range"])
        .withColumn("_last", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_first", F.col("_last") - F.col("_n"))
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_first")) & (rank < F.col("_last")), F.col("value")))

    at_ranks = placed.groupBy(*keys).agg(
        value_at(F.floor("_rank")).alias("_lo"), value_at(F.ceil("_rank")).alias("_hi"),
        F.max("_rank").alias("_rank"),
    )
    part = F.col("_rank") - F.floor("_rank")
    return at_ranks.select(
        *keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * part).alias(name)
    )


def exact_percentile(
    df: DataFrame, keys: list[str], value: str, q: float, name: str, width: float | None = None
) -> DataFrame:
    return percentile_of_counts(value_counts(df, keys, value), keys, q, name, width)


def pick_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in ``order``.

    ``row_number() = 1`` lets Spark place a group limit before the shuffle: each
    map task sends at most one row per key, so a key with very many copies costs
    its reducer one row per map task.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_pick", first).filter(F.col("_pick") == 1).drop("_pick")
