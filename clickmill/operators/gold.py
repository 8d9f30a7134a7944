"""Daily aggregates over silver or fact rows that carry ``event_date``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions.rollup import entity_rollup

VIEW, CART, BUY = "product_view", "add_to_cart", "purchase"


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def money_in() -> Column:
    """Price of purchases only; other rows add nothing, not even a zero."""
    return F.when(is_type(BUY), F.col("price"))


def with_event_date(df: DataFrame) -> DataFrame:
    if "event_date" in df.columns:
        return df
    return df.withColumn("event_date", F.to_date("event_time"))


def percent(part: str, whole: str) -> Column:
    return F.round(F.try_divide(F.col(part) * F.lit(100.0), F.col(whole)), 2)


def daily_active_users(df: DataFrame) -> DataFrame:
    return entity_rollup(
        with_event_date(df), ["event_date"], "user_id",
        distinct={"daily_active_users": None, "purchasing_users": is_type(BUY)},
        counts={"total_events": None},
    )


def conversion_funnel(df: DataFrame) -> DataFrame:
    """Distinct users per stage and the two step rates in percent."""
    stages = {"viewers": VIEW, "cart_adders": CART, "purchasers": BUY}
    counted = entity_rollup(
        with_event_date(df), ["event_date"], "user_id",
        distinct={name: is_type(kind) for name, kind in stages.items()},
    )
    return counted.withColumns({
        "view_to_cart_pct": percent("cart_adders", "viewers"),
        "cart_to_purchase_pct": percent("purchasers", "cart_adders"),
    })


def daily_revenue(df: DataFrame) -> DataFrame:
    """Count, sum, mean, least and greatest price of priced purchases per day."""
    bought = with_event_date(df).filter(is_type(BUY) & F.col("price").isNotNull())
    price = F.col("price").cast("decimal(10,2)")
    return bought.groupBy("event_date").agg(
        F.count("*").alias("purchase_count"),
        F.sum(price).alias("total_revenue"),
        F.round(F.sum(price) / F.count("*"), 2).alias("avg_order_value"),
        F.min(price).alias("min_order"),
        F.max(price).alias("max_order"),
    )


def product_daily(df: DataFrame, null_as_zero: bool = False) -> DataFrame:
    """Interactions, users, stage counts and revenue per product and day."""
    result = entity_rollup(
        with_event_date(df).filter(F.col("product_id").isNotNull()),
        ["event_date", "product_id"], "user_id",
        distinct={"unique_users": None},
        counts={"total_interactions": None, "views": is_type(VIEW),
                "cart_adds": is_type(CART), "purchases": is_type(BUY)},
        sums={"revenue": money_in().cast("decimal(10,2)")},
    )
    return result.fillna({"revenue": 0}) if null_as_zero else result


def device_daily(df: DataFrame) -> DataFrame:
    return entity_rollup(
        with_event_date(df), ["event_date", "device"], "user_id",
        distinct={"unique_users": None},
        counts={"event_count": None, "purchases": is_type(BUY)},
        sums={"revenue": money_in().cast("decimal(10,2)")},
    )


class GoldTable(NamedTuple):
    """How a daily table is built, what identifies a row, and how it is partitioned."""

    build: Callable[[DataFrame], DataFrame]
    keys: list[str]
    partitions: tuple[str, ...] = ()


# Only the product table grows with more than days and devices, so only it is
# partitioned: an upsert rewrites the days it touches and no others.
GOLD_TABLES = {
    "gold_daily_active_users": GoldTable(daily_active_users, ["event_date"]),
    "gold_conversion_funnel": GoldTable(conversion_funnel, ["event_date"]),
    "gold_daily_revenue": GoldTable(daily_revenue, ["event_date"]),
    "gold_top_products": GoldTable(product_daily, ["event_date", "product_id"], ("event_date",)),
    "gold_events_by_device": GoldTable(device_daily, ["event_date", "device"]),
}


def since_hwm(df: DataFrame, hwm: str) -> DataFrame:
    """Rows of event dates after the mark.

    On a table partitioned by year/month/day the date is also compared through
    the partition columns; a predicate on event_time alone reads every partition.
    """
    after = F.to_date(F.lit(hwm))
    sliced = with_event_date(df).filter(F.col("event_date") > after)
    if {"year", "month", "day"} <= set(df.columns):
        parts = [F.col(c).cast("int") for c in ("year", "month", "day")]
        sliced = sliced.filter(F.make_date(*parts) > after)
    return sliced


def ingested_since(
    df: DataFrame, hwm: str, overlap: timedelta = timedelta(0), column: str = "ingestion_timestamp"
) -> DataFrame:
    """Rows that arrived after the mark less ``overlap``, whatever day they belong to."""
    mark = F.lit(hwm).cast(df.schema[column].dataType)
    return df.filter(F.col(column) > mark - F.lit(overlap))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table name."""
    parts = [df.agg(F.count("*").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.union(part)
    return counts
