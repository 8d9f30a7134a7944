"""User, product and date dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.operators.gold import BUY, CART, VIEW, is_type, money_in


def dim_users(fact: DataFrame) -> DataFrame:
    """One row per user: activity span, usual device and country, totals.

    Rows are first counted per user, device and country, on the map side too, so a user with
    very many events is a few rows by the time all of them meet. The usual value is the most
    frequent one, on a tie the smallest.
    """
    places = fact.groupBy("user_id", "device", "country").agg(
        F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"), F.count("*").alias("n"),
        F.count_if(is_type(BUY)).alias("bought"), F.sum(money_in()).alias("revenue"))
    # Once per device, once per country: (negative count, value), whose least one is the usual value.
    both = places.select(
        "user_id", "first_seen", "last_seen", "n", "bought", "revenue",
        F.inline(F.array(F.struct(F.lit(True).alias("is_device"), F.col("device").alias("value")),
                         F.struct(F.lit(False).alias("is_device"), F.col("country").alias("value")))))
    per_value = both.groupBy("user_id", "is_device", "value").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.sum("n").alias("n"), F.sum("bought").alias("bought"), F.sum("revenue").alias("revenue"))
    device, known = F.col("is_device"), F.col("value").isNotNull()
    ranked = F.struct(-F.col("n"), F.col("value").alias("value"))
    return per_value.groupBy("user_id").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.min(F.when(device & known, ranked))["value"].alias("primary_device"),
        F.min(F.when(~device & known, ranked))["value"].alias("primary_country"),
        F.sum(F.when(device, F.col("n"))).alias("total_events"),
        F.sum(F.when(device, F.col("bought"))).alias("total_purchases"),
        F.coalesce(F.sum(F.when(device, F.col("revenue"))), F.lit(0)).cast("decimal(12,2)").alias("total_revenue"),
    )


def dim_products(fact: DataFrame) -> DataFrame:
    """One row per product; the rate is NULL, not 0, when nothing was bought."""
    counted = fact.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        F.try_divide(F.sum("price"), F.count("price")).cast("decimal(10,2)").alias("avg_price"),
        F.count_if(is_type(VIEW)).alias("total_views"),
        F.count_if(is_type(CART)).alias("total_cart_adds"),
        F.count_if(is_type(BUY)).alias("total_purchases"),
    )
    bought = F.nullif(F.col("total_purchases"), F.lit(0).cast("bigint"))
    rate = F.round(F.try_divide(bought * F.lit(100.0), F.col("total_views")), 2)
    return counted.withColumn("conversion_rate", rate)


def date_spine(spark: SparkSession, start: str | Column, days: int | Column) -> DataFrame:
    """``days`` consecutive dates from ``start`` as ``date_key``."""
    first = F.to_date(F.lit(start))
    last = F.date_add(first, F.lit(days) - 1)
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("date_key"))


def spine_over(df: DataFrame, column: str) -> DataFrame:
    """Every date between the first and the last one found in ``column``."""
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("date_key")
    )


def describe_dates(spine: DataFrame) -> DataFrame:
    """Calendar columns per date; day_of_week counts from Sunday = 0."""
    d = F.col("date_key")
    weekday = F.dayofweek(d) - 1
    return spine.select(
        d, F.year(d).alias("year"), F.month(d).alias("month"), F.day(d).alias("day"),
        weekday.alias("day_of_week"), F.dayname(d).alias("day_name"),
        F.monthname(d).alias("month_name"), F.quarter(d).alias("quarter"),
        weekday.isin(0, 6).alias("is_weekend"), F.weekofyear(d).alias("week_of_year"),
    )


def dim_date(spark: SparkSession, start: str = "2024-01-01", days: int = 730) -> DataFrame:
    return describe_dates(date_spine(spark, start, days))
