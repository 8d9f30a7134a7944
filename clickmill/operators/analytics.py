"""Analyst queries over the fact, the gold tables and the session-grain fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.functions.rollup import entity_rollup
from clickmill.operators import gold
from clickmill.operators.gold import BUY, is_type, money_in


def between_dates(df: DataFrame, lo: str, hi: str) -> DataFrame:
    """Inclusive date range; the bounds are literals, so they reach the scan."""
    return df.filter(F.col("event_date").between(F.to_date(F.lit(lo)), F.to_date(F.lit(hi))))


def days_before(as_of: str, days: int) -> Column:
    return F.date_sub(F.to_date(F.lit(as_of)), days)


def dau_range(fact: DataFrame, lo: str, hi: str) -> DataFrame:
    counted = gold.daily_active_users(between_dates(fact, lo, hi))
    return counted.drop("purchasing_users").orderBy("event_date")


def funnel_range(fact: DataFrame, lo: str, hi: str) -> DataFrame:
    return gold.conversion_funnel(between_dates(fact, lo, hi)).orderBy("event_date")


def revenue_range(fact: DataFrame, lo: str, hi: str) -> DataFrame:
    return gold.daily_revenue(between_dates(fact, lo, hi)).orderBy("event_date")


def top_products(fact: DataFrame, n: int = 10) -> DataFrame:
    """Best-selling products by revenue; equal revenue falls back to product_id."""
    bought = fact.filter(is_type(BUY) & F.col("product_id").isNotNull())
    totals = entity_rollup(
        bought, ["product_id"], "user_id",
        distinct={"unique_buyers": None},
        counts={"purchase_count": None, "priced": F.col("price").isNotNull()},
        sums={"total_revenue": F.col("price")},
    )
    mean = F.round(F.try_divide(F.col("total_revenue"), F.col("priced")), 2)
    return (
        totals.withColumn("avg_price", mean).drop("priced")
        .orderBy(F.desc("total_revenue"), "product_id").limit(n)
    )


def device_share(fact: DataFrame) -> DataFrame:
    """Traffic and revenue per device with their shares of the whole.

    The unpartitioned window sees one row per device of the closed device list.
    """
    per_device = entity_rollup(
        fact, ["device"], "user_id",
        distinct={"unique_users": None},
        counts={"event_count": None},
        sums={"revenue": F.coalesce(money_in(), F.lit(0).cast("decimal(10,2)"))},
    )
    everything = Window.partitionBy()

    def share(column: str) -> Column:
        return F.round(
            F.try_divide(F.col(column).cast("double") * 100.0, F.sum(column).over(everything).cast("double")), 2
        )

    return per_device.withColumns(
        {"pct_of_total": share("event_count"), "pct_of_revenue": share("revenue")}
    ).orderBy(F.desc("event_count"), "device")


def duplicate_audit(fact: DataFrame, n: int = 20) -> DataFrame:
    """The most repeated event ids with the span of their copies; empty when clean."""
    spans = {"seen": "event_time", "ingested": "ingestion_timestamp"}
    bounds = [F.min(c).alias(f"first_{s}") for s, c in spans.items()]
    bounds += [F.max(c).alias(f"last_{s}") for s, c in spans.items()]
    copies = fact.groupBy("event_id").agg(F.count("*").alias("occurrence_count"), *bounds)
    return (
        copies.filter(F.col("occurrence_count") > 1)
        .orderBy(F.desc("occurrence_count"), "event_id").limit(n)
    )


def weekday_sales(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Purchases by weekday and device.

    Facts are reduced to one row per day and device before they meet the
    dimension, so the join is small whatever the fact holds.
    """
    daily = fact.filter(is_type(BUY)).groupBy("event_date", "device").agg(
        F.count("*").alias("n"), F.count("price").alias("priced"), F.sum("price").alias("revenue")
    )
    days = dim_date.select(F.col("date_key").alias("event_date"), "day_name", "is_weekend")
    sums = daily.join(days, "event_date").groupBy("day_name", "is_weekend", "device").agg(
        F.sum("n").alias("purchases"), F.sum("revenue").alias("revenue"), F.sum("priced").alias("priced")
    )
    mean = F.round(F.try_divide(F.col("revenue"), F.col("priced")), 2)
    return (
        sums.withColumn("avg_order_value", mean).drop("priced")
        .orderBy("is_weekend", F.desc("revenue"), "day_name", "device")
    )


def abandoned_cart(facts: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Per device: sessions that filled a cart, and those that also checked out."""
    recent = facts.filter(F.col("event_timestamp") >= days_before(as_of, days))
    carts = recent.filter(is_type("add_to_cart")).select("session_id", "user_id", "device_type").distinct()
    checked_out = (
        recent.filter(is_type("checkout_complete")).select("session_id").distinct()
        .withColumn("_done", F.lit(True))
    )
    totals = carts.join(checked_out, "session_id", "left").groupBy("device_type").agg(
        F.count("session_id").alias("total_add_to_cart_sessions"),
        F.count_if("_done").alias("total_completed_checkouts"),
    )
    rate = gold.percent("total_completed_checkouts", "total_add_to_cart_sessions")
    return totals.withColumn("conversion_rate_pct", rate).orderBy(
        F.desc("conversion_rate_pct"), "device_type"
    )


def time_to_cart(
    facts: DataFrame, as_of: str, days: int = 7,
    start: str = "page_view", then: str = "add_to_cart",
    max_seconds: int = 3600, slot_seconds: int = 900,
) -> DataFrame:
    """Mean seconds from ``start`` to a ``then`` that directly follows in the session.

    A session is ordered in time slots: pairs inside a slot are found there, and
    each slot passes only its first and last event on to pair neighbouring slots.
    A session with very many events is thereby spread over its slots.
    """
    recent = facts.filter(F.col("event_timestamp") >= days_before(as_of, days)).select(
        "session_id", "event_type", F.col("event_timestamp").alias("at"), "event_id",
        F.floor(_seconds(F.col("event_timestamp")) / slot_seconds).alias("slot"),
    )
    in_slot = Window.partitionBy("session_id", "slot").orderBy("at", "event_id")

    def wanted(kind: Column, at: Column, next_kind: Column, next_at: Column) -> Column:
        gap = _seconds(next_at) - _seconds(at)
        return F.when((kind == start) & (next_kind == then) & (gap < max_seconds), gap)

    paired = recent.withColumns({f"next_{c}": F.lead(c).over(in_slot) for c in ("event_type", "at")})
    inside = wanted(F.col("event_type"), F.col("at"), F.col("next_event_type"), F.col("next_at"))
    event = F.struct("at", "event_id", "event_type")
    slots = paired.groupBy("session_id", "slot").agg(
        F.sum(inside).alias("seconds"), F.count(inside).alias("pairs"),
        F.min(event).alias("head"), F.max(event).alias("tail"),
    )
    along = Window.partitionBy("session_id").orderBy("slot")
    across = wanted(
        F.col("tail.event_type"), F.col("tail.at"), F.col("follow.event_type"), F.col("follow.at")
    )
    totals = slots.withColumn("follow", F.lead("head").over(along)).agg(
        (F.coalesce(F.sum("seconds"), F.lit(0)) + F.coalesce(F.sum(across), F.lit(0))).alias("seconds"),
        (F.sum("pairs") + F.count(across)).alias("pairs"),
    )
    return totals.select(
        F.try_divide(F.col("seconds"), F.col("pairs")).alias("avg_seconds_to_add_to_cart")
    )


def _seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def cumulative_revenue(facts: DataFrame, regions: DataFrame, as_of: str) -> DataFrame:
    """Running year-to-date revenue per region and day.

    Revenue is summed per user and day before the join, so a user with very many
    purchases meets the dimension in as many rows as there are days.
    """
    year_start = F.trunc(F.to_date(F.lit(as_of)), "year")
    ts = F.col("event_timestamp")
    this_year = facts.filter(
        is_type("checkout_complete") & (ts >= year_start) & (ts < F.add_months(year_start, 12))
    )
    per_user = this_year.groupBy("user_id", F.to_date(ts).alias("revenue_date")).agg(
        F.sum(F.col("price") * F.col("quantity")).alias("revenue")
    )
    daily = per_user.join(regions.select("user_id", "region"), "user_id").groupBy(
        "region", "revenue_date"
    ).agg(F.sum("revenue").alias("daily_revenue"))
    running = (
        Window.partitionBy("region").orderBy("revenue_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.withColumn("cumulative_revenue_ytd", F.sum("daily_revenue").over(running)).orderBy(
        "region", "revenue_date"
    )


def orphans(fact: DataFrame, dim: DataFrame, key: str = "user_id") -> DataFrame:
    """How many facts refer to a key the dimension lacks, counted per key first."""
    per_key = fact.groupBy(key).agg(F.count("event_id").alias("_n"))
    missing = per_key.join(dim.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphaned_event_count"))


def incomplete_sessions(facts: DataFrame, n: int = 10) -> DataFrame:
    """The longest sessions that never logged their start."""
    sessions = facts.groupBy("session_id").agg(
        F.count("*").alias("total_events"), F.count_if(is_type("session_start")).alias("starts")
    )
    return (
        sessions.filter(F.col("starts") == 0).drop("starts")
        .orderBy(F.desc("total_events"), "session_id").limit(n)
    )


def kpi_join(revenue: DataFrame, dau: DataFrame, n: int = 30) -> DataFrame:
    joined = revenue.select("event_date", "total_revenue").join(
        dau.select("event_date", "daily_active_users"), "event_date"
    )
    return joined.orderBy(F.desc("event_date")).limit(n)


def last_days(df: DataFrame, as_of: str, n: int = 7) -> DataFrame:
    return df.filter(F.col("event_date") >= days_before(as_of, n)).orderBy(F.desc("event_date"))


def partner_products(products: DataFrame, as_of: str) -> DataFrame:
    """What a partner may see: four columns of the last month."""
    month_ago = F.add_months(F.to_date(F.lit(as_of)), -1)
    return products.filter(F.col("event_date") >= month_ago).select(
        "event_date", "product_id", "views", "purchases"
    )


def revenue_series(daily_revenue: DataFrame) -> DataFrame:
    """A daily table as the two-column series an anomaly check reads."""
    return daily_revenue.select(
        F.col("event_date").cast("timestamp_ntz").alias("ts"), F.col("total_revenue").cast("double").alias("y")
    )


def revenue_anomalies(
    series: DataFrame, window: int = 7, k: float = 3.0, flagged_only: bool = True
) -> DataFrame:
    """Days outside ``k`` deviations of the mean of the ``window`` days before them.

    The series has one row per day, which bounds the ordered window.
    """
    before = Window.partitionBy().orderBy("ts").rowsBetween(-window, -1)
    mean, spread = F.avg("y").over(before), F.stddev_samp("y").over(before)
    scored = series.select("ts", "y", mean.alias("forecast"), spread.alias("_sd")).select(
        "ts", "y", "forecast",
        (F.col("forecast") - k * F.col("_sd")).alias("lower_bound"),
        (F.col("forecast") + k * F.col("_sd")).alias("upper_bound"),
    )
    outside = (F.col("y") < F.col("lower_bound")) | (F.col("y") > F.col("upper_bound"))
    scored = scored.withColumn("is_anomaly", F.coalesce(outside, F.lit(False)))
    return scored.filter("is_anomaly") if flagged_only else scored


def fit_season(series: DataFrame, until: str) -> DataFrame:
    """Least-squares model y = level of the weekday + slope * day, fitted on the days up to ``until``.

    One row per weekday with its level, and the common slope, residual deviation and number of
    training days. Both come from sums per weekday: the slope from deviations within weekdays,
    which is the least-squares slope beside weekday levels; without two weeks it is 0. The
    deviation divides by the days less the weekdays and the slope; without a day to spare it
    is missing.
    """
    days = _numbered(series).filter((F.col("ts") <= F.lit(until).cast("timestamp_ntz")) & F.col("y").isNotNull())
    per_weekday = days.groupBy("weekday").agg(
        F.count("*").alias("n"), F.avg("day").alias("mean_day"), F.avg("y").alias("mean_y"),
        F.regr_sxx("y", "day").alias("sxx"), F.regr_sxy("y", "day").alias("sxy"), F.regr_syy("y", "day").alias("syy"))
    whole = per_weekday.agg(
        F.sum("sxx").alias("sxx"), F.sum("sxy").alias("sxy"), F.sum("syy").alias("syy"), F.sum("n").alias("training_days"),
        F.count("*").alias("weekdays"), F.collect_list(F.struct("weekday", "mean_day", "mean_y")).alias("levels"))
    slope = F.coalesce(F.try_divide("sxy", "sxx"), F.lit(0.0))
    spare = F.col("training_days") - F.col("weekdays") - F.when(F.col("sxx") > 0, 1).otherwise(0)
    left = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    return whole.withColumn("slope", slope).select(
        F.inline("levels"), "slope", F.sqrt(F.when(spare > 0, left / spare)).alias("deviation"), "training_days",
    ).select("weekday", (F.col("mean_y") - F.col("slope") * F.col("mean_day")).alias("level"), "slope", "deviation", "training_days")


def detect_season(series: DataFrame, model: DataFrame, k: float = 3.0, after: str | None = None) -> DataFrame:
    """Forecast and interval of each day (after ``after``), and whether the day lies outside.

    A weekday that training has not seen has no forecast and is no anomaly.
    """
    days = _numbered(series)
    if after is not None:
        days = days.filter(F.col("ts") > F.lit(after).cast("timestamp_ntz"))
    forecast = F.col("level") + F.col("slope") * F.col("day")
    scored = days.join(model, "weekday", "left").select(
        "ts", "y", forecast.alias("forecast"), (forecast - k * F.col("deviation")).alias("lower_bound"),
        (forecast + k * F.col("deviation")).alias("upper_bound"))
    outside = (F.col("y") < F.col("lower_bound")) | (F.col("y") > F.col("upper_bound"))
    return scored.withColumn("is_anomaly", F.coalesce(outside, F.lit(False)))


def _numbered(series: DataFrame) -> DataFrame:
    """Weekday (Sunday = 0) and number of each day of a series."""
    day = F.datediff(F.to_date("ts"), F.lit("2000-01-01").cast("date"))
    return series.select("ts", "y", (F.dayofweek("ts") - 1).alias("weekday"), day.cast("double").alias("day"))
