"""Daily state that merges over days: distinct users as bitmaps, sums, least and greatest.

A state row holds, for a day, the values of the ``by`` columns, an event type and a block of
32,768 user ids: which users of the block occurred, and the event figures of all its rows. Rows
of one day are replaced together, so a change of one day leaves all other rows alone; totals
over any days are folded from the state alone, distinct users included, without the events.

A bitmap has 4 KB whatever it holds; empty stretches vanish in compressed shuffles and files.
Where ``by`` has very many values of few users each, that is the price of folding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.operators.gold import BUY, CART, VIEW, is_type, with_event_date

MEASURES = ("users", "events", "priced", "revenue", "least_price", "greatest_price")


def daily_state(df: DataFrame, by: list[str]) -> DataFrame:
    """State of the days in ``df``; rows without one of the ``by`` values are left out."""
    known = with_event_date(df)
    for c in by:
        known = known.filter(F.col(c).isNotNull())
    price = F.col("price").cast("decimal(10,2)")
    return known.groupBy("event_date", *by, "event_type", F.bitmap_bucket_number("user_id").alias("user_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"),
        F.count("*").alias("events"), F.count(price).alias("priced"),
        F.sum(price).cast("decimal(20,2)").alias("revenue"),
        F.min(price).alias("least_price"), F.max(price).alias("greatest_price"))


def _users(condition: Column | None = None) -> Column:
    """Users of a block that occur in rows with the condition."""
    own = F.col("users") if condition is None else F.when(condition, F.col("users"))
    return F.coalesce(F.bitmap_count(F.bitmap_or_agg(own)), F.lit(0).cast("long"))


def fold(state: DataFrame, by: list[str | Column]) -> DataFrame:
    """Figures per group of ``by`` (days, periods or items), merged from state rows.

    Blocks of users are merged on their own and their counts added, so no group holds more
    than one block of users in a task.
    """
    names = [c if isinstance(c, str) else None for c in by]
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    keyed = state.withColumns({f"_k{i}": c for i, c in enumerate(keys)})
    own = [f"_k{i}" for i in range(len(keys))]
    buys = is_type(BUY)
    blocks = keyed.groupBy(*own, "user_block").agg(
        _users().alias("users"), _users(is_type(VIEW)).alias("viewers"), _users(is_type(CART)).alias("cart_adders"),
        _users(buys).alias("purchasers"), F.sum("events").alias("events"),
        F.sum(F.when(is_type(VIEW), F.col("events"))).alias("views"), F.sum(F.when(is_type(CART), F.col("events"))).alias("cart_adds"),
        F.sum(F.when(buys, F.col("events"))).alias("purchases"), F.sum(F.when(buys, F.col("priced"))).alias("priced_purchases"),
        F.sum(F.when(buys, F.col("revenue"))).alias("revenue"), F.min(F.when(buys, F.col("least_price"))).alias("min_order"),
        F.max(F.when(buys, F.col("greatest_price"))).alias("max_order"))
    sums = ["users", "viewers", "cart_adders", "purchasers", "events", "views", "cart_adds", "purchases", "priced_purchases"]
    folded = blocks.groupBy(*own).agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in sums], F.sum("revenue").alias("revenue"),
        F.min("min_order").alias("min_order"), F.max("max_order").alias("max_order"))
    return folded.withColumnsRenamed({o: n or f"period{i or ''}" for i, (o, n) in enumerate(zip(own, names))})


def period(unit: str) -> Column:
    """First day of the week, month, quarter or year of a state row."""
    return F.to_date(F.date_trunc(unit, F.col("event_date")))
