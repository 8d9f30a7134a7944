"""Expectations on typed rows, and repair of quarantined ones."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickmill import constants as C
from clickmill.functions.rollup import share_of_group
from clickmill.operators.ingest import as_instant


def _holds(predicate: str) -> Column:
    """A rule that evaluates to NULL counts as failed."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def expect_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Keep the rows on which every named rule holds."""
    return df.filter(reduce(lambda a, b: a & b, [_holds(p) for p in rules.values()]))


def failure(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows that fail a rule, with the name of the first one as ``rejection_reason``."""
    reason = F.coalesce(*[F.when(~_holds(p), F.lit(name)) for name, p in rules.items()])
    return df.withColumn("rejection_reason", reason).filter(F.col("rejection_reason").isNotNull())


def expectation_counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Passed and failed rows per rule, from a single aggregation over the input."""
    passed = df.agg(F.count("*").alias("_all"), *[
        F.count_if(_holds(p)).alias(f"_p{i}") for i, p in enumerate(rules.values())
    ])
    per_rule = F.array(*[
        F.struct(
            F.lit(name).alias("rule_name"),
            F.col(f"_p{i}").alias("passed_records"),
            (F.col("_all") - F.col(f"_p{i}")).alias("failed_records"),
        )
        for i, name in enumerate(rules)
    ])
    return passed.select(F.inline(per_rule))


def observed(df: DataFrame, rules: dict[str, str], seen: Observation) -> DataFrame:
    """``df``, whose next action also counts the rows on which each rule holds.

    The counts cost no pass of their own. A task that is run again after a failure counts
    its rows again.
    """
    passed = [F.count_if(_holds(p)).alias(name) for name, p in rules.items()]
    return df.observe(seen, F.count("*").alias("_all"), *passed)


def observed_counts(found: dict[str, int], rules: dict[str, str]) -> dict[str, dict[str, int]]:
    return {name: {"passed": found[name], "failed": found["_all"] - found[name]} for name in rules}


def classify(df: DataFrame, repairable: tuple[str, ...] = C.REPAIRABLE_REASONS) -> DataFrame:
    """Add ``is_repairable``; a missing reason means it cannot be repaired."""
    known = F.coalesce(F.col("rejection_reason").isin(*repairable), F.lit(False))
    return df.withColumn("is_repairable", known)


def repair_price(df: DataFrame) -> DataFrame:
    """Sign-in and sign-out rows carry neither price nor product."""
    return (
        df.filter(F.col("rejection_reason").isin(*C.PRICE_REPAIR_REASONS))
        .withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in ("price", "product_id")})
        .drop("rejection_reason")
    )


def repair_time(df: DataFrame) -> DataFrame:
    """Rows from a fast clock take the time they were received or quarantined."""
    received = F.coalesce("ingestion_timestamp", "_quarantine_timestamp")
    return (
        df.filter(F.col("rejection_reason").isin(*C.TIME_REPAIR_REASONS))
        .withColumn("event_time", received)
        .drop("rejection_reason")
    )


def recovered(df: DataFrame) -> DataFrame:
    """All repaired rows in one pass over the quarantine, ready for bronze."""
    reason = F.col("rejection_reason")
    clear = reason.isin(*C.PRICE_REPAIR_REASONS)
    late = reason.isin(*C.TIME_REPAIR_REASONS)
    fixes = {c: F.when(~clear, F.col(c)) for c in ("price", "product_id")}
    fixes["event_time"] = F.when(
        late, F.coalesce("ingestion_timestamp", "_quarantine_timestamp")
    ).otherwise(F.col("event_time"))
    return df.filter(clear | late).withColumns(fixes).drop("rejection_reason")


def dead_letter(df: DataFrame, now: datetime | str | Column) -> DataFrame:
    """Rows beyond repair, stamped with the time they were given up."""
    return (
        classify(df).filter(~F.col("is_repairable")).drop("is_repairable")
        .withColumn("dead_lettered_at", as_instant(now))
    )


def reason_breakdown(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("rejection_reason").agg(F.count("*").alias("failures"))
        .orderBy(F.desc("failures"), "rejection_reason")
    )


def recovery_summary(df: DataFrame) -> DataFrame:
    """Totals and the recovered share, rounded to one decimal."""
    counts = classify(df).agg(
        F.count("*").alias("total_quarantined"),
        F.count_if("is_repairable").alias("recovered_count"),
    )
    rate = F.try_divide(F.col("recovered_count") * 100.0, F.col("total_quarantined"))
    return counts.select(
        "*",
        (F.col("total_quarantined") - F.col("recovered_count")).alias("unrecoverable_count"),
        F.round(rate, 1).alias("recovery_rate"),
    )


def quarantine_trend(df: DataFrame, day: str = "event_date") -> DataFrame:
    """Failures per day and reason, with the reason's share of its day."""
    daily = df.groupBy(day, "rejection_reason").agg(F.count("*").alias("failure_count"))
    return share_of_group(daily, [day], "failure_count", "pct_of_daily_failures")
