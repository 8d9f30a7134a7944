"""Raw payloads to routed records: decode, validate, enrich, route, summarise."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill import constants as C
from clickmill.functions import payload as P


def as_instant(now: datetime | str | Column) -> Column:
    """A clock value given by the caller; operators never read the clock."""
    return now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp")


def iso_text(instant: Column) -> Column:
    return F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def decode_payload(df: DataFrame, col: str = "data") -> DataFrame:
    """Base64 text to UTF-8 ``payload``; what cannot be decoded becomes NULL."""
    return df.withColumn("payload", F.try_to_binary(F.col(col), F.lit("base64")).cast("string"))


def parse_payload(df: DataFrame, col: str = "payload") -> DataFrame:
    """Add ``record`` as VARIANT, NULL where the text is not JSON, and typed ``event``."""
    return df.withColumns({"record": P.record_of(col), "event": P.typed(col)})


def _settle(reason: Column, name: str) -> Column:
    """A computed column that later filters read instead of repeating.

    A filter on a plain computed column is pushed below it, which would copy all
    checks and their VARIANT lookups into the predicate. Predicates on the output
    of ``explode`` stay above it; the array has exactly one element.
    """
    return F.explode(F.array(reason)).alias(name)


def _unpacked(df: DataFrame) -> DataFrame:
    """Typed values and JSON kinds; records that are sound at sight are not parsed to VARIANT."""
    flag = P.helper("sound")
    if "record" in df.columns:
        df = df.withColumn(flag, F.lit(False))
    else:
        typed = df.withColumn("event", P.typed("payload"))
        settled = typed.select("*", _settle(P.sound(F.col("payload"), F.col("event")), flag))
        df = settled.withColumn("record", F.when(~F.col(flag), P.record_of("payload")))
    return df.select("*", *P.unpack(F.col("payload"), F.col("record"), F.col("event")))


def with_rejection_reason(
    df: DataFrame, now: datetime | str | Column, tolerance_seconds: int = 0
) -> DataFrame:
    """Add ``rejection_reason``: the first failing check, NULL for valid records.

    Text that is not JSON gets its own reason, so it is never taken for valid.
    Shape and content are two steps to keep each generated method small enough
    for the JVM to compile.
    """
    r, unpacked = P.unpacked(), _unpacked(df)
    carried = [c for c in unpacked.columns if not c.startswith(P.helper(""))]
    shape = F.when(F.col(P.helper("sound")), F.lit(None)).otherwise(
        F.when(F.col("record").isNull(), F.lit(C.UNPARSEABLE)).otherwise(P.shape_reason(r)))
    content = P.content_reason(r, as_instant(now), tolerance_seconds)
    shaped = unpacked.select("*", _settle(shape, "_shape"))
    return shaped.select(
        *carried, _settle(F.coalesce(F.col("_shape"), content), "rejection_reason")
    )


def check_family(df: DataFrame, family: str, now: datetime | str | Column) -> DataFrame:
    """Add ``reason`` from one family only: schema, type, enum or anomaly."""
    r, unpacked = P.unpacked(), _unpacked(df)
    carried = [c for c in unpacked.columns if not c.startswith(P.helper(""))]
    checks = {
        "schema": lambda: P.schema_reason(r), "type": lambda: P.type_reason(r),
        "enum": lambda: P.enum_reason(r), "anomaly": lambda: P.anomaly_reason(r, as_instant(now)),
    }
    return unpacked.select(*carried, _settle(checks[family](), "reason"))


def event_columns() -> list[Column]:
    """The typed event as table columns; ids beyond the integer range become NULL."""
    names = (*C.REQUIRED_FIELDS[:4], "product_id", "price", *C.REQUIRED_FIELDS[4:])
    return [
        F.col(f"event.{n}").try_cast("int").alias(n) if n in ("user_id", "product_id")
        else F.col(f"event.{n}").alias(n)
        for n in names
    ]


def enrich(df: DataFrame, now: datetime | str | Column) -> DataFrame:
    """Stamp valid records with ingestion time and processing date, both text."""
    instant = as_instant(now)
    return df.withColumns({
        "ingestion_timestamp": iso_text(instant),
        "processing_date": F.date_format(instant, "yyyy-MM-dd"),
    })


class Routes(NamedTuple):
    valid: DataFrame
    quarantined: DataFrame
    unparseable: DataFrame


def route(checked: DataFrame, now: datetime | str | Column) -> Routes:
    """Split checked records into bronze, quarantine and undecodable rows.

    Three filters over the same lineage; a caller that writes all three should
    persist ``checked`` first. Quarantined rows keep their raw payload.
    """
    reason = F.col("rejection_reason")
    internal = ("record", "event", "rejection_reason", "payload", "data")
    carried = [c for c in checked.columns if c not in internal]
    valid = enrich(
        checked.filter(reason.isNull()).select(*carried, *event_columns()), now
    )
    quarantined = (
        checked.filter(reason.isNotNull() & (reason != C.UNPARSEABLE))
        .select(*carried, *event_columns(), "payload", "rejection_reason")
        .withColumn("_quarantine_timestamp", iso_text(as_instant(now)))
    )
    unparseable = checked.filter(reason == C.UNPARSEABLE).drop("record", "event", "rejection_reason")
    return Routes(valid, quarantined, unparseable)


def ingest_summary(checked: DataFrame) -> DataFrame:
    """One row: received, valid, quarantined and undecodable records."""
    reason = F.col("rejection_reason")
    broken = F.count_if(reason == C.UNPARSEABLE)
    return checked.agg(
        F.count("*").alias("total_received"),
        F.count_if(reason.isNull()).alias("valid_count"),
        F.count_if(reason != C.UNPARSEABLE).alias("quarantine_count"),
        broken.alias("parse_errors"),
    )
