"""Explicit schemas of the layers."""

from pyspark.sql import types as T

KINDS = {
    "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "money": T.DecimalType(10, 2),
}


def columns(**kinds: str) -> T.StructType:
    """A schema from column names and the short type names above."""
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in kinds.items()])


EVENT = {
    "event_id": "string", "event_time": "string", "user_id": "int", "event_type": "string",
    "product_id": "int", "price": "double", "device": "string", "country": "string",
}

BRONZE = columns(**EVENT, ingestion_timestamp="string", processing_date="string")

QUARANTINE = columns(
    **EVENT, ingestion_timestamp="string", processing_date="string",
    rejection_reason="string", _quarantine_timestamp="string",
)

# year, month and day are zero-padded text; reading them back with this schema
# keeps them text instead of letting partition inference turn "01" into 1.
SILVER = columns(
    **{**EVENT, "event_time": "timestamp"}, ingestion_timestamp="timestamp",
    year="string", month="string", day="string",
)

PARTITION_COLUMNS = ("year", "month", "day")

# Casts applied when staged columnar files are loaded into the serving tables.
STAGED_CASTS = {
    "gold_daily_active_users": {
        "event_date": "date", "daily_active_users": "int", "total_events": "int",
        "purchasing_users": "int",
    },
    "gold_conversion_funnel": {
        "event_date": "date", "viewers": "int", "cart_adders": "int", "purchasers": "int",
        "view_to_cart_pct": "decimal(5,2)", "cart_to_purchase_pct": "decimal(5,2)",
    },
    "gold_daily_revenue": {
        "event_date": "date", "purchase_count": "int", "total_revenue": "decimal(12,2)",
        "avg_order_value": "decimal(10,2)", "min_order": "decimal(10,2)",
        "max_order": "decimal(10,2)",
    },
    "gold_top_products": {
        "event_date": "date", "product_id": "int", "total_interactions": "int",
        "unique_users": "int", "views": "int", "cart_adds": "int", "purchases": "int",
        "revenue": "decimal(12,2)",
    },
    "gold_events_by_device": {
        "event_date": "date", "device": "string", "event_count": "int",
        "unique_users": "int", "purchases": "int", "revenue": "decimal(12,2)",
    },
    "fact_events": {
        "event_id": "string", "event_time": "timestamp_ntz", "user_id": "int",
        "event_type": "string", "product_id": "int", "price": "decimal(10,2)",
        "device": "string", "country": "string", "ingestion_timestamp": "timestamp_ntz",
    },
}

EXPECTATION_RESULTS = (
    "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"
)
