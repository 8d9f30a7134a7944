"""Retail-shaped views over the driver's test tables, in Spark and as SQL text.

``events`` is mapped onto the columns of the event contract; every view below is
derived from it (or from ``orders``) with the same rule in both engines. The
views hold all rows of their table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.constants import COUNTRIES

AS_OF = "2024-01-31"
NOW = "2026-12-01 00:00:00"
INGESTED = "2024-03-01 00:00:00"

EVENT_NAMES = {
    "view": "product_view", "click": "add_to_cart", "purchase": "purchase",
    "signup": "login", "error": "logout",
}
SESSION_NAMES = {
    "product_view": "page_view", "purchase": "checkout_complete", "login": "session_start",
    "add_to_cart": "add_to_cart", "logout": "logout",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rename(column: str, names: dict[str, str]) -> Column:
    chain = F
    for old, new in names.items():
        chain = chain.when(F.col(column) == old, new)
    return chain


def case(column: str, names: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + " END"


def retail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    shopping = "event_type IN ('view', 'click', 'purchase')"
    slot = "(event_id * 7 + user_id) % 20"
    countries = ", ".join(f"'{c}'" for c in COUNTRIES)
    return table(spark, sf_dir, "events").selectExpr(
        "concat('evt-', lpad(string(event_id), greatest(8, length(string(event_id))), '0')) AS event_id",
        "event_id AS src_id",
        "ts AS event_time",
        "date(ts) AS event_date",
        "int(user_id + 1) AS user_id",
        f"{case('event_type', EVENT_NAMES)} AS event_type",
        f"CASE WHEN {shopping} THEN int(1001 + int(get_json_object(props, '$.k')) % 50) END AS product_id",
        f"CASE WHEN {shopping} THEN CAST(value AS DECIMAL(10,2)) END AS price",
        f"CASE WHEN {slot} < 11 THEN 'mobile' WHEN {slot} < 18 THEN 'desktop' ELSE 'tablet' END AS device",
        f"element_at(array({countries}), int(user_id % 13 + 1)) AS country",
        "ts + make_interval(0, 0, 0, 0, 0, 0, event_id % 300) AS ingestion_timestamp",
        "value",
    )


RETAIL_SQL = """
retail_events AS (
  SELECT concat('evt-', lpad(CAST(event_id AS VARCHAR), CAST(greatest(8, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0')) AS event_id,
         event_id AS src_id, ts AS event_time, CAST(ts AS DATE) AS event_date,
         CAST(user_id + 1 AS INTEGER) AS user_id,
         CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
              WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'login' WHEN 'error' THEN 'logout' END AS event_type,
         CASE WHEN event_type IN ('view','click','purchase')
              THEN CAST(1001 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 50 AS INTEGER) END AS product_id,
         CASE WHEN event_type IN ('view','click','purchase') THEN CAST(value AS DECIMAL(10,2)) END AS price,
         CASE WHEN (event_id * 7 + user_id) % 20 < 11 THEN 'mobile'
              WHEN (event_id * 7 + user_id) % 20 < 18 THEN 'desktop' ELSE 'tablet' END AS device,
         list_extract(['US','IN','GB','DE','FR','JP','BR','CA','AU','SG','TH','MY','KR'],
                      CAST(user_id % 13 + 1 AS INTEGER)) AS country,
         ts + to_seconds(CAST(event_id % 300 AS INTEGER)) AS ingestion_timestamp, value
  FROM events)"""


def retail_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, and a second, later and different copy of some of them."""
    events = retail_events(spark, sf_dir)
    later = F.col("ingestion_timestamp") + F.make_interval(secs=F.lit(600))
    copies = events.filter(F.col("src_id") % 25 == 0).withColumns(
        {"device": F.lit("tablet"), "ingestion_timestamp": later}
    )
    return events.unionByName(copies)


BRONZE_SQL = RETAIL_SQL + """,
retail_bronze AS (
  SELECT * FROM retail_events
  UNION ALL
  SELECT * REPLACE ('tablet' AS device, ingestion_timestamp + INTERVAL 600 SECOND AS ingestion_timestamp)
  FROM retail_events WHERE src_id % 25 = 0)"""


def zulu(column: str) -> Column:
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


# One damage per reason code: JSON text put in place of a field (None leaves it out), and the
# reason that follows. A damage of the whole record replaces the payload.
DAMAGES: list[tuple[dict[str, str | None], str]] = [
    ({"device": None}, "missing_fields:device"),
    ({"event_type": '"wish_list"'}, "invalid_event_type:wish_list"),
    ({"event_type": '"purchase"', "product_id": "733", "price": "-0.0005"}, "anomaly_price_too_low:-0.0005"),
    ({"user_id": '"n/a"'}, "user_id_not_integer"),
    ({"event_time": '"2088-02-29T06:07:08+00:00"'}, "anomaly_future_timestamp"),
    ({"event_type": '"login"', "product_id": None, "price": "12.5"}, "anomaly_login_has_price"),
    ({"event_type": '"logout"', "product_id": None, "price": "8.75"}, "anomaly_logout_has_price"),
    ({"event_id": '"tiny"'}, "invalid_event_id_format"),
    ({"event_time": '"half past ten"'}, "invalid_event_time_format"),
    ({"event_type": "17"}, "event_type_not_string"),
    ({"device": "true"}, "device_not_string"),
    ({"country": "[1]"}, "country_not_string"),
    ({"product_id": '"n/a"'}, "product_id_not_integer"),
    ({"price": '"free"'}, "price_not_numeric"),
    ({"device": '"kiosk"'}, "invalid_device:kiosk"),
    ({"country": '"ZZ"'}, "invalid_country:ZZ"),
    ({"event_type": '"add_to_cart"', "product_id": "734", "price": "1e17"}, "anomaly_price_too_high:1e+17"),
    ({"user_id": "100000000000000000000"}, "anomaly_user_id_out_of_range:100000000000000000000"),
    ({"event_type": '"purchase"', "product_id": None, "price": "15.25"}, "anomaly_purchase_missing_product_id"),
    ({"event_type": '"purchase"', "product_id": "735", "price": None}, "anomaly_purchase_missing_price"),
    ({"*": '"no record"'}, "record_is_not_dict"),
]
FAMILIES = ("schema", "type", "enum", "anomaly")


def family_of(reason: str) -> str:
    if reason.startswith("missing") or reason == "record_is_not_dict":
        return "schema"
    return "anomaly" if reason.startswith("anomaly") else "enum" if ":" in reason else "type"


def damage() -> Column:
    """Number of the damage done to a row, -1 for a sound one."""
    return F.when(F.col("src_id") % 20 == 3, F.floor(F.col("src_id") / 20) % len(DAMAGES)).otherwise(-1)


def retail_raw(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    """Events as JSON text, one in twenty damaged in one of the ways above.

    ``carry`` names event columns to keep beside the payload.
    """
    e = retail_events(spark, sf_dir).withColumn("cls", damage())
    number = {c: F.col(c).cast("string") for c in ("user_id", "product_id")}
    number["price"] = F.col("price").cast("double").cast("string")
    text = {c: F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in ("event_id", "event_type", "device", "country")}
    text["event_time"] = F.concat(F.lit('"'), zulu("event_time"), F.lit('"'))
    fields = []
    for field in ("event_id", "event_time", "user_id", "event_type", "product_id", "price", "device", "country"):
        value = {**number, **text}[field]
        for cls, (changes, _) in enumerate(DAMAGES):
            if field in changes:
                value = F.when(F.col("cls") == cls, F.lit(changes[field])).otherwise(value)
        fields.append(F.concat(F.lit(f'"{field}":'), value))
    payload = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    for cls, (changes, _) in enumerate(DAMAGES):
        if "*" in changes:
            payload = F.when(F.col("cls") == cls, changes["*"]).otherwise(payload)
    return e.select("src_id", *carry, payload.alias("payload"))


def _typed_sql(field: str, sound: str, number: bool = False) -> str:
    """The typed value of a field after the damage: text as it is, what is no number NULL."""
    cases = []
    for cls, (changes, _) in enumerate(DAMAGES):
        if "*" in changes or changes.get(field, "") is None:
            cases.append(f"WHEN {cls} THEN NULL")
        elif field in changes:
            raw = changes[field]
            good = not number or not raw.startswith('"') and len(raw) < 19
            shown = raw if number else "'" + raw.strip('"') + "'"
            cases.append(f"WHEN {cls} THEN {shown if good else 'NULL'}")
    return f"CASE cls {' '.join(cases)} ELSE {sound} END" if cases else sound


def _present_sql(field: str) -> str:
    """Whether the record names the field with a value of any kind."""
    cases = " ".join(f"WHEN {cls} THEN {'*' not in changes and changes.get(field) is not None}"
                     for cls, (changes, _) in enumerate(DAMAGES) if "*" in changes or field in changes)
    return f"CASE cls {cases} ELSE {field} IS NOT NULL END"


def _reasons_sql(family: str) -> str:
    return " ".join(f"WHEN cls = {cls} THEN '{reason}'" for cls, (_, reason) in enumerate(DAMAGES) if family_of(reason) == family)


_ISO_SQL = "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00')"

# The reason follows from the damage and the values it leaves, so the oracle needs no JSON at all.
RAW_SQL = RETAIL_SQL + f""",
retail_damaged AS (
  SELECT *, {_typed_sql('event_id', 'event_id')} AS q_event_id, {_typed_sql('event_time', _ISO_SQL)} AS q_event_time,
         CAST({_typed_sql('user_id', 'user_id', True)} AS INTEGER) AS q_user_id,
         {_typed_sql('event_type', 'event_type')} AS q_event_type,
         CAST({_typed_sql('product_id', 'product_id', True)} AS INTEGER) AS q_product_id,
         {_typed_sql('price', 'CAST(price AS DOUBLE)', True)} AS q_price,
         {_typed_sql('device', 'device')} AS q_device, {_typed_sql('country', 'country')} AS q_country,
         {_present_sql('product_id')} AS has_product, {_present_sql('price')} AS has_price
  FROM (SELECT *, CASE WHEN src_id % 20 = 3 THEN (src_id // 20) % {len(DAMAGES)} ELSE -1 END AS cls FROM retail_events)),
retail_families AS (
  SELECT *, CASE {_reasons_sql('schema')} END AS schema_reason,
    CASE {_reasons_sql('type')} WHEN q_event_id IS NULL THEN 'invalid_event_id_format'
         WHEN q_device IS NULL THEN 'device_not_string' END AS type_reason,
    CASE {_reasons_sql('enum')} WHEN q_event_type IS NULL OR q_event_type = '17' THEN 'invalid_event_type:' || coalesce(q_event_type, '')
         WHEN q_device IS NULL OR q_device = 'true' THEN 'invalid_device:' || coalesce(q_device, '')
         WHEN q_country = '[1]' THEN 'invalid_country:[1]' END AS enum_reason,
    CASE WHEN q_price = 0 THEN 'anomaly_price_too_low:0.0' {_reasons_sql('anomaly')}
         WHEN q_event_type IN ('login', 'logout') AND has_price THEN 'anomaly_' || q_event_type || '_has_price' END AS anomaly_reason
  FROM retail_damaged),
retail_reasons AS (
  SELECT *, coalesce(schema_reason, type_reason, enum_reason, anomaly_reason) AS rejection_reason FROM retail_families)"""


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected records as routed, a few of them without a reason, with their day."""
    from clickmill.operators.ingest import route, with_rejection_reason

    bad = route(with_rejection_reason(retail_raw(spark, sf_dir), NOW), INGESTED).quarantined
    unnamed = (F.col("event_type") == "wish_list") & (F.col("device") == "tablet")
    reason = F.when(~F.coalesce(unnamed, F.lit(False)), F.col("rejection_reason"))
    return bad.drop("payload").withColumns(
        {"rejection_reason": reason, "ingestion_timestamp": F.lit(None).cast("string")}
    )


QUARANTINE_SQL = RAW_SQL + """,
quarantine AS (
  SELECT src_id, q_event_id AS event_id, event_date, q_event_time AS event_time, q_user_id AS user_id,
         q_event_type AS event_type, q_product_id AS product_id, CAST(q_price AS DOUBLE) AS price,
         q_device AS device, q_country AS country,
         CASE WHEN q_event_type = 'wish_list' AND q_device = 'tablet' THEN NULL ELSE rejection_reason END AS rejection_reason
  FROM retail_reasons WHERE rejection_reason IS NOT NULL)"""


def session_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session-grain fact: a session is a user's day."""
    return retail_events(spark, sf_dir).selectExpr(
        "event_id", "user_id", "concat_ws('-', user_id, event_date) AS session_id",
        "event_time AS event_timestamp", "device AS device_type",
        f"{case('event_type', SESSION_NAMES)} AS event_type",
        "price", "int(1 + src_id % 3) AS quantity", "country",
    )


SESSION_SQL = RETAIL_SQL + """,
session_facts AS (
  SELECT event_id, user_id, concat(CAST(user_id AS VARCHAR), '-', CAST(event_date AS VARCHAR)) AS session_id,
         event_time AS event_timestamp, device AS device_type,
         CASE event_type WHEN 'product_view' THEN 'page_view' WHEN 'purchase' THEN 'checkout_complete'
              WHEN 'login' THEN 'session_start' ELSE event_type END AS event_type,
         price, CAST(1 + src_id % 3 AS INTEGER) AS quantity, country
  FROM retail_events)"""


def user_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User dimension with a region; some users are missing from it."""
    region = (
        F.when(F.col("country").isin("US", "CA", "BR"), "AMER")
        .when(F.col("country").isin("GB", "DE", "FR"), "EMEA").otherwise("APAC")
    )
    e = retail_events(spark, sf_dir)
    return e.filter(F.col("user_id") % 50 != 0).select("user_id", region.alias("region")).distinct()


REGION_SQL = SESSION_SQL + """,
user_regions AS (
  SELECT DISTINCT user_id, CASE WHEN country IN ('US','CA','BR') THEN 'AMER'
         WHEN country IN ('GB','DE','FR') THEN 'EMEA' ELSE 'APAC' END AS region
  FROM retail_events WHERE user_id % 50 <> 0)"""


def component_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured log lines: one validator line per raw record, one producer line per session event."""
    from clickmill.operators.ingest import with_rejection_reason

    lines = ("timestamp", "component", "status", "rejection_reason", "processing_time_ms", "message")
    checked = with_rejection_reason(retail_raw(spark, sf_dir, "event_time", "value"), NOW)
    validator = checked.withColumns({
        "timestamp": F.col("event_time"),
        "component": F.lit("validator"),
        "status": F.when(F.col("rejection_reason").isNull(), "valid").otherwise("quarantined"),
        "processing_time_ms": F.col("value") / 10,
        "message": F.lit(None).cast("string"),
    })
    return validator.select(*lines).unionByName(producer_log(spark, sf_dir).select(*lines))


def producer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error"))
    sent = F.concat(F.lit("batch_sent records="), (F.col("event_id") % 25 + 1).cast("string"))
    waits = F.concat(F.lit("retry_backoff attempt="), (F.col("event_id") % 3 + 1).cast("string"))
    return e.select(
        F.col("ts").alias("timestamp"), F.lit("producer").alias("component"),
        F.when(F.col("event_type") == "signup", "sent").otherwise("error").alias("status"),
        F.lit(None).cast("string").alias("rejection_reason"),
        F.lit(None).cast("double").alias("processing_time_ms"),
        F.when(F.col("event_type") == "signup", sent).otherwise(waits).alias("message"),
    )


LOG_SQL = RAW_SQL + """,
component_log AS (
  SELECT r.event_time AS "timestamp", 'validator' AS component,
         CASE WHEN rejection_reason IS NULL THEN 'valid' ELSE 'quarantined' END AS status,
         rejection_reason, value / 10 AS processing_time_ms, NULL AS message
  FROM retail_reasons r
  UNION ALL
  SELECT ts, 'producer', CASE event_type WHEN 'signup' THEN 'sent' ELSE 'error' END, NULL, NULL,
         CASE event_type WHEN 'signup' THEN concat('batch_sent records=', CAST(event_id % 25 + 1 AS VARCHAR))
              ELSE concat('retry_backoff attempt=', CAST(event_id % 3 + 1 AS VARCHAR)) END
  FROM events WHERE event_type IN ('signup', 'error'))"""


def pipeline_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record and one data-quality record per day, with JSON details."""
    from clickmill.operators.ingest import with_rejection_reason

    raw = with_rejection_reason(retail_raw(spark, sf_dir, "event_date"), NOW)
    daily = raw.groupBy(F.col("event_date").alias("d")).agg(
        F.count_if(F.col("rejection_reason").isNull()).alias("ok"),
        F.count_if(F.col("rejection_reason").isNotNull()).alias("bad"),
        F.count("*").alias("n"),
    )
    day = F.dayofmonth("d")
    state = F.when(day % 5 == 0, "FAILED").otherwise("COMPLETED")
    backlog = F.when(day % 7 == 0, F.col("n") * 10).otherwise(0)
    run = F.to_json(F.struct(F.struct(
        state.alias("state"), F.date_format("d", "yyyy-MM-dd'T'01:00:00").alias("creation_time"),
        F.struct(backlog.alias("backlog_bytes")).alias("metrics"),
    ).alias("update_progress")))

    def rule(name: str, passed: Column, failed: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit("events_silver").alias("dataset"),
                        passed.alias("passed_records"), failed.alias("failed_records"))

    flow = F.to_json(F.struct(F.struct(
        F.lit("events_silver").alias("name"),
        F.struct(F.array(
            rule("valid_record", F.col("ok"), F.col("bad")),
            rule("valid_event_id", F.col("n"), F.lit(0).cast("bigint")),
        ).alias("expectations")).alias("data_quality"),
    ).alias("flow_progress")))
    stamp = F.col("d").cast("timestamp_ntz")
    return daily.select(
        stamp.alias("timestamp"),
        F.inline(F.array(
            F.struct(F.lit("update_progress").alias("event_type"), run.alias("details")),
            F.struct(F.lit("flow_progress").alias("event_type"), flow.alias("details")),
        )),
    )


PIPELINE_SQL = RAW_SQL + """,
daily AS (
  SELECT event_date AS d, count(*) FILTER (rejection_reason IS NULL) AS ok,
         count(*) FILTER (rejection_reason IS NOT NULL) AS bad, count(*) AS n
  FROM retail_reasons GROUP BY 1)"""


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as a query log: the price is the run time in milliseconds."""
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "FAIL").otherwise("SUCCESS")
    return o.select(
        F.col("o_orderkey").alias("query_id"),
        F.concat(F.lit("SELECT * FROM t"), F.col("o_custkey").cast("string")).alias("query_text"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("start_time"),
        F.col("o_totalprice").alias("execution_time"),
        (F.col("o_custkey") * 1048576).alias("bytes_scanned"),
        F.col("o_custkey").alias("rows_produced"),
        F.col("o_orderpriority").alias("warehouse_name"),
        status.alias("execution_status"),
        F.when(F.col("o_orderpriority") != "5-LOW", "X-Small").alias("warehouse_size"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("credits_used"),
    )


HISTORY_SQL = """
query_history AS (
  SELECT o_orderkey AS query_id, concat('SELECT * FROM t', CAST(o_custkey AS VARCHAR)) AS query_text,
         CAST(o_orderdate AS TIMESTAMP) AS start_time, o_totalprice AS execution_time,
         o_custkey * 1048576 AS bytes_scanned, o_custkey AS rows_produced, o_orderpriority AS warehouse_name,
         CASE o_orderstatus WHEN 'F' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status,
         CASE WHEN o_orderpriority <> '5-LOW' THEN 'X-Small' END AS warehouse_size,
         CAST(o_totalprice AS DECIMAL(18,2)) AS credits_used
  FROM orders)"""

LAYERS = {
    "product_view": ("shop.bronze.events_bronze", "shop.silver.events_silver", "event_id"),
    "add_to_cart": ("shop.silver.events_silver", "shop.gold.gold_conversion_funnel", "cart_adders"),
    "purchase": ("shop.silver.events_silver", "shop.gold.gold_daily_revenue", "total_revenue"),
    "login": ("shop.silver.events_silver", "shop.gold.gold_daily_active_users", "daily_active_users"),
    "logout": ("lab.tmp.scratch", "lab.tmp.trial", "x"),
}


def lineage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as lineage records: what was written depends on the event type."""
    e = retail_events(spark, sf_dir)

    def part(i: int) -> Column:
        return rename("event_type", {k: v[i] for k, v in LAYERS.items()})

    kind = F.when(F.col("event_type") == "purchase", "AGGREGATE").otherwise("DIRECT")
    return e.select(
        part(0).alias("source_table_full_name"), part(1).alias("target_table_full_name"),
        F.when(F.col("event_type") == "purchase", "price").otherwise("user_id").alias("source_column_name"),
        part(2).alias("target_column_name"), kind.alias("transformation_type"),
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("created_by"), "event_time",
    )


LINEAGE_SQL = RETAIL_SQL + """,
lineage AS (
  SELECT CASE event_type WHEN 'product_view' THEN 'shop.bronze.events_bronze'
              WHEN 'logout' THEN 'lab.tmp.scratch' ELSE 'shop.silver.events_silver' END AS source_table_full_name,
         CASE event_type WHEN 'product_view' THEN 'shop.silver.events_silver'
              WHEN 'add_to_cart' THEN 'shop.gold.gold_conversion_funnel'
              WHEN 'purchase' THEN 'shop.gold.gold_daily_revenue'
              WHEN 'login' THEN 'shop.gold.gold_daily_active_users' ELSE 'lab.tmp.trial' END AS target_table_full_name,
         CASE event_type WHEN 'purchase' THEN 'price' ELSE 'user_id' END AS source_column_name,
         CASE event_type WHEN 'product_view' THEN 'event_id' WHEN 'add_to_cart' THEN 'cart_adders'
              WHEN 'purchase' THEN 'total_revenue' WHEN 'login' THEN 'daily_active_users' ELSE 'x' END AS target_column_name,
         CASE event_type WHEN 'purchase' THEN 'AGGREGATE' ELSE 'DIRECT' END AS transformation_type,
         concat('job-', CAST(user_id AS VARCHAR)) AS created_by, event_time
  FROM retail_events)"""


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as access records with nested identity and request fields."""
    e = retail_events(spark, sf_dir)
    action = rename("event_type", {
        "product_view": "getTable", "add_to_cart": "queryData", "purchase": "runCommand",
        "login": "login", "logout": "logout",
    })
    return e.select(
        "event_time",
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
                 .alias("email")).alias("user_identity"),
        action.alias("action_name"),
        F.struct(F.when(F.col("device") == "tablet", "lab.tmp.trial").otherwise(
            F.concat(F.lit("shop.gold.t"), F.col("event_id"))).alias("full_name")).alias("request_params"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")).alias("source_ip_address"),
    )


AUDIT_SQL = RETAIL_SQL + """,
audit AS (
  SELECT event_time, concat('user', CAST(user_id AS VARCHAR), '@example.com') AS email,
         CASE event_type WHEN 'product_view' THEN 'getTable' WHEN 'add_to_cart' THEN 'queryData'
              WHEN 'purchase' THEN 'runCommand' ELSE event_type END AS action_name,
         CASE WHEN device = 'tablet' THEN 'lab.tmp.trial' ELSE concat('shop.gold.t', event_id) END AS full_name,
         concat('10.0.0.', CAST(user_id % 250 AS VARCHAR)) AS source_ip_address
  FROM retail_events)"""
