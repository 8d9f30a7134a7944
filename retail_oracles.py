"""The same results as plain SQL over the test tables, one statement per query."""

from __future__ import annotations

from fixtures import (
    AUDIT_SQL, BRONZE_SQL, FAMILIES, HISTORY_SQL, LINEAGE_SQL, LOG_SQL, PIPELINE_SQL, QUARANTINE_SQL,
    RAW_SQL, REGION_SQL, RETAIL_SQL, SESSION_SQL,
)

ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"
EVENT = "event_id, user_id, event_type, product_id, CAST(price AS DOUBLE) AS price, device, country"
PARTS = """strftime(event_time, '%Y') AS "year", strftime(event_time, '%m') AS "month", strftime(event_time, '%d') AS "day\""""
WIRE = f"""event_id, strftime(event_time, {ISO}) AS event_time, user_id, event_type, product_id,
  CAST(price AS DOUBLE) AS price, device, country, strftime(ingestion_timestamp, {ISO}) AS ingestion_timestamp,
  strftime(ingestion_timestamp, '%Y-%m-%d') AS processing_date"""


def sql(views: str, body: str, extra: str = "") -> str:
    return f"WITH {views.strip()}{',' if extra else ''} {extra} {body}"


def pick(source: str, keep: str, where: str = "true") -> str:
    """One row per event id, the earliest or latest ingestion."""
    order = "ASC" if keep == "first" else "DESC"
    return (f"SELECT * FROM {source} WHERE {where} QUALIFY row_number() OVER "
            f"(PARTITION BY event_id ORDER BY ingestion_timestamp {order}) = 1")


def half_up(a: str, b: str, digits: int = 2) -> str:
    """a / b rounded half up, in whole numbers, so no binary fraction decides a tie."""
    scale = 10 ** digits
    return (f"CAST((CAST({a} AS HUGEINT) * {2 * scale} + ({b})) // nullif(2 * ({b}), 0) AS DOUBLE) / {scale}")


def pct(a: str, b: str, digits: int = 2) -> str:
    return half_up(f"({a}) * 100", b, digits)


def mean(total: str, n: str) -> str:
    """Mean of a DECIMAL(.., 2) sum, rounded half up to cents."""
    return (f"CAST((CAST(({total}) * 100 AS HUGEINT) * 2 + ({n})) // nullif(2 * ({n}), 0) AS DOUBLE) / 100")


DAU = """SELECT CAST(event_date AS VARCHAR) AS event_date, count(DISTINCT user_id) AS daily_active_users,
  count(*) AS total_events, count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS purchasing_users
  FROM {src} GROUP BY event_date"""

FUNNEL = f"""SELECT CAST(event_date AS VARCHAR) AS event_date, viewers, cart_adders, purchasers,
  {pct('cart_adders', 'viewers')} AS view_to_cart_pct,
  {pct('purchasers', 'cart_adders')} AS cart_to_purchase_pct
  FROM (SELECT event_date, count(DISTINCT CASE WHEN event_type = 'product_view' THEN user_id END) AS viewers,
    count(DISTINCT CASE WHEN event_type = 'add_to_cart' THEN user_id END) AS cart_adders,
    count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS purchasers
    FROM {{src}} GROUP BY event_date)"""

REVENUE = f"""SELECT CAST(event_date AS VARCHAR) AS event_date, count(*) AS purchase_count,
  CAST(sum(price) AS DOUBLE) AS total_revenue, {mean('sum(price)', 'count(*)')} AS avg_order_value,
  CAST(min(price) AS DOUBLE) AS min_order, CAST(max(price) AS DOUBLE) AS max_order
  FROM {{src}} WHERE event_type = 'purchase' AND price IS NOT NULL GROUP BY event_date"""

PRODUCT = """SELECT CAST(event_date AS VARCHAR) AS event_date, product_id, count(*) AS total_interactions,
  count(DISTINCT user_id) AS unique_users, count(CASE WHEN event_type = 'product_view' THEN 1 END) AS views,
  count(CASE WHEN event_type = 'add_to_cart' THEN 1 END) AS cart_adds,
  count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN price END) AS DOUBLE) AS revenue
  FROM {src} WHERE product_id IS NOT NULL GROUP BY event_date, product_id"""

DEVICE = """SELECT CAST(event_date AS VARCHAR) AS event_date, device, count(*) AS event_count,
  count(DISTINCT user_id) AS unique_users, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN price END) AS DOUBLE) AS revenue
  FROM {src} GROUP BY event_date, device"""

USERS = """SELECT u.*, d.device AS primary_device, c.country AS primary_country FROM
  (SELECT user_id, min(event_time) AS first_seen, max(event_time) AS last_seen, count(*) AS total_events,
     count(CASE WHEN event_type = 'purchase' THEN 1 END) AS total_purchases,
     CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN price END), 0) AS DOUBLE) AS total_revenue
   FROM {src} GROUP BY user_id) u
  JOIN (SELECT user_id, device FROM {src} GROUP BY user_id, device
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, device) = 1) d USING (user_id)
  JOIN (SELECT user_id, country FROM {src} GROUP BY user_id, country
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, country) = 1) c USING (user_id)"""

LO_HI = "(SELECT * FROM retail_events WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')"
QUARANTINE_OUT = "src_id, event_id, event_time, user_id, event_type, product_id, price, device, country"
PRICE_FIX = "('anomaly_login_has_price', 'anomaly_logout_has_price')"
LATER = "WHERE event_date >= DATE '2024-01-10'"

ORACLES: dict[str, str] = {}

# --- sources and sinks -------------------------------------------------------
ORACLES["read_ndjson"] = sql(BRONZE_SQL, f"SELECT {WIRE} FROM retail_bronze")
ORACLES["stream_ndjson"] = ORACLES["read_ndjson"]
ORACLES["infer_and_pin_schema"] = sql(
    BRONZE_SQL, f"SELECT * REPLACE (CAST(user_id AS BIGINT) AS user_id, CAST(product_id AS BIGINT) AS product_id) "
                f"FROM (SELECT {WIRE} FROM retail_bronze)")
ORACLES["read_table"] = "SELECT event_id, user_id, event_type, value, props FROM events"
ORACLES["scan_table"] = sql(RETAIL_SQL, DAU.format(src="retail_events"))
ORACLES["load_staged"] = sql(RETAIL_SQL, f"""SELECT {EVENT}, event_time, ingestion_timestamp FROM retail_events
  WHERE NOT (event_type = 'purchase' AND device = 'tablet')""")
ORACLES["stream_load"] = ORACLES["load_staged"]
ORACLES["read_hwm"] = """SELECT '2020-01-01' AS "before", CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS "after",
  count(*) AS events FROM events"""
ORACLES["write_partitions"] = sql(BRONZE_SQL, f"""SELECT {EVENT}, {PARTS} FROM retail_events
  WHERE event_date < DATE '2024-01-20' UNION ALL
  SELECT {EVENT}, {PARTS} FROM ({pick('retail_bronze', 'last', "event_date >= DATE '2024-01-20'")})""")
ORACLES["append_ndjson"] = sql(RETAIL_SQL, f"SELECT {EVENT} FROM retail_events")
ORACLES["append_table"] = sql(QUARANTINE_SQL, f"""SELECT rejection_reason, 2 * count(*) AS "rows", CAST(2 AS BIGINT) AS runs
  FROM quarantine WHERE rejection_reason IS NULL OR rejection_reason NOT IN
  ('anomaly_login_has_price', 'anomaly_logout_has_price', 'anomaly_future_timestamp') GROUP BY 1""")
ORACLES["export_table"] = sql(RETAIL_SQL, REVENUE.format(src="retail_events"))
ORACLES["upsert"] = sql(
    BRONZE_SQL, """SELECT * FROM source UNION ALL
  SELECT * FROM target WHERE event_date NOT IN (SELECT event_date FROM source)""",
    f"""target AS ({REVENUE.format(src="(SELECT * FROM retail_events WHERE event_date < DATE '2024-01-16')")}),
  source AS ({REVENUE.format(src=f"(SELECT * FROM retail_bronze {LATER})")})""")
ORACLES["upsert_path"] = ORACLES["upsert"]
ORACLES["upsert_cols"] = sql(
    RETAIL_SQL, """SELECT user_id, coalesce(t.first_seen, s.first_seen) AS first_seen,
  coalesce(s.last_seen, t.last_seen) AS last_seen, coalesce(s.total_events, t.total_events) AS total_events,
  coalesce(s.total_purchases, t.total_purchases) AS total_purchases,
  coalesce(s.total_revenue, t.total_revenue) AS total_revenue,
  coalesce(s.primary_device, t.primary_device) AS primary_device,
  coalesce(s.primary_country, t.primary_country) AS primary_country
  FROM target t FULL OUTER JOIN source s USING (user_id)""",
    f"""early AS (SELECT * FROM retail_events WHERE event_date < DATE '2024-01-16'),
  late AS (SELECT * FROM retail_events {LATER}),
  target AS ({USERS.format(src='early')}), source AS ({USERS.format(src='late')})""")
ORACLES["append_evolving"] = sql(RETAIL_SQL, f"""SELECT {EVENT}, CAST(event_date AS VARCHAR) AS event_date,
  CASE WHEN event_date >= DATE '2024-01-16' THEN concat('sess-', CAST(user_id AS VARCHAR)) END AS session_id
  FROM retail_events""")
ORACLES["compact"] = sql(RETAIL_SQL, f"SELECT {EVENT}, {PARTS} FROM retail_events")
ORACLES["as_of"] = sql(BRONZE_SQL, """SELECT count(*) AS row_count_before_incident FROM retail_bronze
  WHERE ingestion_timestamp <= TIMESTAMP '2024-01-20 12:00:00'""")
ORACLES["restore"] = sql(BRONZE_SQL, f"""SELECT {EVENT}, ingestion_timestamp FROM
  ({pick('retail_bronze', 'last', "ingestion_timestamp <= TIMESTAMP '2024-01-20 12:00:00'")})""")
_FEED = "event_id, user_id, event_type, product_id, price, device, country, event_date"
ORACLES["change_feed"] = sql(
    BRONZE_SQL, f"""SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(event_date AS VARCHAR) AS event_date) FROM (
  SELECT *, 'insert' AS _change_type FROM new WHERE event_id NOT IN (SELECT event_id FROM old)
  UNION ALL SELECT *, 'delete' FROM old WHERE event_id NOT IN (SELECT event_id FROM new)
  UNION ALL SELECT o.*, 'update_preimage' FROM old o JOIN new n USING (event_id) WHERE o IS DISTINCT FROM n
  UNION ALL SELECT n.*, 'update_postimage' FROM old o JOIN new n USING (event_id) WHERE o IS DISTINCT FROM n)""",
    f"""old AS (SELECT {_FEED} FROM ({pick('retail_bronze', 'first')}) WHERE event_date < DATE '2024-01-28'),
  new AS (SELECT {_FEED} FROM ({pick('retail_bronze', 'last')}) WHERE country <> 'KR')""")
ORACLES["date_spine"] = sql(RETAIL_SQL, """SELECT CAST(date_key AS VARCHAR) AS date_key, purchase_count FROM
  (SELECT CAST(unnest(generate_series(min(event_date), max(event_date), INTERVAL 1 DAY)) AS DATE) AS date_key FROM retail_events)
  LEFT JOIN (SELECT event_date AS date_key, count(*) AS purchase_count FROM retail_events
             WHERE event_type = 'purchase' AND price IS NOT NULL GROUP BY 1) USING (date_key)""")
ORACLES["literal_rows"] = sql(RETAIL_SQL, f"""SELECT {EVENT}, CAST(NULL AS VARCHAR) AS session_id FROM retail_events
  UNION ALL SELECT * FROM (VALUES ('added-row-a', 880001, 'logout', NULL::INTEGER, NULL::DOUBLE, 'tablet', 'MY', 'visit-7'),
  ('added-row-b', 880002, 'add_to_cart', 905, 3.5::DOUBLE, 'mobile', 'TH', 'visit-8'),
  ('added-row-c', 880003, 'login', NULL, NULL, 'desktop', 'SG', NULL))""")
ORACLES["insert_missing"] = sql(REGION_SQL, """SELECT user_id, region FROM user_regions UNION ALL
  SELECT DISTINCT user_id, 'UNKNOWN' FROM retail_events WHERE user_id NOT IN (SELECT user_id FROM user_regions)""")
ORACLES["refresh_if_stale"] = sql(
    RETAIL_SQL, f"SELECT *, CAST(2 AS INTEGER) AS rebuilds FROM ({DAU.format(src='retail_events')})")

# --- ingestion quality -------------------------------------------------------
ORACLES["decode_payload"] = sql(RAW_SQL, """SELECT src_id, device <> 'tablet' AS is_json,
  CASE WHEN device <> 'tablet' THEN q_event_id END AS event_id FROM retail_damaged""")
for _family in FAMILIES:
    ORACLES[f"{_family}_reason"] = sql(RAW_SQL, f"SELECT src_id, {_family}_reason AS reason FROM retail_reasons")
ORACLES["with_rejection_reason"] = sql(RAW_SQL, "SELECT src_id, rejection_reason FROM retail_reasons")
ORACLES["enrich"] = sql(RAW_SQL, """SELECT src_id, '2024-03-01T00:00:00+00:00' AS ingestion_timestamp,
  '2024-03-01' AS processing_date FROM retail_reasons WHERE rejection_reason IS NULL""")
ORACLES["route"] = sql(QUARANTINE_SQL, f"""SELECT event_id, event_time, user_id, event_type, product_id, price,
  device, country, 'quarantine' AS "route" FROM quarantine UNION ALL
  SELECT event_id, strftime(event_time, {ISO}), user_id, event_type, product_id, CAST(price AS DOUBLE), device, country,
  'bronze' FROM retail_reasons WHERE rejection_reason IS NULL""")
ORACLES["ingest_summary"] = sql(RAW_SQL, """SELECT count(*) AS total_received,
  count(*) FILTER (rejection_reason IS NULL) AS valid_count,
  count(*) FILTER (rejection_reason IS NOT NULL) AS quarantine_count, CAST(0 AS BIGINT) AS parse_errors
  FROM retail_reasons""")
ORACLES["expect_or_drop"] = sql(RETAIL_SQL, f"""SELECT {EVENT} FROM retail_events
  WHERE event_id IS NOT NULL AND price >= 5 AND product_id IS NOT NULL""")
ORACLES["expectation_counts"] = sql(RETAIL_SQL, """SELECT rule_name, passed_records, n - passed_records AS failed_records FROM (
  SELECT 'valid_event_id' AS rule_name, count(event_id) AS passed_records, count(*) AS n FROM retail_events
  UNION ALL SELECT 'valid_price', count(*) FILTER (price >= 5), count(*) FROM retail_events
  UNION ALL SELECT 'known_product', count(product_id), count(*) FROM retail_events)""")
_REPAIRABLE = "('anomaly_login_has_price', 'anomaly_logout_has_price', 'anomaly_future_timestamp')"
ORACLES["classify"] = sql(QUARANTINE_SQL, f"""SELECT src_id, rejection_reason,
  coalesce(rejection_reason IN {_REPAIRABLE}, false) AS is_repairable FROM quarantine""")
_PRICE_FIXED = f"""SELECT src_id, event_id, event_time, user_id, event_type, CAST(NULL AS INTEGER) AS product_id,
  CAST(NULL AS DOUBLE) AS price, device, country FROM quarantine WHERE rejection_reason IN {PRICE_FIX}"""
_TIME_FIXED = """SELECT src_id, event_id, '2024-03-01T00:00:00+00:00' AS event_time, user_id, event_type, product_id,
  price, device, country FROM quarantine WHERE rejection_reason = 'anomaly_future_timestamp'"""
ORACLES["repair_price"] = sql(QUARANTINE_SQL, _PRICE_FIXED)
ORACLES["repair_time"] = sql(QUARANTINE_SQL, _TIME_FIXED)
ORACLES["recovered"] = sql(QUARANTINE_SQL, f"{_PRICE_FIXED} UNION ALL {_TIME_FIXED}")
ORACLES["dead_letter"] = sql(QUARANTINE_SQL, f"""SELECT {QUARANTINE_OUT}, rejection_reason,
  TIMESTAMP '2024-03-01 00:00:00' AS dead_lettered_at FROM quarantine
  WHERE rejection_reason IS NULL OR rejection_reason NOT IN {_REPAIRABLE}""")
ORACLES["reason_breakdown"] = sql(
    QUARANTINE_SQL, "SELECT rejection_reason, count(*) AS failures FROM quarantine GROUP BY 1")
ORACLES["recovery_summary"] = sql(QUARANTINE_SQL, f"""SELECT *, total_quarantined - recovered_count AS unrecoverable_count,
  {pct('recovered_count', 'total_quarantined', 1)} AS recovery_rate FROM (
  SELECT count(*) AS total_quarantined, count(*) FILTER (rejection_reason IN {_REPAIRABLE}) AS recovered_count FROM quarantine)""")
ORACLES["quarantine_trend"] = sql(RAW_SQL, f"""SELECT CAST(event_date AS VARCHAR) AS event_date, rejection_reason,
  count(*) AS failure_count,
  {pct('count(*)', 'sum(count(*)) OVER (PARTITION BY event_date)')} AS pct_of_daily_failures
  FROM retail_reasons WHERE rejection_reason IS NOT NULL GROUP BY event_date, rejection_reason""")

# --- silver ------------------------------------------------------------------
ORACLES["cast_types"] = sql(RETAIL_SQL, """SELECT event_id, event_time,
  CASE WHEN device <> 'tablet' THEN ingestion_timestamp END AS ingestion_timestamp FROM retail_events""")
ORACLES["duplicate_keys"] = sql(
    BRONZE_SQL, "SELECT event_id, count(*) AS occurrences FROM retail_bronze GROUP BY 1 HAVING count(*) > 1")
ORACLES["dedup"] = sql(
    BRONZE_SQL, f"SELECT {EVENT}, ingestion_timestamp FROM ({pick('retail_bronze', 'first')})")
ORACLES["apply_changes"] = sql(
    BRONZE_SQL, f"""SELECT {EVENT}, ingestion_timestamp FROM (SELECT * FROM merged QUALIFY row_number() OVER
  (PARTITION BY event_id ORDER BY ingestion_timestamp DESC) = 1) WHERE NOT (event_type = 'logout' AND country = 'KR')""",
    f"""merged AS ({pick('retail_bronze', 'first', "event_date < DATE '2024-01-16'")}
  UNION ALL SELECT * FROM retail_bronze {LATER})""")
_KEPT = "NOT (device = 'tablet' AND src_id % 50 = 0)"
ORACLES["apply_changes_with_deletes"] = sql(
    BRONZE_SQL, f"SELECT {EVENT}, ingestion_timestamp FROM ({pick('retail_bronze', 'last')}) WHERE {_KEPT}")
ORACLES["deletes_in_memory"] = sql(
    BRONZE_SQL, f"""SELECT {EVENT}, ingestion_timestamp, false AS is_deleted FROM latest WHERE {_KEPT}
  UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, ingestion_timestamp, true FROM latest WHERE NOT ({_KEPT})""",
    f"latest AS ({pick('retail_bronze', 'last')})")
ORACLES["upsert_bucketed"] = ORACLES["upsert"]
_VERSIONS = f"""firsts AS ({pick('retail_bronze', 'first')}), lasts AS ({pick('retail_bronze', 'last')}),
  v1 AS (SELECT * FROM firsts WHERE event_date < DATE '2024-01-28'),
  v2 AS (SELECT * FROM firsts WHERE event_date < DATE '2024-01-10' UNION ALL SELECT * FROM lasts WHERE event_date >= DATE '2024-01-10'),
  v3 AS (SELECT * FROM v2 WHERE NOT (event_date = DATE '2024-01-05' AND country = 'KR'))"""
ORACLES["version_feed"] = sql(
    BRONZE_SQL, """SELECT * EXCLUDE (ingestion_timestamp) REPLACE (CAST(price AS DOUBLE) AS price) FROM (
  SELECT *, 'insert' AS _change_type FROM new WHERE event_id NOT IN (SELECT event_id FROM old)
  UNION ALL SELECT *, 'delete' FROM old WHERE event_id NOT IN (SELECT event_id FROM new)
  UNION ALL SELECT o.*, 'update_preimage' FROM old o JOIN new n USING (event_id) WHERE o IS DISTINCT FROM n
  UNION ALL SELECT n.*, 'update_postimage' FROM old o JOIN new n USING (event_id) WHERE o IS DISTINCT FROM n)""",
    f"""{_VERSIONS}, old AS (SELECT event_id, user_id, event_type, product_id, price, device, country, ingestion_timestamp FROM v1),
  new AS (SELECT event_id, user_id, event_type, product_id, price, device, country, ingestion_timestamp FROM v3)""")
ORACLES["read_version"] = sql(
    BRONZE_SQL, " UNION ALL ".join(
        f"SELECT CAST(event_date AS VARCHAR) AS event_date, device, count(*) AS events, CAST({v} AS INTEGER) AS version FROM v{v} GROUP BY 1, 2"
        for v in (1, 2, 3)), _VERSIONS)
ORACLES["corrected_to_gold"] = sql(
    BRONZE_SQL, f"SELECT *, false AS ran_after_compaction FROM ({DEVICE.format(src='corrected')})",
    f"""corrected AS (SELECT * FROM ({pick('retail_bronze', 'first')}) WHERE event_date < DATE '2024-01-20'
  UNION ALL SELECT * FROM ({pick('retail_bronze', 'last')}) WHERE event_date >= DATE '2024-01-20')""")
ORACLES["stream_to_silver"] = sql(
    BRONZE_SQL, f"SELECT {EVENT}, event_time, ingestion_timestamp FROM ({pick('retail_bronze', 'last')})")
ORACLES["add_partitions"] = sql(RETAIL_SQL, f"SELECT event_id, {PARTS} FROM retail_events")
ORACLES["event_distribution"] = sql(
    BRONZE_SQL, "SELECT event_type, count(*) AS events FROM retail_bronze GROUP BY 1")
ORACLES["distinct_partitions"] = sql(RETAIL_SQL, f"SELECT DISTINCT {PARTS} FROM retail_events")
ORACLES["reconcile"] = sql(BRONZE_SQL, """SELECT count(*) AS bronze_rows, count(DISTINCT event_id) AS silver_rows,
  count(*) - count(DISTINCT event_id) AS removed_rows FROM retail_bronze""")
ORACLES["to_fact"] = sql(RETAIL_SQL, f"""SELECT {EVENT}, event_time, CAST(event_date AS VARCHAR) AS event_date,
  ingestion_timestamp FROM retail_events""")
ORACLES["bronze_to_silver"] = sql(BRONZE_SQL, f"""SELECT {EVENT}, event_time, ingestion_timestamp, {PARTS}
  FROM ({pick('retail_bronze', 'first')})""")
ORACLES["stream_route"] = sql(RAW_SQL, """SELECT q_event_id AS event_id,
  CASE WHEN rejection_reason IS NULL THEN 'bronze' ELSE 'quarantine' END AS "route", rejection_reason FROM retail_reasons""")
ORACLES["recover_quarantine"] = sql(QUARANTINE_SQL, f"""SELECT event_type,
  CASE WHEN rejection_reason IN {_REPAIRABLE} THEN 'bronze' ELSE 'dead_letter' END AS "route", count(*) AS "rows"
  FROM quarantine GROUP BY 1, 2""")

# --- gold and dimensions -----------------------------------------------------
ORACLES["daily_active_users"] = sql(RETAIL_SQL, DAU.format(src="retail_events"))
ORACLES["conversion_funnel"] = sql(RETAIL_SQL, FUNNEL.format(src="retail_events"))
ORACLES["daily_revenue"] = sql(RETAIL_SQL, REVENUE.format(src="retail_events"))
ORACLES["product_daily"] = sql(RETAIL_SQL, PRODUCT.format(src="retail_events"))
ORACLES["device_daily"] = sql(RETAIL_SQL, DEVICE.format(src="retail_events"))
ORACLES["since_hwm"] = sql(RETAIL_SQL, """SELECT event_id, event_time, user_id, event_type,
  CAST(event_date AS VARCHAR) AS event_date FROM retail_events WHERE event_date > DATE '2024-01-20'""")
_COUNTS = {
    "gold_daily_active_users": "count(DISTINCT event_date)",
    "gold_conversion_funnel": "count(DISTINCT event_date)",
    "gold_daily_revenue": "count(DISTINCT CASE WHEN event_type = 'purchase' THEN event_date END)",
    "gold_top_products": "count(DISTINCT CASE WHEN product_id IS NOT NULL THEN (event_date, product_id) END)",
    "gold_events_by_device": "count(DISTINCT (event_date, device))",
    "dim_users": "count(DISTINCT user_id)",
    "fact_events": "count(*)",
}
ORACLES["row_counts"] = sql(RETAIL_SQL, " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, {e} AS row_count FROM retail_events" for n, e in _COUNTS.items()))
ORACLES["dim_users"] = sql(RETAIL_SQL, USERS.format(src="retail_events"))
ORACLES["dim_products"] = sql(RETAIL_SQL, f"""SELECT *,
  {pct('nullif(total_purchases, 0)', 'total_views')} AS conversion_rate FROM (
  SELECT product_id, min(event_time) AS first_seen, max(event_time) AS last_seen,
    {mean('sum(price)', 'count(price)')} AS avg_price,
    count(CASE WHEN event_type = 'product_view' THEN 1 END) AS total_views,
    count(CASE WHEN event_type = 'add_to_cart' THEN 1 END) AS total_cart_adds,
    count(CASE WHEN event_type = 'purchase' THEN 1 END) AS total_purchases
  FROM retail_events WHERE product_id IS NOT NULL GROUP BY product_id)""")
_CALENDAR = """dates AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-01' + 729, INTERVAL 1 DAY)) AS DATE) AS d),
dim_date AS (SELECT d AS date_key, CAST(year(d) AS INTEGER) AS "year", CAST(month(d) AS INTEGER) AS "month",
  CAST(day(d) AS INTEGER) AS "day", CAST(dayofweek(d) AS INTEGER) AS day_of_week, left(dayname(d), 3) AS day_name,
  left(monthname(d), 3) AS month_name, CAST(quarter(d) AS INTEGER) AS "quarter", dayofweek(d) IN (0, 6) AS is_weekend,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year FROM dates)"""
ORACLES["dim_date"] = sql(RETAIL_SQL, """SELECT d.* REPLACE (CAST(date_key AS VARCHAR) AS date_key), e.total_events
  FROM dim_date d LEFT JOIN (SELECT event_date, count(*) AS total_events FROM retail_events GROUP BY 1) e
  ON e.event_date = d.date_key""", _CALENDAR)
ORACLES["run_gold"] = sql(RETAIL_SQL, PRODUCT.format(src="retail_events"))

# --- analyst queries ---------------------------------------------------------
ORACLES["dau_range"] = sql(RETAIL_SQL, f"SELECT * EXCLUDE (purchasing_users) FROM ({DAU.format(src=LO_HI)})")
ORACLES["dau_range_from_gold"] = sql(RETAIL_SQL, DAU.format(src=LO_HI))
ORACLES["funnel_range"] = sql(RETAIL_SQL, FUNNEL.format(src=LO_HI))
ORACLES["revenue_range"] = sql(RETAIL_SQL, REVENUE.format(src=LO_HI))
ORACLES["top_products"] = sql(RETAIL_SQL, f"""SELECT product_id, count(*) AS purchase_count,
  count(DISTINCT user_id) AS unique_buyers, CAST(sum(price) AS DOUBLE) AS total_revenue,
  {mean('sum(price)', 'count(price)')} AS avg_price FROM retail_events
  WHERE event_type = 'purchase' AND product_id IS NOT NULL GROUP BY product_id
  ORDER BY sum(price) DESC, product_id LIMIT 10""")
ORACLES["device_share"] = sql(RETAIL_SQL, f"""SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue),
  {pct('event_count', 'sum(event_count) OVER ()')} AS pct_of_total,
  {pct('revenue * 100', 'CAST(sum(revenue) OVER () * 100 AS HUGEINT)')} AS pct_of_revenue FROM (
  SELECT device, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
    sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS revenue
  FROM retail_events GROUP BY device)""")
ORACLES["duplicate_audit"] = sql(BRONZE_SQL, """SELECT event_id, count(*) AS occurrence_count,
  min(event_time) AS first_seen, max(event_time) AS last_seen, min(ingestion_timestamp) AS first_ingested,
  max(ingestion_timestamp) AS last_ingested FROM retail_bronze GROUP BY event_id HAVING count(*) > 1
  ORDER BY occurrence_count DESC, event_id LIMIT 20""")
ORACLES["weekday_sales"] = sql(RETAIL_SQL, f"""SELECT day_name, is_weekend, device, count(*) AS purchases,
  CAST(sum(price) AS DOUBLE) AS revenue, {mean('sum(price)', 'count(price)')} AS avg_order_value
  FROM retail_events JOIN dim_date ON event_date = date_key WHERE event_type = 'purchase'
  GROUP BY day_name, is_weekend, device""", _CALENDAR)
ORACLES["abandoned_cart"] = sql(SESSION_SQL, f"""SELECT a.device_type, count(a.session_id) AS total_add_to_cart_sessions,
  count(c.session_id) AS total_completed_checkouts,
  {pct('count(c.session_id)', 'count(a.session_id)')} AS conversion_rate_pct
  FROM carts a LEFT JOIN checkouts c ON a.session_id = c.session_id GROUP BY a.device_type""",
    """carts AS (SELECT session_id, user_id, device_type, count(*) AS items FROM session_facts
  WHERE event_type = 'add_to_cart' AND event_timestamp >= DATE '2024-01-31' - 30 GROUP BY ALL),
  checkouts AS (SELECT DISTINCT session_id FROM session_facts
  WHERE event_type = 'checkout_complete' AND event_timestamp >= DATE '2024-01-31' - 30)""")
ORACLES["time_to_cart"] = sql(SESSION_SQL, """SELECT avg(date_diff('second', event_timestamp, next_at))
  AS avg_seconds_to_add_to_cart FROM (
  SELECT *, lead(event_timestamp) OVER w AS next_at, lead(event_type) OVER w AS next_type FROM session_facts
  WHERE event_timestamp >= DATE '2024-01-31' - 7 WINDOW w AS (PARTITION BY session_id ORDER BY event_timestamp, event_id))
  WHERE event_type = 'page_view' AND next_type = 'add_to_cart' AND date_diff('second', event_timestamp, next_at) < 3600""")
ORACLES["cumulative_revenue"] = sql(REGION_SQL, """SELECT region, CAST(revenue_date AS VARCHAR) AS revenue_date,
  CAST(daily_revenue AS DOUBLE) AS daily_revenue,
  CAST(sum(daily_revenue) OVER (PARTITION BY region ORDER BY revenue_date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_revenue_ytd FROM (
  SELECT region, CAST(event_timestamp AS DATE) AS revenue_date, sum(price * quantity) AS daily_revenue
  FROM session_facts JOIN user_regions USING (user_id)
  WHERE event_type = 'checkout_complete' AND year(event_timestamp) = 2024 GROUP BY 1, 2)""")
ORACLES["orphans"] = sql(REGION_SQL, """SELECT count(e.event_id) AS orphaned_event_count FROM session_facts e
  LEFT JOIN user_regions u ON e.user_id = u.user_id WHERE u.user_id IS NULL""")
ORACLES["incomplete_sessions"] = sql(SESSION_SQL, """SELECT session_id, count(*) AS total_events FROM session_facts
  GROUP BY session_id HAVING sum(CASE WHEN event_type = 'session_start' THEN 1 ELSE 0 END) = 0
  ORDER BY total_events DESC, session_id LIMIT 10""")
ORACLES["kpi_join"] = sql(
    RETAIL_SQL, """SELECT event_date, total_revenue, daily_active_users FROM r JOIN d USING (event_date)
  ORDER BY event_date DESC LIMIT 10""",
    f"r AS ({REVENUE.format(src='retail_events')}), d AS ({DAU.format(src='retail_events')})")
ORACLES["last_days"] = sql(
    RETAIL_SQL, f"SELECT * FROM ({FUNNEL.format(src='retail_events')}) WHERE event_date >= '2024-01-24'")
ORACLES["partner_products"] = sql(RETAIL_SQL, f"""SELECT event_date, product_id, views, purchases FROM
  ({PRODUCT.format(src='retail_events')}) WHERE event_date >= '2024-01-15'""")
ORACLES["revenue_anomalies"] = sql(
    RETAIL_SQL, """SELECT ts, y, round(m, 4) AS forecast, round(m - 1.5::DOUBLE * s, 4) AS lower_bound,
  round(m + 1.5::DOUBLE * s, 4) AS upper_bound, true AS is_anomaly FROM (
  SELECT *, avg(y) OVER w AS m, stddev_samp(y) OVER w AS s FROM series
  WINDOW w AS (ORDER BY ts ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
  WHERE y < m - 1.5::DOUBLE * s OR y > m + 1.5::DOUBLE * s""",
    f"""series AS (SELECT CAST(event_date AS TIMESTAMP) AS ts, total_revenue AS y
  FROM ({REVENUE.format(src='retail_events')}))""")

# --- governance --------------------------------------------------------------
ORACLES["mask_column"] = sql(RETAIL_SQL, """SELECT event_id, country, 'analyst' AS seen_by FROM retail_events
  UNION ALL SELECT event_id, '***MASKED***', 'marketing' FROM retail_events""")
ORACLES["hash_mask"] = sql(
    RETAIL_SQL, """SELECT user_id, primary_device, primary_country, 'analyst' AS seen_by FROM users
  UNION ALL SELECT user_id, sha256(primary_device), sha256(primary_country), 'marketing' FROM users""",
    f"users AS ({USERS.format(src='retail_events')})")
ORACLES["mask_user_id"] = sql(RETAIL_SQL, """SELECT event_id, CAST(user_id AS VARCHAR) AS engineer_sees,
  '***-MASKED-***' AS analyst_sees FROM retail_events""")
ORACLES["row_security"] = sql(RETAIL_SQL, """SELECT country, count(*) AS "rows", viewer FROM retail_events
  JOIN (VALUES ('ana', 'BR'), ('ana', 'AU'), ('ben', 'JP'), ('chief', 'ALL'), ('root', 'ALL'))
  AS g(viewer, code) ON code = country OR code = 'ALL' GROUP BY country, viewer""")

# --- operational logs --------------------------------------------------------
ORACLES["run_history"] = sql(PIPELINE_SQL, """SELECT CAST(d AS TIMESTAMP) AS "timestamp",
  CASE WHEN day(d) % 5 = 0 THEN 'FAILED' ELSE 'COMPLETED' END AS state, strftime(d, '%Y-%m-%dT01:00:00') AS created_at
  FROM daily ORDER BY d DESC LIMIT 7""")
ORACLES["expectation_report"] = sql(PIPELINE_SQL, f"""SELECT CAST(d AS TIMESTAMP) AS "timestamp", 'events_silver' AS table_name,
  rule_name, passed, failed, {pct('failed', 'passed + failed')} AS failure_pct FROM (
  SELECT d, 'valid_record' AS rule_name, ok AS passed, bad AS failed FROM daily
  UNION ALL SELECT d, 'valid_event_id', n, 0 FROM daily)""")
ORACLES["sla_report"] = sql(PIPELINE_SQL, """SELECT CAST(d AS TIMESTAMP) AS "timestamp", 'COMPLETED' AS state,
  CASE WHEN day(d) % 7 = 0 THEN n * 10 ELSE 0 END AS backlog_bytes, day(d) % 7 <> 0 AS within_sla
  FROM daily WHERE day(d) % 5 <> 0""")
ORACLES["status_by_bin"] = sql(LOG_SQL, """SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS bin_start,
  count(*) AS total, count(*) FILTER (status = 'quarantined') AS quarantined, count(*) FILTER (status = 'valid') AS "valid"
  FROM component_log WHERE component = 'validator' GROUP BY 1""")
ORACLES["latency_by_bin"] = sql(LOG_SQL, """SELECT time_bucket(INTERVAL 6 HOUR, "timestamp") AS bin_start,
  round(avg(processing_time_ms), 6) AS avg_ms, max(processing_time_ms) AS max_ms, count(*) AS records,
  round(quantile_cont(processing_time_ms, 0.95), 6) AS p95_ms FROM component_log
  WHERE component = 'validator' AND status = 'valid' GROUP BY 1""")
ORACLES["top_reasons"] = sql(LOG_SQL, """SELECT rejection_reason, count(*) AS failures FROM component_log
  WHERE component = 'validator' AND status = 'quarantined' GROUP BY 1 ORDER BY failures DESC, rejection_reason LIMIT 10""")
ORACLES["throughput"] = sql(LOG_SQL, r"""SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS bin_start,
  CAST(sum(CAST(regexp_extract(message, 'records=(\d+)', 1) AS BIGINT)) AS BIGINT) AS total_sent FROM component_log
  WHERE component = 'producer' AND message LIKE '%batch_sent%' GROUP BY 1""")
ORACLES["throttles"] = sql(LOG_SQL, """SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS bin_start,
  count(*) AS throttle_events FROM component_log
  WHERE component = 'producer' AND message LIKE '%retry_backoff%' GROUP BY 1""")
ORACLES["alerts"] = sql(
    LOG_SQL, """SELECT bin_start, 'errors' AS alert, round(CAST(errors AS DOUBLE), 6) AS metric FROM scored WHERE errors > 4
  UNION ALL SELECT bin_start, 'no_events', round(silent, 6) FROM scored WHERE silent >= 20
  UNION ALL SELECT bin_start, 'high_quarantine_rate', round(least_share, 6) FROM scored
    WHERE least_share > 2 AND run_start = bin_start - INTERVAL 2 HOUR""",
    """bins AS (SELECT time_bucket(INTERVAL 60 MINUTE, "timestamp") AS bin_start,
    count(*) FILTER (status IN ('valid', 'quarantined')) AS checked,
    count(*) FILTER (status = 'quarantined') AS quarantined, count(*) FILTER (status = 'error') AS errors,
    min("timestamp") AS head, max("timestamp") AS tail FROM component_log GROUP BY 1),
  scored AS (SELECT *, min(coalesce(quarantined * 100.0::DOUBLE / nullif(checked, 0), 0)) OVER
      (ORDER BY bin_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS least_share,
    lag(bin_start, 2) OVER (ORDER BY bin_start) AS run_start,
    date_diff('second', tail, coalesce(lead(head) OVER (ORDER BY bin_start), TIMESTAMP '2024-01-31')) / 60.0::DOUBLE AS silent
  FROM bins)""")
ORACLES["stream_alerts"] = sql(
    LOG_SQL, """SELECT CAST(NULL AS VARCHAR) AS component, bin_start, 'errors' AS alert, CAST(errors AS DOUBLE) AS metric
    FROM scored, closed WHERE errors > 4 AND bin_start + INTERVAL 1 HOUR <= until
  UNION ALL SELECT NULL, bin_start, 'high_quarantine_rate', round(least_share, 6) FROM scored, closed
    WHERE least_share > 2 AND run_start = bin_start - INTERVAL 2 HOUR AND bin_start + INTERVAL 1 HOUR <= until
  UNION ALL SELECT component, time_bucket(INTERVAL 60 MINUTE, "timestamp"), 'no_events', 40.0::DOUBLE FROM following, closed
    WHERE (next IS NULL OR next >= "timestamp" + INTERVAL 40 MINUTE) AND "timestamp" + INTERVAL 40 MINUTE <= until""",
    """bins AS (SELECT time_bucket(INTERVAL 60 MINUTE, "timestamp") AS bin_start,
    count(*) FILTER (status IN ('valid', 'quarantined')) AS checked,
    count(*) FILTER (status = 'quarantined') AS quarantined, count(*) FILTER (status = 'error') AS errors
    FROM component_log GROUP BY 1),
  scored AS (SELECT *, min(coalesce(quarantined * 100.0::DOUBLE / nullif(checked, 0), 0)) OVER
      (ORDER BY bin_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS least_share,
    lag(bin_start, 2) OVER (ORDER BY bin_start) AS run_start FROM bins),
  following AS (SELECT component, "timestamp",
    lead("timestamp") OVER (PARTITION BY component ORDER BY "timestamp") AS next FROM component_log),
  closed AS (SELECT max("timestamp") - INTERVAL 30 MINUTE AS until FROM component_log)""")
ORACLES["slow_queries"] = sql(HISTORY_SQL, """SELECT query_id, query_text, execution_time / 1000 AS execution_seconds,
  bytes_scanned / 1024 / 1024 AS mb_scanned, rows_produced, warehouse_name FROM query_history
  WHERE execution_status = 'SUCCESS' AND start_time > TIMESTAMP '2001-08-02' - INTERVAL 720 HOUR
  ORDER BY execution_time DESC, query_id LIMIT 10""")
ORACLES["query_costs"] = sql(HISTORY_SQL, """SELECT query_id, query_text, warehouse_name,
  execution_time / 1000 / 60 AS execution_minutes, execution_time / 1000 / 60 / 60 AS estimated_credits_used
  FROM query_history WHERE warehouse_size IS NOT NULL AND start_time > TIMESTAMP '2001-08-02' - INTERVAL 365 DAY
  ORDER BY execution_time DESC, query_id LIMIT 20""")
ORACLES["credits"] = sql(HISTORY_SQL, """SELECT warehouse_name, CAST(sum(credits_used) AS DOUBLE) AS total_credits,
  CAST(sum(credits_used) AS DOUBLE) * 2 AS estimated_cost_usd FROM query_history
  WHERE start_time > TIMESTAMP '2001-08-02' - INTERVAL 70 DAY GROUP BY 1""")
ORACLES["table_lineage"] = sql(LINEAGE_SQL, """SELECT source_table_full_name, target_table_full_name, created_by, event_time
  FROM lineage WHERE target_table_full_name = 'shop.gold.gold_daily_revenue'""")
ORACLES["lineage_map"] = sql(LINEAGE_SQL, """SELECT DISTINCT source_table_full_name, target_table_full_name,
  created_by AS pipeline_or_user, event_time FROM lineage
  WHERE source_table_full_name LIKE 'shop.%' OR target_table_full_name LIKE 'shop.%'""")
ORACLES["column_lineage"] = sql(LINEAGE_SQL, """SELECT source_table_full_name, source_column_name, target_table_full_name,
  target_column_name, transformation_type FROM lineage
  WHERE target_table_full_name = 'shop.gold.gold_daily_revenue' AND target_column_name = 'total_revenue'""")
ORACLES["access_audit"] = sql(AUDIT_SQL, """SELECT event_time, email AS queried_by, action_name, full_name AS table_accessed,
  source_ip_address FROM audit WHERE action_name IN ('getTable', 'queryData', 'runCommand')
  AND full_name LIKE 'shop.gold.%' AND event_time >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY
  ORDER BY event_time DESC, full_name LIMIT 100""")
ORACLES["freshness"] = sql(RETAIL_SQL, """SELECT concat('gold.product_', CAST(product_id AS VARCHAR)) AS table_name,
  max(event_time) AS last_modified, CAST(sum(src_id) AS BIGINT) AS size_in_bytes, count(*) AS num_files,
  date_diff('minute', max(event_time), TIMESTAMP '2024-01-31') AS minutes_since_refresh
  FROM retail_events WHERE product_id IS NOT NULL GROUP BY product_id""")
ORACLES["history_slice"] = sql(HISTORY_SQL, """SELECT query_id, start_time, warehouse_name, bytes_scanned
  FROM query_history WHERE bytes_scanned > 0 AND execution_status = 'SUCCESS'""")

# Append mode emits a bin once the watermark, ten minutes behind the newest line, has passed it.
ORACLES["stream_status_by_bin"] = sql(LOG_SQL, """SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") AS bin_start,
  count(*) AS total, count(*) FILTER (status = 'quarantined') AS quarantined, count(*) FILTER (status = 'valid') AS "valid"
  FROM component_log WHERE component = 'validator' GROUP BY 1
  HAVING time_bucket(INTERVAL 1 HOUR, "timestamp") + INTERVAL 1 HOUR
         <= (SELECT max("timestamp") - INTERVAL 10 MINUTE FROM component_log)""")

_REPAIRED = f"""chain AS (
  SELECT event_time, user_id, event_type, product_id, price, device FROM retail_reasons WHERE rejection_reason IS NULL
  UNION ALL SELECT event_time, q_user_id, q_event_type, NULL, NULL, q_device FROM retail_reasons WHERE rejection_reason IN {PRICE_FIX}
  UNION ALL SELECT TIMESTAMP '2024-03-01 00:00:00', q_user_id, q_event_type, q_product_id, CAST(q_price AS DECIMAL(10,2)), q_device
  FROM retail_reasons WHERE rejection_reason = 'anomaly_future_timestamp'),
dated AS (SELECT *, CAST(CAST(event_time AS DATE) AS VARCHAR) AS d FROM chain)"""
_USERS = "count(DISTINCT user_id) FILTER (event_type = '{}')"
ORACLES["recovered_to_gold"] = sql(RAW_SQL, f"""
  SELECT 'gold_daily_active_users' AS table_name, d AS event_date, '' AS item, count(*) AS first_count,
         count(DISTINCT user_id) AS second_count, CAST(NULL AS DOUBLE) AS amount FROM dated GROUP BY d
  UNION ALL SELECT 'gold_conversion_funnel', d, '', {_USERS.format('product_view')}, {_USERS.format('add_to_cart')}, NULL FROM dated GROUP BY d
  UNION ALL SELECT 'gold_daily_revenue', d, '', count(*), count(*), CAST(sum(price) AS DOUBLE) FROM dated
  WHERE event_type = 'purchase' AND price IS NOT NULL GROUP BY d
  UNION ALL SELECT 'gold_top_products', d, CAST(product_id AS VARCHAR), count(*), count(DISTINCT user_id),
         CAST(sum(price) FILTER (event_type = 'purchase') AS DOUBLE) FROM dated WHERE product_id IS NOT NULL GROUP BY d, product_id
  UNION ALL SELECT 'gold_events_by_device', d, device, count(*), count(DISTINCT user_id),
         CAST(sum(price) FILTER (event_type = 'purchase') AS DOUBLE) FROM dated GROUP BY d, device""", _REPAIRED)
ORACLES["silver_expectations"] = sql(BRONZE_SQL, """SELECT 'event_id_missing' AS rule_name,
  count(*) FILTER (src_id % 11 <> 0) AS passed_records, count(*) FILTER (src_id % 11 = 0) AS failed_records FROM retail_bronze
  UNION ALL SELECT 'event_time_unreadable', count(*) FILTER (src_id % 7 <> 0), count(*) FILTER (src_id % 7 = 0) FROM retail_bronze""")

# --- clustering, incremental state, run reports -------------------------------
ORACLES["footer_ranges"] = sql(RETAIL_SQL, f"""SELECT {PARTS}, min(product_id) AS lo, max(product_id) AS hi, count(*) AS "rows"
  FROM retail_events GROUP BY ALL""")
ORACLES["layout_health"] = sql(RETAIL_SQL, """SELECT count(*) AS files, avg(depth) AS average_depth, max(depth) AS max_depth,
  avg(met) AS average_overlaps FROM (SELECT
  (SELECT count(*) FROM ranges o WHERE o.lo <= r.lo AND o.hi >= r.lo) AS depth,
  (SELECT count(*) FROM ranges o WHERE o.lo <= r.hi AND o.hi >= r.lo) - 1 AS met FROM ranges r)""",
    "ranges AS (SELECT min(user_id) AS lo, max(user_id) AS hi FROM retail_events GROUP BY event_date)")
ORACLES["compact_on_curve"] = sql(RETAIL_SQL, f"SELECT {EVENT}, true AS fewer_files FROM retail_events")
_FIGURES = """count(DISTINCT user_id) AS users,
  count(DISTINCT CASE WHEN event_type = 'product_view' THEN user_id END) AS viewers,
  count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS purchasers, count(*) AS events,
  count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN price END) AS DOUBLE) AS revenue"""
_WEEK = "CAST(CAST(date_trunc('week', event_date) AS DATE) AS VARCHAR)"
ORACLES["refresh_state"] = sql(
    BRONZE_SQL, " UNION ALL ".join(
        f"SELECT '{name}' AS name, {day} AS day, {item} AS item, {_FIGURES} FROM now_rows WHERE {item} IS NOT NULL GROUP BY 2, 3"
        for name, day, item in (
            ("daily_all", "CAST(event_date AS VARCHAR)", "''"), ("weekly_all", _WEEK, "''"),
            ("daily_device", "CAST(event_date AS VARCHAR)", "device"), ("weekly_device", _WEEK, "device"),
            ("weekly_product", _WEEK, "CAST(product_id AS VARCHAR)"))),
    f"""now_rows AS (SELECT * FROM ({pick('retail_bronze', 'first')}) WHERE event_date < DATE '2024-01-20'
    AND NOT (event_date = DATE '2024-01-05' AND country = 'KR')
  UNION ALL SELECT * FROM ({pick('retail_bronze', 'last')}) WHERE event_date >= DATE '2024-01-20')""")
ORACLES["run_expectations"] = sql(BRONZE_SQL, """SELECT TIMESTAMP '2024-03-01 00:00:00' AS timestamp,
  'events_silver' AS table_name, rule_name, passed, n - passed AS failed, round((n - passed) * 100.0 / n, 2) AS failure_pct FROM (
  SELECT 'event_id_missing' AS rule_name, count(*) FILTER (device <> 'tablet') AS passed, count(*) AS n FROM retail_bronze
  UNION ALL SELECT 'event_time_unreadable', count(*) FILTER (country <> 'KR'), count(*) FROM retail_bronze)""")
ORACLES["export_gold"] = sql(RETAIL_SQL, """SELECT CAST(event_date AS VARCHAR) AS event_date, exported, name FROM (
  SELECT event_date, 1::BIGINT AS exported, unnest(['gold_daily_active_users', 'gold_conversion_funnel']) AS name FROM retail_events GROUP BY 1
  UNION ALL SELECT event_date, 1, 'gold_daily_revenue' FROM retail_events WHERE event_type = 'purchase' AND price IS NOT NULL GROUP BY 1
  UNION ALL SELECT event_date, count(DISTINCT product_id), 'gold_top_products' FROM retail_events WHERE product_id IS NOT NULL GROUP BY 1
  UNION ALL SELECT event_date, count(DISTINCT device), 'gold_events_by_device' FROM retail_events GROUP BY 1)""")
ORACLES["seasonal_anomalies"] = sql(RETAIL_SQL, """SELECT ts, y, round(forecast, 3) AS forecast,
  round(forecast - deviation, 3) AS lower_bound, round(forecast + deviation, 3) AS upper_bound,
  coalesce(y < forecast - deviation OR y > forecast + deviation, false) AS is_anomaly FROM (
  SELECT ts, y, mean_y + slope * (day - mean_day) AS forecast, deviation FROM series
  LEFT JOIN weekdays USING (weekday), whole WHERE ts > TIMESTAMP '2024-01-21')""",
    f"""series AS (SELECT CAST(event_date AS TIMESTAMP) AS ts, total_revenue AS y, dayofweek(CAST(event_date AS DATE)) AS weekday,
    CAST(date_diff('day', DATE '2000-01-01', CAST(event_date AS DATE)) AS DOUBLE) AS day FROM ({REVENUE.format(src='retail_events')})),
  training AS (SELECT * FROM series WHERE ts <= TIMESTAMP '2024-01-21'),
  weekdays AS (SELECT weekday, avg(day) AS mean_day, avg(y) AS mean_y FROM training GROUP BY 1),
  whole AS (SELECT slope, sqrt(sum((y - mean_y - slope * (day - mean_day)) ** 2) / (count(*) - count(DISTINCT weekday) - 1)) AS deviation
    FROM training JOIN weekdays USING (weekday), (SELECT sum((day - mean_day) * (y - mean_y)) / sum((day - mean_day) ** 2) AS slope
    FROM training JOIN weekdays USING (weekday)) GROUP BY slope)""")
