"""The event contract, case by case: one change to a sound record, one reason."""

import json

import pytest
from pyspark.sql import functions as F

from clickmill.operators import ingest

NOW = "2026-12-01 00:00:00"

PURCHASE = {
    "event_id": "order-0000-7f3e", "event_time": "2023-07-02T21:04:59+00:00",
    "user_id": 90210, "event_type": "purchase", "product_id": 4477, "price": 18.25,
    "device": "tablet", "country": "BR",
}
LOGIN = {
    "event_id": "visit-0000-51ab", "event_time": "2023-07-03T05:40:00+00:00",
    "user_id": 777, "event_type": "login", "product_id": None, "price": None,
    "device": "desktop", "country": "US",
}


def changed(base, **fields):
    return json.dumps({**base, **fields})


def without(base, *fields):
    return json.dumps({k: v for k, v in base.items() if k not in fields})


ALL = "missing_fields:event_id,event_time,user_id,event_type,device,country"

CASES = [
    # presence
    (json.dumps(PURCHASE), None),
    (without(PURCHASE, "event_id"), "missing_fields:event_id"),
    (json.dumps({"event_time": PURCHASE["event_time"]}),
     "missing_fields:event_id,user_id,event_type,device,country"),
    ('"just text"', "record_is_not_dict"),
    ("{}", ALL),
    ("[1]", "record_is_not_dict"),
    ("null", "record_is_not_dict"),
    ("7", "record_is_not_dict"),
    # types
    (json.dumps(LOGIN), None),
    (changed(PURCHASE, user_id="someone"), "user_id_not_integer"),
    (changed(PURCHASE, event_id="abc"), "invalid_event_id_format"),
    (changed(PURCHASE, event_id=12345678), "invalid_event_id_format"),
    (changed(PURCHASE, event_id=None), "invalid_event_id_format"),
    (changed(PURCHASE, event_time="next Tuesday"), "invalid_event_time_format"),
    (changed(PURCHASE, event_time=20240315), "invalid_event_time_format"),
    (changed(PURCHASE, product_id="abc"), "product_id_not_integer"),
    (changed(PURCHASE, product_id="4477"), "product_id_not_integer"),
    (changed(LOGIN, product_id=None), None),
    (without(LOGIN, "product_id", "price"), None),
    (changed(PURCHASE, price="eighteen"), "price_not_numeric"),
    (changed(PURCHASE, price="NaN"), "price_not_numeric"),
    (changed(PURCHASE, price=True), "price_not_numeric"),
    (changed(PURCHASE, user_id=True), "user_id_not_integer"),
    (changed(PURCHASE, user_id=7.0), "user_id_not_integer"),
    (changed(PURCHASE, event_type=5), "event_type_not_string"),
    (changed(PURCHASE, device=None), "device_not_string"),
    (changed(PURCHASE, country={"code": "US"}), "country_not_string"),
    # vocabulary
    (changed(PURCHASE, event_type="click"), "invalid_event_type:click"),
    (changed(PURCHASE, device="fridge"), "invalid_device:fridge"),
    (changed(PURCHASE, country="XX"), "invalid_country:XX"),
    (changed(PURCHASE, country="us"), "invalid_country:us"),
    *[(changed(PURCHASE, event_type=t), None) for t in ("product_view", "add_to_cart", "purchase")],
    *[(changed(LOGIN, event_type=t), None) for t in ("login", "logout")],
    # plausibility
    (changed(PURCHASE, price=-3.0), "anomaly_price_too_low:-3.0"),
    (changed(PURCHASE, price=-6.75), "anomaly_price_too_low:-6.75"),
    (changed(PURCHASE, price=-5), "anomaly_price_too_low:-5"),
    (changed(PURCHASE, price=0), "anomaly_price_too_low:0"),
    (changed(PURCHASE, price=100000.0), "anomaly_price_too_high:100000.0"),
    (changed(PURCHASE, price=12345678.5), "anomaly_price_too_high:12345678.5"),
    (changed(PURCHASE, price=0.0005), "anomaly_price_too_low:0.0005"),
    (changed(PURCHASE, price=-0.0001), "anomaly_price_too_low:-0.0001"),
    (changed(PURCHASE, price=-1e-7), "anomaly_price_too_low:-1e-07"),
    (changed(PURCHASE, price=-1.25e-5), "anomaly_price_too_low:-1.25e-05"),
    (changed(PURCHASE, price=0.0), "anomaly_price_too_low:0.0"),
    (changed(PURCHASE, price=1e17), "anomaly_price_too_high:1e+17"),
    (changed(PURCHASE, price=1.5e300), "anomaly_price_too_high:1.5e+300"),
    (changed(PURCHASE, price=123456789012345.0), "anomaly_price_too_high:123456789012345.0"),
    (changed(PURCHASE, price=1e15), "anomaly_price_too_high:1000000000000000.0"),
    (changed(PURCHASE, price=10**20), "anomaly_price_too_high:100000000000000000000"),
    (changed(PURCHASE, user_id=10**20), "anomaly_user_id_out_of_range:100000000000000000000"),
    (changed(PURCHASE, user_id=-(10**25)), "anomaly_user_id_out_of_range:-10000000000000000000000000"),
    (changed(PURCHASE, product_id=10**20), None),
    (changed(PURCHASE, product_id=7.0), "product_id_not_integer"),
    # of a repeated key the last value counts
    (json.dumps(PURCHASE)[:-1] + ', "price": -3}', "anomaly_price_too_low:-3"),
    (json.dumps(PURCHASE)[:-1] + ', "price": "x"}', "price_not_numeric"),
    (json.dumps(PURCHASE)[:-1] + ', "price": null, "price": "x"}', "price_not_numeric"),
    # sound at the start, not to the end
    (json.dumps(PURCHASE) + " {}", "unparseable_payload"),
    (json.dumps(PURCHASE) + "}", "unparseable_payload"),
    (changed(PURCHASE, price=0.01), None),
    (changed(PURCHASE, price=50000), None),
    (changed(PURCHASE, user_id=0), "anomaly_user_id_out_of_range:0"),
    (changed(PURCHASE, user_id=1000001), "anomaly_user_id_out_of_range:1000001"),
    (changed(PURCHASE, event_time="2077-01-01T00:00:01+00:00"), "anomaly_future_timestamp"),
    (changed(PURCHASE, event_time="2077-01-01T00:00:01Z"), "anomaly_future_timestamp"),
    (changed(PURCHASE, event_time="2023-07-02T21:04:59Z"), None),
    (changed(PURCHASE, event_time="2023-07-02T21:04:59"), None),
    (changed(PURCHASE, product_id=None), "anomaly_purchase_missing_product_id"),
    (without(PURCHASE, "price"), "anomaly_purchase_missing_price"),
    (changed(LOGIN, price=4.5), "anomaly_login_has_price"),
    (changed(LOGIN, event_type="logout", price=1), "anomaly_logout_has_price"),
    # order of the checks: the first failing one names the reason
    (json.dumps({"event_id": "x"}), "missing_fields:event_time,user_id,event_type,device,country"),
    (changed(PURCHASE, user_id="x", country="XX", price=-1), "user_id_not_integer"),
    (changed(PURCHASE, country="XX", price=-1), "invalid_country:XX"),
    (changed(PURCHASE, price=-1.5, user_id=0), "anomaly_price_too_low:-1.5"),
    # not JSON
    ("{bad", "unparseable_payload"),
    ("", "unparseable_payload"),
    (None, "unparseable_payload"),
]


@pytest.fixture(scope="module")
def reasons(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(CASES)], "i int, payload string")
    checked = ingest.with_rejection_reason(df, NOW)
    return {r.i: r.rejection_reason for r in checked.select("i", "rejection_reason").collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=lambda i: str(CASES[i][1]))
def test_reason(reasons, i):
    payload, expected = CASES[i]
    assert reasons[i] == expected, payload


def test_tolerance_shifts_the_clock(spark):
    soon = changed(PURCHASE, event_time="2026-12-01T00:03:00+00:00")
    df = spark.createDataFrame([(soon,)], "payload string")
    strict = ingest.with_rejection_reason(df, NOW).first().rejection_reason
    lenient = ingest.with_rejection_reason(df, NOW, tolerance_seconds=300).first().rejection_reason
    assert (strict, lenient) == ("anomaly_future_timestamp", None)


def test_routes_partition_the_input(spark):
    df = spark.createDataFrame([(p,) for p, _ in CASES], "payload string")
    checked = ingest.with_rejection_reason(df, NOW)
    sizes = [part.count() for part in ingest.route(checked, NOW)]
    assert sum(sizes) == len(CASES)
    summary = ingest.ingest_summary(checked).first()
    assert [summary.valid_count, summary.quarantine_count, summary.parse_errors] == sizes


def test_quarantined_rows_keep_their_payload(spark):
    bad = changed(PURCHASE, user_id="someone")
    df = spark.createDataFrame([(bad,)], "payload string")
    row = ingest.route(ingest.with_rejection_reason(df, NOW), NOW).quarantined.first()
    assert (row.payload, row.user_id, row.price) == (bad, None, 18.25)


def test_decoding_failures_are_kept_apart(spark):
    df = spark.createDataFrame([("eyJhIjoxfQ==",), ("%%%",), (None,)], "data string")
    got = [r.ok for r in ingest.parse_payload(ingest.decode_payload(df)).select(
        F.col("record").isNotNull().alias("ok")).collect()]
    assert got == [True, False, False]
