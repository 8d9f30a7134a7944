"""Rejection reasons for raw JSON events, as native VARIANT expressions.

Each check family is an ordered list of (failing condition, reason); the first
failing one names the record's reason. A VARIANT keeps apart what a typed reader
merges: ``"7"`` and ``7``, an absent key and an explicit null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmill import constants as C

Rule = tuple[Column, Column]
Record = dict[str, Column]

FIELDS = C.REQUIRED_FIELDS + ("product_id", "price")
VOCABULARY = {"event_type": C.EVENT_TYPES, "device": C.DEVICES, "country": C.COUNTRIES}


def record_of(payload: str) -> Column:
    """The JSON value of a text as VARIANT, NULL where the whole text is not one value.

    The parser stops after the first value; within brackets, anything behind it is an error
    or a second element.
    """
    boxed = F.try_parse_json(F.concat(F.lit("["), F.col(payload), F.lit("]")))
    return F.when(F.try_variant_get(boxed, "$[1]", "variant").isNull(), F.try_variant_get(boxed, "$[0]", "variant"))


def json_kind(v: Column, field: str) -> Column:
    """JSON type name of a field: NULL if absent, VOID if an explicit null."""
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def _kind(v: Column, event: Column, field: str) -> Column:
    """The JSON type of a field: known for sound records, else looked up in the VARIANT.

    Typed values do not tell: of a repeated name the typed parse may keep an earlier value.
    """
    kind = "NUMBER" if field == "price" else "BIGINT" if field in ("user_id", "product_id") else "STRING"
    return F.when(F.col(helper("sound")), F.when(event[field].isNotNull(), F.lit(kind))).otherwise(json_kind(v, field))


TYPED = (
    "event_id string, event_time string, user_id bigint, event_type string, "
    "product_id bigint, price double, device string, country string"
)


def typed(payload: str) -> Column:
    """The fields of the contract as a struct; a value of another type is NULL."""
    return F.from_json(F.col(payload), TYPED)


def _apart(work, wanted: Column, value: Column | None = None) -> Column:
    """work(value) for the rows where it is wanted, in a step of its own."""
    held = F.array(F.lit(0) if value is None else value)
    return F.when(wanted, F.element_at(F.transform(held, work), 1))


def sound(payload: Column, event: Column) -> Column:
    """True where the typed parse alone shows a flat record of the right types and ranges.

    Such a record is one object without escapes whose required fields hold values only a
    JSON string or number of the right kind gives, and whose optional fields are numbers,
    null or not there. NULL or false says nothing; those records are parsed once more.
    """
    def left_out(field: str) -> Column:
        name = f'"{field}"'
        return event[field].isNull() & (~payload.contains(name) | payload.rlike(rf"{name}\s*:\s*null\s*[,\x7D]"))

    # in bytes, which a text knows; its characters would have to be counted, twice
    names = F.octet_length(payload) - F.octet_length(F.replace(payload, F.lit('":'), F.lit("")))
    wanted = sum((F.when(payload.contains(f'"{f}"'), 2).otherwise(0) for f in ("product_id", "price")),
                 F.lit(2 * len(C.REQUIRED_FIELDS)))
    return F.coalesce(
        (names == wanted)  # so no name is repeated
        & payload.rlike(r"^\s*\x7B[^\x7B\x7D\x5C]*\x7D\s*$")
        & event["event_id"].rlike(r"^[A-Za-z][\w-]{7,}$") & event["event_time"].rlike(C.TIMESTAMP_PATTERN)
        & event["user_id"].between(C.USER_ID_MIN, C.USER_ID_MAX)
        & event["event_type"].isin(*C.EVENT_TYPES) & event["device"].isin(*C.DEVICES) & event["country"].isin(*C.COUNTRIES)
        & (event["product_id"].isNotNull() | left_out("product_id"))
        & (event["price"].between(C.PRICE_MIN, C.PRICE_MAX) | left_out("price")),
        F.lit(False),
    )


def unpack(payload: Column, v: Column, event: Column) -> list[Column]:
    """JSON kind and value of every field of the contract, as flat helper columns.

    They are flat, not one struct, so that the optimizer keeps them as computed
    columns instead of repeating the VARIANT lookups inside every check.
    """
    kinds = [_kind(v, event, field).alias(helper(f"{field}_kind")) for field in FIELDS]
    values = [event[field].alias(helper(field)) for field in FIELDS]
    # Texts that few records need, worked out once and not inside each check.
    price = event["price"]
    odd = (price < C.PRICE_MIN) | (price > C.PRICE_MAX)
    # Inside a lambda they are interpreted: as generated code they would make the method too long to compile.
    unsure = ~F.col(helper("sound"))
    long = [_apart(lambda _: big_integer("user_id"), unsure).alias(helper("user_id_long")),
            _apart(lambda _: big_integer("product_id"), unsure).alias(helper("product_id_long"))]
    shown = _apart(lambda p: number_text(json_kind(v, "price"), p), odd, price).alias(helper("price_text"))
    is_object = F.col(helper("sound")) | payload.rlike(r"^\s*\{")
    return [is_object.alias(helper("is_object")), *kinds, *values, *long, shown]


def helper(name: str) -> str:
    return f"_r_{name}"


def unpacked() -> Record:
    """Handles on the helper columns that ``unpack`` adds."""
    names = ["is_object", *FIELDS, *[f"{f}_kind" for f in FIELDS], "user_id_long", "product_id_long", "price_text"]
    return {name: F.col(helper(name)) for name in names}


def first_failure(rules: list[Rule]) -> Column:
    return F.coalesce(*[F.when(failing, reason) for failing, reason in rules])


def _has(kind: Column) -> Column:
    return kind.isNotNull() & (kind != "VOID")


def _not(kind: Column, accepted: str) -> Column:
    return ~F.coalesce(kind.rlike(f"^({accepted})"), F.lit(False))


def schema_reason(r: Record) -> Column:
    """Not an object, or the list of absent required fields in contract order."""
    absent = F.concat_ws(
        ",", *[F.when(r[f"{f}_kind"].isNull(), F.lit(f)) for f in C.REQUIRED_FIELDS]
    )
    return first_failure([
        (~r["is_object"], F.lit("record_is_not_dict")),
        (absent != "", F.concat(F.lit("missing_fields:"), absent)),
    ])


def type_reason(r: Record) -> Column:
    short_id = F.length(r["event_id"]) < C.EVENT_ID_MIN_LENGTH
    no_stamp = ~r["event_time"].rlike(C.TIMESTAMP_PATTERN)
    rules = [
        (_not(r["event_id_kind"], "STRING") | short_id, "invalid_event_id_format"),
        (_not(r["event_time_kind"], "STRING") | no_stamp, "invalid_event_time_format"),
        (_not(r["user_id_kind"], "BIGINT") & r["user_id_long"].isNull(), "user_id_not_integer"),
    ]
    rules += [
        (_not(r[f"{f}_kind"], "STRING"), f"{f}_not_string")
        for f in ("event_type", "device", "country")
    ]
    rules += [
        (_has(r["product_id_kind"]) & _not(r["product_id_kind"], "BIGINT") & r["product_id_long"].isNull(),
         "product_id_not_integer"),
        (_has(r["price_kind"]) & _not(r["price_kind"], "NUMBER|BIGINT|DECIMAL|DOUBLE|FLOAT"),
         "price_not_numeric"),
    ]
    return first_failure([(failing, F.lit(reason)) for failing, reason in rules])


def enum_reason(r: Record) -> Column:
    shown = {f: F.coalesce(r[f], F.lit("")) for f in VOCABULARY}
    return first_failure([
        (~shown[f].isin(*allowed), F.concat(F.lit(f"invalid_{f}:"), shown[f]))
        for f, allowed in VOCABULARY.items()
    ])


def double_text(number: Column) -> Column:
    """A double as the contract prints it: shortest digits, an exponent below 1e-4 and from 1e16 on.

    One rule for all sizes: the digits and the exponent of Spark's own text, laid out anew.
    """
    own = number.cast("string")
    parts = r"^-?(\d+)\.(\d+)(?:E(-?\d+))?$"
    whole, rest = F.regexp_extract(own, parts, 1), F.regexp_extract(own, parts, 2)
    power = F.coalesce(F.regexp_extract(own, parts, 3).try_cast("int"), F.lit(0))
    digits = F.concat(whole, rest)
    lead = F.length(digits) - F.length(F.ltrim(digits, F.lit("0")))
    digits = F.trim(digits, F.lit("0"))
    digits = F.when(digits == "", "0").otherwise(digits)
    point = F.when(number == 0, F.lit(1)).otherwise(F.length(whole) + power - lead)
    size = F.length(digits)
    plain = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), F.greatest(F.lit(0), -point)), digits))
        .when(point >= size, F.concat(digits, F.repeat(F.lit("0"), F.greatest(F.lit(0), point - size)), F.lit(".0")))
        .otherwise(F.concat(F.left(digits, point), F.lit("."), F.substring(digits, point + 1, size)))
    )
    exponent = point - 1
    raised = F.concat(
        F.left(digits, F.lit(1)), F.when(size > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), size))).otherwise(""),
        F.lit("e"), F.when(exponent < 0, "-").otherwise("+"),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")),
    )
    shown = F.when((exponent >= -4) & (exponent < 16), plain).otherwise(raised)
    return F.concat(F.when(own.startswith("-"), "-").otherwise(""), shown)


def big_integer(field: str) -> Column:
    """A JSON integer beyond 64 bits as text, NULL for anything else; `7.0` and `1e20` are no integers."""
    v, raw = F.col("record"), F.get_json_object("payload", f"$.{field}")
    wide = json_kind(v, field).rlike(r"^DECIMAL\((19|2\d|3\d),0\)") & raw.rlike(r"^-?\d+$")
    return F.when(wide, F.try_variant_get(v, f"$.{field}", "decimal(38,0)").cast("string"))


def number_text(kind: Column, number: Column, field: str = "price") -> Column:
    """A JSON number as the contract prints it: integers bare, others with a point or an exponent."""
    return F.when(kind == "BIGINT", number.cast("bigint").cast("string")).otherwise(
        F.coalesce(big_integer(field), double_text(number)))


def anomaly_reason(r: Record, now: Column, tolerance_seconds: int = 0) -> Column:
    """Range, clock and business-rule checks; a time without a zone counts as UTC."""
    price, user = r["price"], r["user_id"]
    shown_price = r["price_text"]
    limit = F.timestamp_seconds(F.unix_timestamp(now) + F.lit(tolerance_seconds)) \
        if tolerance_seconds else now
    buying = r["event_type"] == "purchase"
    return first_failure([
        (price < C.PRICE_MIN, F.concat(F.lit("anomaly_price_too_low:"), shown_price)),
        (price > C.PRICE_MAX, F.concat(F.lit("anomaly_price_too_high:"), shown_price)),
        (~user.between(C.USER_ID_MIN, C.USER_ID_MAX),
         F.concat(F.lit("anomaly_user_id_out_of_range:"), user.cast("string"))),
        (user.isNull() & r["user_id_long"].isNotNull(),
         F.concat(F.lit("anomaly_user_id_out_of_range:"), r["user_id_long"])),
        (F.try_to_timestamp(r["event_time"]) > limit, F.lit("anomaly_future_timestamp")),
        (buying & ~_has(r["product_id_kind"]), F.lit("anomaly_purchase_missing_product_id")),
        (buying & ~_has(r["price_kind"]), F.lit("anomaly_purchase_missing_price")),
        (r["event_type"].isin("login", "logout") & _has(r["price_kind"]),
         F.concat(F.lit("anomaly_"), r["event_type"], F.lit("_has_price"))),
    ])


def shape_reason(r: Record) -> Column:
    """Is it an object with all fields, each of the right JSON type?"""
    return F.coalesce(schema_reason(r), type_reason(r))


def content_reason(r: Record, now: Column, tolerance_seconds: int = 0) -> Column:
    """Are the values of a well-shaped record allowed and plausible?"""
    return F.coalesce(enum_reason(r), anomaly_reason(r, now, tolerance_seconds))
