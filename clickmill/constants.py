"""Domain values shared by the validators, the repairs and the reports."""

# The accepted vocabulary, limits and reason codes of the event
# contract. They have to stay as they are for results to be comparable.
EVENT_TYPES = ("product_view", "add_to_cart", "purchase", "login", "logout")
DEVICES = ("mobile", "desktop", "tablet")
COUNTRIES = ("US", "IN", "GB", "DE", "FR", "JP", "BR", "CA", "AU", "SG", "TH", "MY", "KR")
REQUIRED_FIELDS = ("event_id", "event_time", "user_id", "event_type", "device", "country")
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
EVENT_ID_MIN_LENGTH = 8
PRICE_MIN, PRICE_MAX = 0.01, 50000.0
USER_ID_MIN, USER_ID_MAX = 1, 1000000
PRICE_REPAIR_REASONS = ("anomaly_login_has_price", "anomaly_logout_has_price")
TIME_REPAIR_REASONS = ("anomaly_future_timestamp",)
FIRST_HIGH_WATER_MARK = "2020-01-01"
CONSTANT_MASK = "***MASKED***"
USER_ID_MASK = "***-MASKED-***"

REPAIRABLE_REASONS = PRICE_REPAIR_REASONS + TIME_REPAIR_REASONS
UNPARSEABLE = "unparseable_payload"
