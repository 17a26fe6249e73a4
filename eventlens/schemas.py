"""Record types as explicit schemas (nothing inferred)."""

SENSOR = "id STRING, timestamp BIGINT, temperature DOUBLE"
BEHAVIOR = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, timestamp BIGINT"
LOGIN = "user_id BIGINT, ip STRING, login_state STRING, timestamp BIGINT"
ACCESS_LOG = "ip STRING, user_id STRING, timestamp BIGINT, method STRING, url STRING"
ITEM_VIEW_COUNT = "item_id BIGINT, window_end BIGINT, cnt BIGINT"
PAGE_VIEW_COUNT = "url STRING, window_end BIGINT, cnt BIGINT"
LOGIN_FAIL_WARNING = "user_id BIGINT, first_fail_time BIGINT, last_fail_time BIGINT, warning_msg STRING"
