"""Record shapes, output column orders and status codes.

Amounts, counts and codes travel as strings, as the change log delivers them;
they are cast only inside the expressions that compute with them.
"""

from pyspark.sql import types as T

TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# ---- Fixed values: names, codes and column orders that results must carry ----

CHANGE_SCHEMA = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("data", TEXT_MAP),
    T.StructField("old", TEXT_MAP),
    T.StructField("ts", T.StringType()),
])

CONFIG_COLUMNS = ["source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend"]

DICTIONARY_SCHEMA = "dic_code string, dic_name string, parent_code string, create_time timestamp_ntz, operate_time timestamp_ntz"

KEPT_TYPES = ["insert", "update", "bootstrap-insert"]

ORDER_CANCELLED = "1003"
ORDER_REFUND_REQUESTED = "1005"
ORDER_REFUND_DONE = "1006"
PAYMENT_PAID = "1602"
REFUND_PAID = "0702"

ORDER_JOIN_TTL = 5        # seconds
PAYMENT_JOIN_TTL = 905    # seconds
BOUNCE_WITHIN_MS = 10_000
BOUNCE_DELAY = "2 seconds"

LOG_TARGETS = ["page", "start", "display", "action", "error"]

ORDER_DETAIL_FIELDS = [
    "id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num",
    "order_price", "split_total_amount", "split_activity_amount", "split_coupon_amount",
]
ORDER_INFO_FIELDS = ["id", "user_id", "province_id", "operate_time", "order_status"]
ORDER_ACTIVITY_FIELDS = ["order_detail_id", "activity_id", "activity_rule_id"]
ORDER_COUPON_FIELDS = ["order_detail_id", "coupon_id"]
CART_FIELDS = ["id", "user_id", "sku_id", "source_id", "source_type"]
PAYMENT_FIELDS = ["user_id", "order_id", "payment_type", "callback_time"]
REFUND_REQUEST_FIELDS = [
    "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
    "refund_reason_type", "refund_reason_txt", "create_time",
]
REFUND_PAYMENT_FIELDS = ["id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"]

ORDER_WIDE_COLUMNS = [
    "id", "order_id", "user_id", "order_status", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "date_id", "create_time", "operate_date_id", "operate_time",
    "source_id", "source_type", "source_type_name", "sku_num", "split_original_amount",
    "split_activity_amount", "split_coupon_amount", "split_total_amount", "type", "old", "od_ts",
    "oi_ts", "row_op_ts",
]
ORDER_DETAIL_COLUMNS = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "date_id", "create_time", "source_id", "source_type_code",
    "source_type_name", "sku_num", "split_original_amount", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "ts", "row_op_ts",
]
ORDER_CANCEL_COLUMNS = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "date_id", "cancel_time", "source_id", "source_type_code",
    "source_type_name", "sku_num", "split_original_amount", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "ts", "row_op_ts",
]
CART_ADD_COLUMNS = [
    "id", "user_id", "sku_id", "source_id", "source_type_id", "source_type_name", "sku_num", "ts",
]
PAYMENT_COLUMNS = [
    "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name", "callback_time",
    "source_id", "source_type_code", "source_type_name", "sku_num", "split_original_amount",
    "split_activity_amount", "split_coupon_amount", "split_payment_amount", "ts", "row_op_ts",
]
ORDER_REFUND_COLUMNS = [
    "id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time",
    "refund_type_code", "refund_type_name", "refund_reason_type_code", "refund_reason_type_name",
    "refund_reason_txt", "refund_num", "refund_amount", "ts", "row_op_ts",
]
REFUND_SUCCESS_COLUMNS = [
    "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "payment_type_name",
    "date_id", "callback_time", "refund_num", "refund_amount", "ts", "row_op_ts",
]

# ---- End of fixed values ----

CONFIG_ROW = T.StructType([T.StructField(c, T.StringType()) for c in CONFIG_COLUMNS])

CONFIG_CHANGE_SCHEMA = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("before", CONFIG_ROW),
    T.StructField("after", CONFIG_ROW),
    T.StructField("ts_ms", T.LongType()),
])


def detail_schema(columns):
    """Schema of a produced detail stream: every column is text, bar the change map and the stamp."""
    special = {"old": TEXT_MAP, "row_op_ts": T.TimestampType()}
    return T.StructType([T.StructField(c, special.get(c, T.StringType())) for c in columns])
