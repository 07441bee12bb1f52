"""The warehouse's data flows, composed from the operators.

Every flow is ``DataFrame -> DataFrame`` and takes batch frames or streams alike (the dimension and
log flows have their streaming forms in ``millrace.streaming``). ``ttl`` is the retention of a
stream join in seconds; ``None`` joins a batch without time limit.

Lookups are inner and broadcast, so they come first: rows they drop are never shuffled. Given ``None`` for a dictionary, a flow
leaves the names out, and ``with_names`` attaches them to its result: for streams whose dictionary changes while they run.
"""

from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions import cdc
from millrace.operators.joins import lookup_join, retained_join, two_role_lookup
from millrace.operators.logsplit import route_log, write_flag
from millrace.operators.quality import parse_log, split_dirty
from millrace.operators.routing import current_config, route_by_config
from millrace.operators.selection import keep_types, select_table, with_event_time
from millrace.operators.upsert import latest_by_key
from millrace.operators.visitors import detect_bounce, first_visit_per_day, repair_new_flag


#: Names that a flow takes from the dictionary: output column by code column of the output.
NAMES = {
    "order_wide": {"source_type": "source_type_name"},
    "payment_success": {"payment_type_code": "payment_type_name"},
    "order_refund": {"refund_type_code": "refund_type_name", "refund_reason_type_code": "refund_reason_type_name"},
    "refund_success": {"payment_type_code": "payment_type_name"},
}
COLUMNS = {"order_wide": S.ORDER_WIDE_COLUMNS, "payment_success": S.PAYMENT_COLUMNS, "order_refund": S.ORDER_REFUND_COLUMNS,
           "refund_success": S.REFUND_SUCCESS_COLUMNS}


def with_names(flow, rows, dictionary):
    """The output of a flow that was made without a dictionary, completed from one. As in the flow, rows whose code is null or
    unknown disappear."""
    return two_role_lookup(rows, dictionary, NAMES[flow]).select(*COLUMNS[flow])


def _finished(flow, df, dictionary):
    """The output columns in order; without a dictionary, without the names. ``row_op_ts`` is stamped now."""
    left_out = set() if dictionary is not None else set(NAMES[flow].values())
    if "row_op_ts" in COLUMNS[flow] and "row_op_ts" not in df.columns:
        df = df.withColumn("row_op_ts", F.current_timestamp())
    return df.select(*[c for c in COLUMNS[flow] if c not in left_out])


def _timed(changes, delay, *tables):
    """A streamed change log of ``tables`` with event time; a batch as it is.

    The tables are chosen below the watermark, so that a log stored by table is pruned to their folders,
    while any of them still moves the watermark on.
    """
    if not changes.isStreaming:
        return changes
    return with_event_time(changes.filter(F.col("table").isin(*tables)), delay=delay)


def dimensions(changes, config_changes, order=("change_ts",)):
    """Current rows of every configured dimension table: (sink_table, pk, data, change_ts)."""
    routed = route_by_config(keep_types(changes), current_config(config_changes))
    routed = routed.withColumn("change_ts", cdc.change_seconds())
    return latest_by_key(routed, ["sink_table", "pk"], order).select("sink_table", "pk", "data", "change_ts")


def order_wide(changes, dictionary, ttl=None, delay="0 seconds"):
    """Order lines with their order, activity, coupon and source name; one row per order change.

    Activity and coupon are joined before the order: both share the line id, and the lines have
    not yet been multiplied by the changes of their order.
    """
    changes = _timed(changes, delay, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
    lines = select_table(changes, "order_detail", S.ORDER_DETAIL_FIELDS, ["insert"], keep={"ts": "od_ts"})
    if dictionary is not None:
        lines = lookup_join(lines, dictionary, "source_type", {"dic_name": "source_type_name"})
    orders = (
        select_table(changes, "order_info", S.ORDER_INFO_FIELDS, ["insert", "update"],
                     keep={"type": "type", "old": "old", "ts": "oi_ts"})
        .withColumnRenamed("id", "info_id"))
    activities = select_table(changes, "order_detail_activity", S.ORDER_ACTIVITY_FIELDS, ["insert"],
                              keep={"ts": "act_ts"})
    coupons = select_table(changes, "order_detail_coupon", S.ORDER_COUPON_FIELDS, ["insert"],
                           keep={"ts": "cou_ts"})

    wide = retained_join(lines, activities, [("id", "order_detail_id")], "left", ttl, "od_ts", "act_ts", delay)
    wide = retained_join(wide, coupons, [("id", "order_detail_id")], "left", ttl, "od_ts", "cou_ts", delay)
    wide = retained_join(wide, orders, [("order_id", "info_id")], "inner", ttl, "od_ts", "oi_ts", delay)
    wide = (
        wide.withColumn("split_original_amount", cdc.line_amount(F.col("sku_num"), F.col("order_price")))
        .withColumn("date_id", cdc.date_id(F.col("create_time")))
        .withColumn("operate_date_id", cdc.date_id(F.col("operate_time"))))
    return _finished("order_wide", wide, dictionary)


def order_detail(wide):
    """Placed order lines."""
    rows = (wide.filter(F.col("type") == "insert")
                .withColumnsRenamed({"source_type": "source_type_code", "od_ts": "ts"}))
    return rows.select(*S.ORDER_DETAIL_COLUMNS)


def order_cancel(wide):
    """Cancelled order lines."""
    cancelled = ((F.col("type") == "update") & (F.col("order_status") == S.ORDER_CANCELLED)
                 & cdc.old("order_status").isNotNull())
    rows = (wide.filter(cancelled).drop("date_id")
                .withColumnsRenamed({"operate_date_id": "date_id", "operate_time": "cancel_time",
                                     "source_type": "source_type_code", "oi_ts": "ts"}))
    return rows.select(*S.ORDER_CANCEL_COLUMNS)


def cart_add(changes, dictionary):
    """Additions to the cart: new lines, and what was added to lines already there."""
    added = (
        changes.filter((F.col("table") == "cart_info") & cdc.is_increase("sku_num"))
        .select(*[cdc.data(c).alias(c) for c in S.CART_FIELDS],
                cdc.increase("sku_num").alias("sku_num"), "ts"))
    added = added.withColumnRenamed("source_type", "source_type_id")
    added = lookup_join(added, dictionary, "source_type_id", {"dic_name": "source_type_name"})
    return added.select(*S.CART_ADD_COLUMNS)


def payment_success(changes, detail, dictionary, ttl=None, delay="0 seconds"):
    """Paid order lines. ``detail`` is the output of ``order_detail``, read back where it landed."""
    changes = _timed(changes, delay, "payment_info")
    payments = select_table(changes, "payment_info", S.PAYMENT_FIELDS, ["update"],
                            where=cdc.data("payment_status") == S.PAYMENT_PAID, keep=["ts"])
    if dictionary is not None:
        payments = lookup_join(payments, dictionary, "payment_type", {"dic_name": "payment_type_name"})
    payments = payments.drop("user_id").withColumnsRenamed({
        "order_id": "paid_order_id", "payment_type": "payment_type_code"})
    detail = detail.withColumnsRenamed({
        "id": "order_detail_id", "ts": "od_ts", "split_total_amount": "split_payment_amount"})
    # With a band the right rows are repeated: payments, which are fewer and narrower than lines.
    paid = retained_join(detail, payments, [("order_id", "paid_order_id")], "inner", ttl, "od_ts", "ts", delay)
    return _finished("payment_success", paid, dictionary)


def order_refund(changes, dictionary, ttl=None, delay="0 seconds"):
    """Refund requests with the province of their order and the names of type and reason."""
    changes = _timed(changes, delay, "order_refund_info", "order_info")
    requests = select_table(changes, "order_refund_info", S.REFUND_REQUEST_FIELDS, ["insert"], keep=["ts"])
    if dictionary is not None:
        requests = two_role_lookup(requests, dictionary, {
            "refund_type": "refund_type_name", "refund_reason_type": "refund_reason_type_name"})
    orders = select_table(changes, "order_info", ["id", "province_id"],
                          where=cdc.status_changed("order_status", S.ORDER_REFUND_REQUESTED),
                          keep={"ts": "oi_ts"}).withColumnRenamed("id", "info_id")
    rows = retained_join(requests, orders, [("order_id", "info_id")], "inner", ttl, "ts", "oi_ts", delay)
    rows = (rows.withColumn("date_id", cdc.date_id(F.col("create_time")))
                .withColumnsRenamed({"refund_type": "refund_type_code",
                                     "refund_reason_type": "refund_reason_type_code"}))
    return _finished("order_refund", rows, dictionary)


def refund_success(changes, dictionary, ttl=None, delay="0 seconds", types=None):
    """Paid-out refunds with their order and refund request.

    By default every change of a refund and of its request counts, so several changes of one refund
    give several rows; ``types`` restricts both to some change types.
    """
    changes = _timed(changes, delay, "refund_payment", "order_info", "order_refund_info")
    refunds = select_table(changes, "refund_payment", S.REFUND_PAYMENT_FIELDS, types,
                           where=cdc.data("refund_status") == S.REFUND_PAID, keep=["ts"])
    if dictionary is not None:
        refunds = lookup_join(refunds, dictionary, "payment_type", {"dic_name": "payment_type_name"})
    orders = select_table(changes, "order_info", ["id", "user_id", "province_id"],
                          where=cdc.status_changed("order_status", S.ORDER_REFUND_DONE),
                          keep={"ts": "oi_ts"}).withColumnRenamed("id", "info_id")
    requests = (select_table(changes, "order_refund_info", ["order_id", "sku_id", "refund_num"], types,
                             keep={"ts": "ri_ts"})
                .withColumnsRenamed({"order_id": "request_order", "sku_id": "request_sku"}))
    rows = retained_join(refunds, orders, [("order_id", "info_id")], "inner", ttl, "ts", "oi_ts", delay)
    rows = retained_join(rows, requests, [("order_id", "request_order"), ("sku_id", "request_sku")],
                         "inner", ttl, "ts", "ri_ts", delay)
    rows = (rows.withColumn("date_id", cdc.date_id(F.col("callback_time")))
                .withColumnsRenamed({"payment_type": "payment_type_code", "total_amount": "refund_amount"}))
    return _finished("refund_success", rows, dictionary)


def log_records(log, order="arrival", tz="UTC"):
    """Usable log records with the new-visitor flag repaired, and the dirty ones."""
    good, dirty = split_dirty(parse_log(log))
    return write_flag(repair_new_flag(good, order=order, tz=tz)), dirty


def log_split(log, order="arrival", tz="UTC"):
    """The five log outputs as rows (target, value) (batch form)."""
    good, _ = log_records(log, order, tz)
    return route_log(good)


def unique_visitor(pages, order="arrival", tz="UTC"):
    """Page records that are a visitor's first session start of the day (batch form).

    ``pages`` holds page-record text (``value``) and ``order``."""
    good, _ = split_dirty(parse_log(pages))
    return first_visit_per_day(good, order=order, tz=tz).select("value", "mid", "ts", order)


def user_jump(pages, order="arrival", within=S.BOUNCE_WITHIN_MS):
    """Page records that are bounces (batch form)."""
    good, _ = split_dirty(parse_log(pages))
    slim = good.select("value", "mid", "ts", "last_page_id", order)
    return detect_bounce(slim, order=order, within=within).select("value", "mid", "ts", order)
