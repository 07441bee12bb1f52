"""One query per operator and flow, over the test tables."""

from pyspark.sql import functions as F

from millrace import feeds, schemas
from millrace.functions import cdc
from millrace.functions import records as R
from millrace.functions.times import event_day, event_time_text, to_epoch_ms
from millrace.operators.joins import lookup_join, retained_join, two_role_lookup
from millrace.operators.logsplit import route_log, split_log
from millrace.operators.quality import parse_log, split_dirty
from millrace.operators.routing import UNROUTED, current_config, route_by_config, unrouted
from millrace.operators.selection import keep_types, select_table, union_all
from millrace.operators.upsert import latest_by_key
from millrace.operators.visitors import (
    assign_event_time, detect_bounce, first_visit_per_day, is_session_start, repair_new_flag)
from millrace.plans import flows
from millrace.session import streaming_session, work_folder
from millrace.sinks.dimensions import config_rows, dimension_log, ensure_table, publish_dimension, read_dimension, upsert_dimensions
from millrace.sinks.merged import MergedTable, start_upsert
from millrace.sinks.writers import as_messages, fan_out, land_changes, latest_messages, read_latest, write_append, write_upsert
from millrace.sources.changes import read_changes, read_config_changes, read_detail
from millrace.sources.lookup import RefreshingLookup, read_lookup
from millrace.sources.topics import read_log
from millrace.streaming import jobs
from millrace.streaming.config import ConfigLog

SIX_HOURS = 6 * 3600 * 1000
ONE_DAY = 24 * 3600 * 1000


def _plain(df):
    """Drop what an equality check cannot hold: the change map and the processing stamp."""
    return df.drop("old", "row_op_ts")


def _changes(spark, sf):
    return feeds.change_log(spark, sf)


def _whole_changes(spark, sf):
    """The same rows, for what reads every table's."""
    return feeds.change_log(spark, sf, whole=True)


def order_wide(spark, sf):
    return _plain(flows.order_wide(_changes(spark, sf), feeds.dictionary(spark)))


def order_detail(spark, sf):
    return _plain(flows.order_detail(flows.order_wide(_changes(spark, sf), feeds.dictionary(spark))))


def order_cancel(spark, sf):
    return _plain(flows.order_cancel(flows.order_wide(_changes(spark, sf), feeds.dictionary(spark))))


def cart_add(spark, sf):
    return flows.cart_add(_changes(spark, sf), feeds.dictionary(spark))


def cart_add_from_text(spark, sf):
    changes = read_changes(feeds.as_text(_whole_changes(spark, sf)), tables=["cart_info"])
    return flows.cart_add(changes, feeds.dictionary(spark))


def payment_success(spark, sf):
    changes, names = _changes(spark, sf), feeds.dictionary(spark)
    detail = flows.order_detail(flows.order_wide(changes, names))
    return _plain(flows.payment_success(changes, detail, names))


def payment_success_band(spark, sf):
    changes, names = _changes(spark, sf), feeds.dictionary(spark)
    detail = flows.order_detail(flows.order_wide(changes, names))
    return _plain(flows.payment_success(changes, detail, names, ttl=schemas.PAYMENT_JOIN_TTL))


def order_refund(spark, sf):
    return _plain(flows.order_refund(_changes(spark, sf), feeds.dictionary(spark)))


def refund_success(spark, sf):
    return _plain(flows.refund_success(_changes(spark, sf), feeds.dictionary(spark)))


def _lines(changes):
    return select_table(changes, "order_detail", ["id", "order_id"], ["insert"], keep={"ts": "od_ts"})


def retained_join_band(spark, sf):
    changes = _changes(spark, sf)
    orders = (select_table(changes, "order_info", ["id", "order_status"], ["insert", "update"],
                           keep={"ts": "oi_ts"}).withColumnRenamed("id", "info_id"))
    return retained_join(_lines(changes), orders, [("order_id", "info_id")], ttl=schemas.ORDER_JOIN_TTL,
                         left_ts="od_ts", right_ts="oi_ts")


def left_join_pad(spark, sf):
    changes = _changes(spark, sf)
    activities = select_table(changes, "order_detail_activity", schemas.ORDER_ACTIVITY_FIELDS, ["insert"])
    return retained_join(_lines(changes), activities, [("id", "order_detail_id")], "left")


def left_join_pad_band(spark, sf):
    changes = _changes(spark, sf)
    updates = (select_table(changes, "payment_info", ["order_id", "callback_time"], ["update"], keep={"ts": "pi_ts"})
               .withColumnRenamed("order_id", "paid_id"))
    return retained_join(_lines(changes), updates, [("order_id", "paid_id")], "left", ttl=900,
                         left_ts="od_ts", right_ts="pi_ts")


def composite_join(spark, sf):
    changes = _changes(spark, sf)
    refunds = select_table(changes, "refund_payment", ["id", "order_id", "sku_id"], keep=["ts"])
    requests = (select_table(changes, "order_refund_info", ["order_id", "sku_id", "refund_num"],
                             keep={"type": "request_type"})
                .withColumnsRenamed({"order_id": "request_order", "sku_id": "request_sku"}))
    return retained_join(refunds, requests, [("order_id", "request_order"), ("sku_id", "request_sku")])


def two_roles(spark, sf):
    rows = select_table(_changes(spark, sf), "order_refund_info", ["id", "refund_type", "refund_reason_type"],
                        ["insert"])
    return two_role_lookup(rows, feeds.dictionary(spark),
                           {"refund_type": "type_name", "refund_reason_type": "reason_name"})


def first_visits(spark, sf):
    return first_visit_per_day(feeds.page_rows(spark, sf))


def bounces(spark, sf):
    return detect_bounce(feeds.page_rows(spark, sf), within=SIX_HOURS, span=ONE_DAY)


def repaired_flags(spark, sf):
    return repair_new_flag(feeds.page_rows(spark, sf))


def session_starts(spark, sf):
    return feeds.page_rows(spark, sf).filter(is_session_start()).select("mid", "page_id", "ts", "arrival")


def event_times(spark, sf):
    rows = assign_event_time(feeds.page_rows(spark, sf))
    return rows.select("arrival", F.unix_millis("event_time").alias("event_ms"), "ts")


def event_time(spark, sf):
    ts = F.col("ts")
    return feeds.page_rows(spark, sf).select(
        "arrival", event_day(ts).alias("day"), event_day(ts, "+08:00").alias("day_east"),
        event_time_text(ts).alias("time_text"), event_time_text(ts, "+08:00").alias("time_east"),
        to_epoch_ms(event_time_text(ts, "+08:00"), "+08:00").alias("back_ms"),
        to_epoch_ms(event_day(ts)).alias("midnight_ms"))


def _repaired_log(spark, sf):
    good, _ = flows.log_records(feeds.log_text(spark, sf))
    return good


def _member(path, kind="string"):
    return F.try_variant_get(F.col("_j"), path, kind)


def _opened(df):
    return df.select(F.parse_json("value").alias("_j"))


def log_page(spark, sf):
    pages = _opened(split_log(_repaired_log(spark, sf))["page"])
    return pages.select(_member("$.common.mid").alias("mid"), _member("$.common.is_new").alias("is_new"),
                        _member("$.page.page_id").alias("page_id"), _member("$.page.last_page_id").alias("last_page_id"),
                        _member("$.ts", "bigint").alias("ts"),
                        F.size(F.map_keys(R.as_record(F.col("_j")))).alias("members"))


def log_start(spark, sf):
    starts = _opened(split_log(_repaired_log(spark, sf))["start"])
    return starts.select(_member("$.common.mid").alias("mid"), _member("$.common.is_new").alias("is_new"),
                         _member("$.start.entry").alias("entry"), _member("$.ts", "bigint").alias("ts"))


def _common(path):
    """A member of the common part, which displays and actions carry as JSON text."""
    return F.get_json_object(_member("$.common"), path)


def log_display(spark, sf):
    displays = _opened(split_log(_repaired_log(spark, sf))["display"])
    return displays.select(_common("$.mid").alias("mid"), _common("$.is_new").alias("is_new"),
                           _member("$.page_id").alias("page_id"), _member("$.item").alias("item"),
                           _member("$.ts", "bigint").alias("ts"))


def log_action(spark, sf):
    actions = _opened(split_log(_repaired_log(spark, sf))["action"])
    return actions.select(_common("$.mid").alias("mid"), _member("$.page_id").alias("page_id"),
                          _member("$.action_id").alias("action_id"), _member("$.ts", "bigint").alias("ts"))


def log_error(spark, sf):
    errors = _opened(split_log(_repaired_log(spark, sf))["error"])
    return errors.select(_common("$.mid").alias("mid"), _member("$.err.error_code").alias("error_code"),
                         _member("$.page.page_id").alias("page_id"), _member("$.ts", "bigint").alias("ts"),
                         F.size(_member("$.displays", "array<variant>")).alias("n_displays"))


def routed_log(spark, sf):
    routed = route_log(_repaired_log(spark, sf), keep=["arrival"])
    return routed.select("arrival", "target", F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


def dirty_good(spark, sf):
    good, _ = split_dirty(parse_log(feeds.log_text(spark, sf, dirt=True)))
    return good.select("mid", "ts", "arrival")


def dirty_bad(spark, sf):
    return split_dirty(parse_log(feeds.log_text(spark, sf, dirt=True)))[1]


def _page_target(spark, sf):
    """The page output of the log split, as the visitor flows read it."""
    return split_log(_repaired_log(spark, sf), keep=["arrival"])["page"]


def unique_visitor(spark, sf):
    rows = flows.unique_visitor(_page_target(spark, sf))
    return rows.select("mid", "ts", "arrival", F.get_json_object("value", "$.page.page_id").alias("page_id"))


def user_jump(spark, sf):
    rows = flows.user_jump(_page_target(spark, sf), within=SIX_HOURS)
    return rows.select("mid", "ts", "arrival", F.get_json_object("value", "$.page.page_id").alias("page_id"))


def status_changed(spark, sf):
    changes = _changes(spark, sf)
    return select_table(changes, "order_info", ["id", "order_status"],
                        where=cdc.status_changed("order_status", schemas.ORDER_REFUND_REQUESTED), keep=["ts"])


def increase(spark, sf):
    rows = _changes(spark, sf).filter((F.col("table") == "cart_info") & cdc.is_increase("sku_num"))
    return rows.select(cdc.data("id").alias("id"), "type", cdc.increase("sku_num").alias("sku_num"))


def line_amount(spark, sf):
    rows = select_table(_changes(spark, sf), "order_detail", ["id", "sku_num", "order_price"])
    return rows.select("id", cdc.line_amount(F.col("sku_num"), F.col("order_price")).alias("amount"))


def date_id(spark, sf):
    rows = select_table(_changes(spark, sf), "order_info", ["id", "operate_time"], keep=["ts"])
    return rows.select("id", "ts", cdc.date_id(F.col("operate_time")).alias("operate_date_id"))


def keep_columns(spark, sf):
    rows = feeds.master_changes(spark, sf).filter(F.col("table") == "customer")
    kept = rows.withColumn("data", cdc.keep_columns(F.col("data"), F.lit("id,c_name")))
    return kept.select("type", cdc.data("id").alias("id"), cdc.data("c_name").alias("c_name"),
                       cdc.data("c_mktsegment").alias("c_mktsegment"), F.size("data").alias("members"))


def kept_types(spark, sf):
    rows = keep_types(feeds.master_changes(spark, sf))
    return rows.select("table", "type", "ts", cdc.data("id").alias("id"))


def union_of_streams(spark, sf):
    pages = feeds.page_rows(spark, sf)
    starts, others = pages.filter(is_session_start()), pages.filter(~is_session_start())
    return union_all(starts, others).select("mid", "page_id", "ts", "arrival")


def latest(spark, sf):
    wide = flows.order_wide(_changes(spark, sf), feeds.dictionary(spark))
    ties = [F.coalesce(c, F.lit("")) for c in ("split_total_amount", "sku_num", "activity_id", "coupon_id")]
    return _plain(latest_by_key(wide, ["id"], [cdc.change_seconds("oi_ts"), *ties]))


def config_in_force(spark, sf):
    return current_config(feeds.config_changes_from_events(spark, sf), order=["ts_ms", "event_id"])


def config_from_text(spark, sf):
    events = feeds.config_changes_from_events(spark, sf)
    text = events.select(F.to_json(F.struct("op", "before", "after", "ts_ms")).alias("value"), "event_id")
    return current_config(read_config_changes(text, keep=["event_id"]), order=["ts_ms", "event_id"])


def _config(spark):
    return current_config(feeds.config_changes(spark))


def routed_changes(spark, sf):
    routed = route_by_config(keep_types(feeds.master_changes(spark, sf)), _config(spark))
    return routed.select("sink_table", "type", "ts", F.array_join("pk", ",").alias("pk"), cdc.data("c_name").alias("c_name"),
                         cdc.data("p_name").alias("p_name"), cdc.data("p_brand").alias("p_brand"),
                         F.size("data").alias("members"))


def unrouted_changes(spark, sf):
    rows = unrouted(keep_types(feeds.master_changes(spark, sf)), _config(spark))
    return rows.select("table", cdc.data("id").alias("id"))


def dimensions(spark, sf):
    rows = flows.dimensions(feeds.master_changes(spark, sf), feeds.config_changes(spark))
    return rows.select("sink_table", "change_ts", *[cdc.data(c).alias(c) for c in ("id", "c_name", "p_name", "p_brand")])


def changes_from_text(spark, sf):
    rows = read_changes(feeds.as_text(_whole_changes(spark, sf)))
    return rows.select("table", "type", "ts", F.coalesce(cdc.data("id"), cdc.data("order_detail_id")).alias("id"),
                       cdc.data("order_id").alias("order_id"), F.size("data").alias("members"),
                       F.coalesce(cdc.old("order_status"), cdc.old("sku_num")).alias("before"))


def detail_from_text(spark, sf):
    detail = flows.order_detail(flows.order_wide(_changes(spark, sf), feeds.dictionary(spark)))
    text = detail.select(F.to_json(F.struct("*")).alias("value"))
    return _plain(read_detail(text, schemas.ORDER_DETAIL_COLUMNS))


def _run_stream(spark, name, start):
    """Run one job over what is there, in a session of its own, and read its result back."""
    session = streaming_session(spark)
    folder = work_folder(spark, name)
    query = start(session, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def stream_cart_add(spark, sf):
    return _run_stream(spark, "cart_add", lambda session, out, ck: jobs.start_cart_add(
        feeds.change_log(session, sf, stream=True), feeds.dictionary(session), out, ck))


def stream_retained_join(spark, sf):
    def start(session, out, ck):
        changes = feeds.change_log(session, sf, stream=True)
        orders = (select_table(changes, "order_info", ["id", "order_status"], ["insert", "update"],
                               keep={"ts": "oi_ts"}).withColumnRenamed("id", "info_id"))
        joined = retained_join(_lines(changes), orders, [("order_id", "info_id")], ttl=schemas.ORDER_JOIN_TTL,
                               left_ts="od_ts", right_ts="oi_ts")
        return write_append(joined.drop("event_time"), out, ck)
    return _run_stream(spark, "retained_join", start)


def stream_log_split(spark, sf):
    rows = _run_stream(spark, "log_split", lambda session, out, ck: jobs.start_log_split(
        feeds.log_text(session, sf, stream=True), out, ck))
    common = F.get_json_object("value", "$.common")
    return rows.select("arrival", "target", F.get_json_object(common, "$.is_new").alias("is_new"),
                       F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


def stream_log_dirty(spark, sf):
    """The dirty output of the log split; its other outputs hold the rest of the records."""
    rows = _run_stream(spark, "log_dirty", lambda session, out, ck: jobs.start_log_split(
        feeds.log_text(session, sf, dirt=True, stream=True), out, ck))
    return rows.filter(F.col("target") == "dirty").select("value", "arrival")


def _landed(spark, session, changes, files=8):
    """A change log landed by table, as a stream of several micro-batches."""
    folder = work_folder(spark, "changes")
    land_changes(changes, folder)
    return session.readStream.schema(changes.schema).option("maxFilesPerTrigger", files).parquet(folder)


# Long enough for every row of the test tables to meet its partners, in whatever order the files come.
ALL_TIME = {"ttl": 20 * 365 * 24 * 3600, "delay": "7300 days"}


def stream_order_refund(spark, sf):
    return _plain(_run_stream(spark, "order_refund", lambda session, out, ck: jobs.start_order_refund(
        _landed(spark, session, _whole_changes(spark, sf)), feeds.dictionary(session), out, ck, **ALL_TIME)))


def stream_refund_success(spark, sf):
    return _plain(_run_stream(spark, "refund_success", lambda session, out, ck: jobs.start_refund_success(
        _landed(spark, session, _whole_changes(spark, sf)), feeds.dictionary(session), out, ck, **ALL_TIME)))


def stream_left_join_early(spark, sf):
    """Order lines that go out padded at once and again when their activity comes, several micro-batches later."""
    session = streaming_session(spark)
    changes = _changes(spark, sf)
    # Few lines of the test tables share an id; one activity each, so that their last revision is one.
    activities = select_table(changes, "order_detail_activity", schemas.ORDER_ACTIVITY_FIELDS, ["insert"]).groupBy("order_detail_id").agg(
        *[F.max(c).alias(c) for c in ("activity_id", "activity_rule_id")])
    folder = work_folder(spark, "early")
    sides = []
    for name, rows, files in (("lines", _lines(changes), 16), ("activities", activities, 1)):
        write_append(rows, f"{folder}/{name}")
        sides.append(session.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/{name}"))
    jobs.start_waiting_join(*sides, [("id", "order_detail_id")], f"{folder}/out", f"{folder}/checkpoint", ["id"],
                            ttl=24 * 3600).awaitTermination()
    return read_latest(spark, f"{folder}/out", ["id"], ["revision"]).drop("revision")


def stream_unrouted(spark, sf):
    """What the dimension job sets aside because no configuration names its table; the configuration is read on from its log."""
    session = streaming_session(spark)
    root = work_folder(spark, "dimensions")
    feeds.config_changes(spark).write.parquet(f"{root}/log")
    events = lambda: session.readStream.schema(feeds.config_changes(spark).schema).parquet(f"{root}/log")
    changes = _landed(spark, session, feeds.master_changes(spark, sf), files=4)
    jobs.start_dimensions(changes, ConfigLog(session, events, f"{root}/config"), f"{root}/out", f"{root}/checkpoint",
                          rejects=f"{root}/rejects").awaitTermination()
    rows = spark.read.parquet(f"{root}/rejects/rows").filter(F.col("outcome") == UNROUTED)
    return rows.filter(F.col("type").isin(*schemas.KEPT_TYPES)).select("table", cdc.data("id").alias("id"))


def _dirty_change_texts(spark, sf):
    """The order events of a change log as text; of each 97 orders one text is broken and one has no time."""
    rows = _changes(spark, sf).filter((F.col("table") == "order_info") & (F.col("type") == "insert"))
    number = cdc.data("id").cast("long") % 97
    text = feeds.as_text(rows.withColumn("ts", F.when(number == 5, "soon").otherwise(F.col("ts"))).withColumn("number", number), keep=["number"])
    return text.select(F.when(F.col("number") == 7, F.concat(F.lit("{"), "value")).otherwise(F.col("value")).alias("value"))


def changes_dirty(spark, sf):
    """Texts landed in one pass: how many came out as what, and what the faulty ones say."""
    session = streaming_session(spark)
    folder = work_folder(spark, "change-texts")
    _dirty_change_texts(spark, sf).write.text(f"{folder}/log")
    log = read_log(session, "text", path=f"{folder}/log", maxFilesPerTrigger=4)
    jobs.start_changes(log, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    good = jobs.landed_changes(spark, f"{folder}/out").select(F.lit("change").alias("outcome"), cdc.data("id").alias("id"))
    faulty = jobs.faulty_changes(spark, f"{folder}/out").select("outcome", F.regexp_extract("value", '"id":"([0-9]+)"', 1).alias("id"))
    return union_all(good, faulty)


def logged_records(spark, sf):
    """The behaviour log written to a topic folder and read back by its reader, as a batch."""
    folder = work_folder(spark, "log")
    feeds.log_text(spark, sf).select("value").write.text(folder)
    rows = read_log(spark, "text", streaming=False, path=folder)
    return rows.select(F.get_json_object("value", "$.common.mid").alias("mid"), F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


def looked_up(spark, sf):
    """The nations as a dictionary in a file, read by its reader and joined to the suppliers."""
    folder = work_folder(spark, "dictionary")
    feeds.table(spark, sf, "nation").selectExpr("cast(n_nationkey as string) as dic_code", "n_name as dic_name").write.parquet(folder)
    names = RefreshingLookup(lambda: read_lookup(spark, "parquet", ["dic_code", "dic_name"], path=folder))
    suppliers = feeds.table(spark, sf, "supplier").selectExpr("s_suppkey", "cast(s_nationkey as string) as code")
    return lookup_join(suppliers, names(), "code", {"dic_name": "nation"})


def stream_dimensions(spark, sf):
    session = streaming_session(spark)
    root, checkpoint = work_folder(spark, "dimensions"), work_folder(spark, "checkpoint")
    changes = _landed(spark, session, feeds.master_changes(spark, sf), files=4)
    jobs.start_dimensions(changes, lambda: feeds.config_changes(session), root, checkpoint).awaitTermination()
    return _dimension_rows(spark, _config(spark), root)


def stream_unique_visitor(spark, sf):
    rows = _run_stream(spark, "unique_visitor", lambda session, out, ck: jobs.start_unique_visitor(
        feeds.page_text(session, sf, stream=True), out, ck))
    return rows.select("mid", event_day(F.col("ts")).alias("day"))


def stream_user_jump(spark, sf):
    rows = _run_stream(spark, "user_jump", lambda session, out, ck: jobs.start_user_jump(
        feeds.page_text(session, sf, stream=True), out, ck, within=SIX_HOURS))
    return rows.select("mid", "ts", "arrival", F.get_json_object("value", "$.page.page_id").alias("page_id"))


def upserted_dimensions(spark, sf):
    """The dimension sink: written in one pass, then each table's current rows."""
    root = work_folder(spark, "dimensions")
    config = _config(spark)
    routed = route_by_config(keep_types(feeds.master_changes(spark, sf)), config)
    upsert_dimensions(routed.withColumn("change_ts", cdc.change_seconds()), root)
    return _dimension_rows(spark, config, root)


def _dimension_rows(spark, config, root):
    tables = [read_dimension(spark, row, root).withColumn("sink_table", F.lit(row["sink_table"]))
              for row in config_rows(config)]
    return _aligned(tables)


def _aligned(tables):
    merged = tables[0]
    for more in tables[1:]:
        merged = merged.unionByName(more, allowMissingColumns=True)
    return merged.select("sink_table", "id", "c_name", "p_name", "p_brand")


def upserted_orders(spark, sf):
    """The upsert sink: every version of an order appended, then the current ones."""
    folder = work_folder(spark, "orders")
    orders = select_table(_changes(spark, sf), "order_info", ["id", "user_id", "order_status"], keep=["ts"])
    write_upsert(orders, folder, ["id"])
    return read_latest(spark, folder, ["id"], [cdc.change_seconds()])


ORDER_ROWS = "id string, user_id string, order_status string, ts string"


def _order_rows(changes):
    return select_table(changes, "order_info", ["id", "user_id", "order_status"], keep=["ts"])


def compacted_upsert(spark, sf):
    """Orders appended in batches, the placed ones last, and compacted between and behind them."""
    table = MergedTable(spark, work_folder(spark, "orders"), ORDER_ROWS, ["id"], ["try_cast(ts as bigint)"], buckets=16)
    orders = _order_rows(_changes(spark, sf))
    batches = [F.col("order_status").isin("1003", "1005"), F.col("order_status") == "1001", F.col("order_status") == "1006"]
    for n, condition in enumerate(batches):
        table.append(orders.filter(condition), n)
        if n < 2:
            table.compact()
    return table.current()


def stream_upsert(spark, sf):
    """The upsert sink as a stream that compacts its table after every second micro-batch."""
    session = streaming_session(spark)
    table = MergedTable(spark, work_folder(spark, "orders"), ORDER_ROWS, ["id"], ["try_cast(ts as bigint)"], buckets=16)
    changes = _landed(spark, session, _changes(spark, sf).filter(F.col("table") == "order_info"))
    start_upsert(_order_rows(changes), table, work_folder(spark, "checkpoint"), compact_every=2).awaitTermination()
    return table.current()


def _customer_changes(spark, sf):
    rows = feeds.master_changes(spark, sf).filter(F.col("table") == "customer")
    return rows.select(cdc.data("id").alias("id"), cdc.data("c_name").alias("c_name"), "type", "ts")


def upserted_with_deletes(spark, sf):
    """Customers whose deletes come first and survive the compaction that their older rows meet later."""
    table = MergedTable(spark, work_folder(spark, "customers"), "id string, c_name string, type string, ts string", ["id"],
                        ["try_cast(ts as bigint)"], deleted="type = 'delete'", buckets=16)
    customers = _customer_changes(spark, sf)
    for n, kind in enumerate(("delete", "bootstrap-insert", "update")):
        table.append(customers.filter(F.col("type") == kind), n)
        table.compact()
    table.vacuum()
    return table.current().select("id", "c_name")


def topic_with_deletes(spark, sf):
    """The same as messages: a delete is a key without a value."""
    customers = _customer_changes(spark, sf)
    messages = as_messages(customers.select("id", "c_name", "type"), ["id"], deleted=F.col("type") == "delete")
    folder = work_folder(spark, "topic")
    arrival = F.when(F.col("value").isNull(), 3).when(F.get_json_object("value", "$.type") == "update", 2).otherwise(1)
    messages.withColumn("arrival", arrival).write.parquet(folder)
    return latest_messages(spark.read.parquet(folder), "id string, c_name string")


def compacted_dimensions(spark, sf):
    """The dimension sink in two batches, the renamed rows first, compacted after each."""
    root = work_folder(spark, "dimensions")
    config = _config(spark)
    routed = route_by_config(keep_types(feeds.master_changes(spark, sf)), config).withColumn("change_ts", cdc.change_seconds())
    for n, condition in enumerate((F.col("type") == "update", F.col("type") != "update")):
        upsert_dimensions(routed.filter(condition), root, n)
        dimension_log(spark, root, buckets=16).compact()
    return _dimension_rows(spark, config, root)


def published_dimensions(spark, sf):
    """The dimension tables created in the catalog from their configuration, and filled."""
    root, tables = work_folder(spark, "dimensions"), work_folder(spark, "tables")
    config = _config(spark)
    upsert_dimensions(route_by_config(keep_types(feeds.master_changes(spark, sf)), config).withColumn(
        "change_ts", cdc.change_seconds()), root)
    # Names of their own for every run: tables outlive the query in a catalog that others share.
    run, made = tables.rsplit("-", 1)[-1], []
    for row in config_rows(config):
        name = publish_dimension(spark, row, root, tables, name=f"{row['sink_table']}_{run}")
        made.append(spark.table(name).withColumn("sink_table", F.lit(row["sink_table"])))
    return _aligned(made)


def fanned_out_log(spark, sf):
    """Five outputs of one batch in five folders."""
    folder = work_folder(spark, "log")
    targets = {name: f"{folder}/{name}" for name in schemas.LOG_TARGETS}
    fan_out(_repaired_log(spark, sf), split_log, targets, batch_id=0)
    outputs = [spark.read.schema("value string").text(path).withColumn("target", F.lit(name))
               for name, path in targets.items()]
    return union_all(*outputs).select("target", F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


QUERIES = {
    # flows
    "order_wide": order_wide,
    "order_detail": order_detail,
    "order_cancel": order_cancel,
    "cart_add": cart_add,
    "cart_add_from_text": cart_add_from_text,
    "payment_success": payment_success,
    "payment_success_band": payment_success_band,
    "order_refund": order_refund,
    "refund_success": refund_success,
    "dimensions": dimensions,
    "log_page": log_page,
    "log_start": log_start,
    "log_display": log_display,
    "log_action": log_action,
    "log_error": log_error,
    "log_split": routed_log,
    "unique_visitor": unique_visitor,
    "user_jump": user_jump,
    # joins
    "retained_join_band": retained_join_band,
    "left_join_pad": left_join_pad,
    "left_join_pad_band": left_join_pad_band,
    "composite_join": composite_join,
    "two_role_lookup": two_roles,
    "route_by_config": routed_changes,
    "unrouted": unrouted_changes,
    "current_config": config_in_force,
    "latest_by_key": latest,
    # visitors
    "first_visit_per_day": first_visits,
    "detect_bounce": bounces,
    "repair_new_flag": repaired_flags,
    "session_start": session_starts,
    "assign_event_time": event_times,
    "union_all": union_of_streams,
    # rows and columns
    "dirty_good": dirty_good,
    "dirty_bad": dirty_bad,
    "keep_types": kept_types,
    "status_changed": status_changed,
    "increase": increase,
    "line_amount": line_amount,
    "date_id": date_id,
    "event_time": event_time,
    "keep_columns": keep_columns,
    # typed sources
    "read_changes": changes_from_text,
    "read_config_changes": config_from_text,
    "read_detail": detail_from_text,
    "read_log": logged_records,
    "read_lookup": looked_up,
    "changes_dirty": changes_dirty,
    # sinks
    "upsert_dimensions": upserted_dimensions,
    "write_upsert": upserted_orders,
    "compact_upsert": compacted_upsert,
    "upsert_with_deletes": upserted_with_deletes,
    "topic_with_deletes": topic_with_deletes,
    "compact_dimensions": compacted_dimensions,
    "publish_dimension": published_dimensions,
    "fan_out": fanned_out_log,
    # streaming forms
    "stream_upsert": stream_upsert,
    "stream_cart_add": stream_cart_add,
    "stream_retained_join": stream_retained_join,
    "stream_log_split": stream_log_split,
    "stream_log_dirty": stream_log_dirty,
    "stream_left_join_early": stream_left_join_early,
    "stream_unrouted": stream_unrouted,
    "stream_order_refund": stream_order_refund,
    "stream_refund_success": stream_refund_success,
    "stream_dimensions": stream_dimensions,
    "stream_unique_visitor": stream_unique_visitor,
    "stream_user_jump": stream_user_jump,
}
