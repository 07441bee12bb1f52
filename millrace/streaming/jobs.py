"""The warehouse's jobs as streaming queries: read, compose a flow, write.

Every function starts one query and returns it. Targets are folders unless a format is given.
Streams come from ``read_log`` and ``read_changes``, so the source (topic or files) is the caller's.
"""

from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions import cdc
from millrace.operators.logsplit import route_log, write_flag
from millrace.operators.quality import is_usable, parse_log, split_dirty
from millrace.operators.routing import NO_DATA, ROUTED, UNROUTED, current_config, route_by_config, tag_by_config
from millrace.operators.selection import keep_types
from millrace.plans import flows
from millrace.sinks.dimensions import config_rows, ensure_table, upsert_dimensions
from millrace.sinks.writers import write_append, write_batch, write_upsert
from millrace.sources.changes import CHANGE, UNREADABLE, UNTIMED, split_changes, tag_changes
from millrace.streaming import visitors
from millrace.streaming.config import ConfigLog
from millrace.streaming.joins import waiting_join


def start_changes(log, target, checkpoint, **options):
    """Land the texts of a change log in one pass, by ``outcome`` and table: the change rows that the flows read
    (``landed_changes``), and what is unreadable or names no time, with its text (``faulty_changes``).

    Each micro-batch's progress carries the counts ``read``, ``changes``, ``unreadable`` and ``untimed`` as the observed metric
    ``balance``; the last three add up to the first.
    """
    tagged = tag_changes(log)
    counts = [F.count(F.lit(1)).alias("read")] + [F.count_if(F.col("outcome") == outcome).alias(name) for name, outcome in (
        ("changes", CHANGE), ("unreadable", UNREADABLE), ("untimed", UNTIMED))]
    return write_append(tagged.observe("balance", *counts), target, checkpoint, partition_by=["outcome", "table"], **options)


LANDED = f"value string, {', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in S.CHANGE_SCHEMA)}, outcome string"


def _landed(spark, target, stream, **options):
    reader = spark.readStream if stream else spark.read
    return reader.schema(LANDED).options(**options).parquet(target)


def landed_changes(spark, target, stream=False, **options):
    """Change rows as ``start_changes`` landed them; conditions on the table prune folders."""
    return split_changes(_landed(spark, target, stream, **options))[0]


def faulty_changes(spark, target, stream=False, **options):
    return split_changes(_landed(spark, target, stream, **options))[1]


def start_dimensions(changes, read_config, root, checkpoint, writer="main", order=("change_ts",),
                     config_order=("ts_ms",), trigger=None, tables=None, rejects=None):
    """Dimension tables, all written to ``root``.

    ``read_config`` returns the configuration events known so far; it is called at the start of
    every micro-batch, so the configuration is always read before the rows it routes. A ``ConfigLog`` does so by reading
    only the events that are new. With ``tables``, a folder, the configured catalog tables are created there as they appear
    (``publish_dimension`` fills them).

    With ``rejects``, a folder, no change row is lost without a trace: rows that reach no dimension table go there by ``outcome``
    (``unrouted``, ``no data``), and one row per micro-batch with the counts ``read``, ``routed``, ``unrouted`` and ``no_data`` to its folder
    ``balance``. The micro-batch is read once and kept in executor storage between its outputs.
    """
    def config_now():
        if isinstance(read_config, ConfigLog):
            return read_config()
        return current_config(read_config(), order=config_order)

    def write(batch, batch_id):
        config = config_now()
        for row in config_rows(config) if tables else ():
            ensure_table(batch.sparkSession, row, tables)
        if not rejects:
            routed = route_by_config(keep_types(batch), config).withColumn("change_ts", cdc.change_seconds())
            upsert_dimensions(routed, root, batch_id, writer, order)
            return
        tagged = tag_by_config(batch, config).withColumn("change_ts", cdc.change_seconds()).persist()
        try:
            counts = tagged.agg(F.count(F.lit(1)).alias("read"), *[
                F.count_if(F.col("outcome") == outcome).alias(outcome.replace(" ", "_")) for outcome in (ROUTED, UNROUTED, NO_DATA)])
            write_batch(counts, f"{rejects}/balance", batch_id, writer)
            routed = tagged.filter(F.col("outcome") == ROUTED)
            upsert_dimensions(routed.drop("outcome"), root, batch_id, writer, order)
            write_batch(tagged.filter(F.col("outcome") != ROUTED).drop("sink_table", "pk"), f"{rejects}/rows", batch_id, writer,
                        partition_by=["outcome"])
        finally:
            tagged.unpersist()

    return (changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _start_flow(flow, rows, dictionary, target, checkpoint, keys=None, writer="main", trigger=None, **options):
    """Write a joined flow. ``dictionary`` is a frame that ``rows`` were made with, or a function that returns one
    (``RefreshingLookup``): the join then carries codes, and each micro-batch gets its names from the dictionary in force when
    it is written, in a folder of its own under ``target`` (``write_batch``)."""
    if not callable(dictionary):
        return write_upsert(rows, target, keys, checkpoint, trigger=trigger, **options)

    def write(batch, batch_id):
        write_batch(flows.with_names(flow, batch, dictionary()), target, batch_id, writer, **options)

    return (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _fixed(dictionary):
    """The dictionary that a flow itself joins, if it is one frame for the life of the query."""
    return None if callable(dictionary) else dictionary


def start_order_wide(changes, dictionary, target, checkpoint, ttl=S.ORDER_JOIN_TTL, delay="0 seconds", **options):
    """The wide order table as a changelog; ``read_latest`` by id gives its current rows."""
    return _start_flow("order_wide", flows.order_wide(changes, _fixed(dictionary), ttl, delay), dictionary, target, checkpoint, ["id"],
                       **options)


def start_order_detail(wide, target, checkpoint, **options):
    """Placed lines; ``wide`` streams the changelog that ``start_order_wide`` writes."""
    return write_append(flows.order_detail(wide), target, checkpoint, **options)


def start_order_cancel(wide, target, checkpoint, **options):
    return write_append(flows.order_cancel(wide), target, checkpoint, **options)


def start_cart_add(changes, dictionary, target, checkpoint, writer="main", trigger=None, **options):
    """Additions to the cart. ``dictionary`` is a frame, fixed for the life of the query, or a function that returns
    one (``RefreshingLookup``): it is then asked, and measured, in every micro-batch, and a batch's rows go to a folder of
    their own under ``target`` (``write_batch``)."""
    if not callable(dictionary):
        return write_append(flows.cart_add(changes, dictionary), target, checkpoint, trigger=trigger, **options)

    def write(batch, batch_id):
        write_batch(flows.cart_add(batch, dictionary()), target, batch_id, writer, **options)

    return (changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_payment_success(changes, detail, dictionary, target, checkpoint, ttl=S.PAYMENT_JOIN_TTL,
                          delay="0 seconds", **options):
    """Paid lines; ``detail`` streams the output of ``start_order_detail``."""
    paid = flows.payment_success(changes, detail, _fixed(dictionary), ttl, delay)
    return _start_flow("payment_success", paid, dictionary, target, checkpoint, ["order_detail_id"], **options)


def start_order_refund(changes, dictionary, target, checkpoint, ttl=S.ORDER_JOIN_TTL, delay="0 seconds", **options):
    return _start_flow("order_refund", flows.order_refund(changes, _fixed(dictionary), ttl, delay), dictionary, target, checkpoint, **options)


def start_refund_success(changes, dictionary, target, checkpoint, ttl=S.ORDER_JOIN_TTL, delay="0 seconds",
                         types=None, **options):
    paid = flows.refund_success(changes, _fixed(dictionary), ttl, delay, types)
    return _start_flow("refund_success", paid, dictionary, target, checkpoint, **options)


#: Keys that dirty records are dealt to on their way past the visitors' state.
DIRTY_KEYS = 1024


def stream_log_records(log, order="arrival", tz="UTC"):
    """All log records, parsed, with the column ``usable``; the usable ones with the repaired flag. The log is read once: dirty
    records pass beside the visitors' state. The text passes the state, and is parsed again after it: cheaper
    than carrying variants through Python workers."""
    marked = parse_log(log).withColumn("usable", is_usable())
    spread = F.pmod(F.xxhash64("value", order), F.lit(DIRTY_KEYS)).cast("string")
    slim = marked.withColumn("mid", F.when(F.col("usable"), F.col("mid")).otherwise(spread)).select(
        "mid", "is_new", "ts", order, "value", "usable")
    repaired = visitors.repair_new_flag(slim, order=order, tz=tz, usable="usable")
    again = parse_log(repaired.select("value", order, "usable", F.col("is_new").alias("_flag")))
    return write_flag(again.drop("is_new").withColumnRenamed("_flag", "is_new"))


def log_outputs(log, order="arrival", tz="UTC"):
    """Rows ``(order, mid, target, value)`` of the five log outputs and, as ``dirty``, of the records that have none, in one pass.

    As ``observe`` metric ``balance``, a micro-batch's progress carries how many records were ``read``, ``usable`` and ``dirty``.
    """
    records = stream_log_records(log, order, tz).observe(
        "balance", F.count(F.lit(1)).alias("read"), F.count_if("usable").alias("usable"), F.count_if(~F.col("usable")).alias("dirty"))
    return route_log(records, [order, "mid"], usable="usable")


def as_topics(outputs):
    """The outputs as messages to topics of their names, keyed by visitor, so that a visitor's records keep their order.
    A topic has no place for a dirty record without text."""
    return outputs.filter(F.col("value").isNotNull()).select(
        F.col("target").alias("topic"), F.col("mid").alias("key"), "value")


def start_log_split(log, target, checkpoint, order="arrival", tz="UTC", fmt="parquet", **options):
    """The five log outputs and the dirty records, in one query, as folders ``target=<name>`` (``fmt="kafka"``: as
    topics named after them). ``order`` travels along for the jobs that read the pages."""
    outputs = log_outputs(log, order, tz)
    if fmt == "kafka":
        return (as_topics(outputs).writeStream.format("kafka").options(**options)
                .option("checkpointLocation", checkpoint).start())
    return write_append(outputs.drop("mid"), target, checkpoint, fmt=fmt, partition_by=["target"], **options)


def start_log_dirty(log, target, checkpoint, **options):
    """The dirty records of a log. The visitor jobs read pages, which ``start_log_split`` has cleaned; over another
    source this job keeps what they leave out."""
    return write_append(split_dirty(parse_log(log))[1], target, checkpoint, **options)


def start_unique_visitor(pages, target, checkpoint, order="arrival", tz="UTC", ttl=visitors.DAY_TTL, **options):
    good, _ = split_dirty(parse_log(pages))
    rows = visitors.first_visit_per_day(good.select("value", "mid", "ts", "last_page_id", order), order=order, tz=tz, ttl=ttl)
    return write_append(rows.select("value", "mid", "ts"), target, checkpoint, idle=ttl is None, **options)


def start_waiting_join(left, right, on, target, checkpoint, keys, how="left", ttl=S.ORDER_JOIN_TTL, **options):
    """A join with retention in processing time as a changelog: ``read_latest`` by ``keys`` (the left rows') and ``revision``
    gives the current rows."""
    return write_upsert(waiting_join(left, right, on, how, ttl), target, keys, checkpoint, idle=False, **options)


def start_user_jump(pages, target, checkpoint, order="arrival", within=S.BOUNCE_WITHIN_MS, delay=S.BOUNCE_DELAY,
                    **options):
    good, _ = split_dirty(parse_log(pages))
    slim = good.select("value", "mid", "ts", "last_page_id", order)
    rows = visitors.detect_bounce(slim, order=order, within=within, delay=delay)
    return write_append(rows, target, checkpoint, **options)
