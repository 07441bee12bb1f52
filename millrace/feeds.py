"""Behaviour log and change log derived from the test tables.

Test inputs only: the library never imports this module. Every feed is a lazy Spark plan over whole
tables. Change-log branches carry literal table names, so a filter on the table drops the others.
"""

from functools import reduce

from pyspark.sql import functions as F

from millrace.functions.times import EPOCH, ntz_millis

DATABASE = "shop"

# The dictionary of the test inputs. Codes A, 4-NOT SPECIFIED and 5-LOW are left out.
DICTIONARY = [
    ("R", "Returned"), ("N", "None"), ("O", "Open"), ("F", "Filled"),
    ("1-URGENT", "Urgent"), ("2-HIGH", "High"), ("3-MEDIUM", "Medium"),
]

# The dimension configuration of the test inputs (op, source, sink, columns, pk, ts_ms).
CONFIG_EVENTS = [
    ("r", "customer", "dim_customer", "id,c_name", "id", 1),
    ("r", "part", "dim_part", "id,p_name", "id", 1),
    ("c", "nation", "dim_nation", "id,n_name", "id", 2),
    ("u", "part", "dim_part", "id,p_name,p_brand", None, 3),
    ("d", "nation", "dim_nation", "id,n_name", "id", 4),
]


def table(spark, sf_dir, name, key=None, stream=False):
    """A test table. One of fewer files than cores is spread by ``key``, so that the derivations
    run on all cores as they would on a table of many files. With ``stream``, a stream of its files."""
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    if stream:
        # As a pattern, for a stream takes a single file only that way.
        return spark.readStream.schema(df.schema).parquet(f"{sf_dir}/{name}[.]parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, key) if key and len(df.inputFiles()) < cores else df


def dictionary(spark):
    rows = ", ".join(f"('{code}', '{name}')" for code, name in DICTIONARY)
    return spark.sql(f"select * from values {rows} as t(dic_code, dic_name)")


def config_changes(spark):
    rows = []
    for op, source, sink, columns, pk, ts_ms in CONFIG_EVENTS:
        row = (source, sink, columns, pk, None)
        rows.append((op, row if op == "d" else None, None if op == "d" else row, ts_ms))
    config = "struct<source_table:string,sink_table:string,sink_columns:string,sink_pk:string,sink_extend:string>"
    return spark.createDataFrame(rows, f"op string, before {config}, after {config}, ts_ms bigint")


def config_changes_from_events(spark, sf_dir):
    """A large configuration log: each event puts, renames or deletes the entry of its user."""
    e = table(spark, sf_dir, "events", "event_id")
    source = F.concat(F.lit("t"), F.col("user_id").cast("string"))

    def row(sink):
        return F.struct(source.alias("source_table"), sink.alias("sink_table"), F.lit("id,name").alias("sink_columns"),
                        F.lit("id").alias("sink_pk"), F.col("event_type").alias("sink_extend"))

    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    entry = row(F.concat(F.lit("dim_"), F.col("event_id").cast("string")))
    return e.select(op.alias("op"), F.when(op != "c", entry).alias("before"),
                    F.when(op != "d", entry).alias("after"), ntz_millis(F.col("ts")).alias("ts_ms"), "event_id")


def _log_struct(split):
    signup = F.col("event_type") == "signup"
    page = F.struct(F.col("event_type").alias("page_id"),
                    F.when(~F.col("event_type").isin("view", "signup"), F.lit("home")).alias("last_page_id"))
    members = [
        F.struct(F.col("user_id").cast("string").alias("mid"),
                 F.when(signup, "1").otherwise("0").alias("is_new")).alias("common"),
        F.when(~signup, page).alias("page") if split else page.alias("page"),
        F.col("ts_ms").alias("ts"),
    ]
    if split:
        shown = (F.get_json_object("props", "$.k").cast("bigint") % 3).cast("int")
        one = F.struct(F.col("event_type").alias("item"))
        members += [
            F.when(signup, F.struct(F.lit("icon").alias("entry"))).alias("start"),
            F.array_repeat(one, shown).alias("displays"),
            F.when(F.col("event_type") == "click",
                   F.array(F.struct(F.lit("tap").alias("action_id"), F.col("ts_ms").alias("ts")))).alias("actions"),
            F.when(F.col("event_type") == "error", F.struct(F.lit("500").alias("error_code"))).alias("err"),
        ]
    return F.struct(*members)


def _events(spark, sf_dir, stream=False):
    return table(spark, sf_dir, "events", "event_id", stream).withColumn("ts_ms", ntz_millis(F.col("ts")))


def log_text(spark, sf_dir, dirt=False, stream=False):
    """Behaviour log as JSON text with arrival order; with ``dirt`` some texts are broken."""
    text = F.to_json(_log_struct(split=True))
    if dirt:
        text = F.when(F.col("event_id") % 97 == 0, F.lit("{bad")).otherwise(text)
    return _events(spark, sf_dir, stream).select(text.alias("value"), F.col("event_id").alias("arrival"))


def page_text(spark, sf_dir, stream=False):
    """Page records as JSON text, one per event."""
    return _events(spark, sf_dir, stream).select(
        F.to_json(_log_struct(split=False)).alias("value"), F.col("event_id").alias("arrival"))


def page_rows(spark, sf_dir):
    """The same page records, already parsed into columns."""
    record = _events(spark, sf_dir).select(_log_struct(split=False).alias("r"), F.col("event_id").alias("arrival"))
    return record.select("r.common.mid", "r.common.is_new", "r.page.page_id", "r.page.last_page_id", "r.ts", "arrival")


def _money(name):
    return f"cast({name} as decimal(16,2))"


def _clock(seconds):
    return f"timestampadd(SECOND, {seconds}, {EPOCH})"


def _branch(df, name, kind, ts, data, old=None, where=None):
    """Change rows of one table and type; ``data`` and ``old`` map members to SQL expressions."""
    rows = df.filter(where) if where else df
    return rows.selectExpr(*(f"{value} as {column}" for column, value in _change(name, kind, ts, data, old).items()))


def _change(name, kind, ts, data, old=None):
    """The columns of a change row as SQL expressions."""
    def as_map(members):
        if not members:
            return "cast(null as map<string,string>)"
        return "map(" + ", ".join(f"'{k}', cast({v} as string)" for k, v in members.items()) + ")"

    return {"database": f"'{DATABASE}'", "table": f"'{name}'", "type": f"'{kind}'", "data": as_map(data), "old": as_map(old),
            "ts": f"cast({ts} as string)"}


def _branches_at_once(df, branches):
    """Change rows of several tables and types in one pass over ``df``."""
    def change(df, name, kind, ts, data, old=None, where=None):
        row = ", ".join(f"'{column}', {value}" for column, value in _change(name, kind, ts, data, old).items())
        return f"if({where or 'true'}, named_struct({row}), null)"

    rows = df.selectExpr("explode(array(" + ", ".join(change(*b) for b in branches) + ")) as change")
    return rows.filter("change is not null").select("change.*")


def change_log(spark, sf_dir, stream=False, whole=False):
    """The shop's change log: orders, order lines, carts, payments and refunds.

    As a stream, lines take their order's columns from the orders table at rest. ``whole`` is for readers of all tables:
    the same rows, but each order and each dated line is read once and makes all its change rows, instead of once a table."""
    t0 = ntz_millis(F.col("o_orderdate")) / 1000
    at_rest = table(spark, sf_dir, "orders").withColumn("t0", t0.cast("bigint"))
    orders = table(spark, sf_dir, "orders", stream=True).withColumn("t0", t0.cast("bigint")) if stream else at_rest
    items = table(spark, sf_dir, "lineitem", "l_orderkey", stream)
    both = items.join(at_rest, F.col("l_orderkey") == F.col("o_orderkey"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    # Behind the joins, whose exchanges would carry the text of a line's name beside the numbers that it is made of.
    dated, lines = (df.selectExpr(
        "*", "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as line", "cast(l_quantity as int) as quantity")
        for df in (both, both.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")))

    def order(status, operated):
        return {"id": "o_orderkey", "user_id": "o_custkey", "province_id": "o_custkey % 34 + 1",
                "order_status": status, "operate_time": operated}

    def payment(status):
        return {"order_id": "o_orderkey", "user_id": "o_custkey", "payment_type": "o_orderpriority",
                "payment_status": status, "callback_time": _clock("t0 + o_orderkey % 1800")}

    hour_later = _clock("t0 + 3600")
    request = {"id": "line", "order_id": "l_orderkey", "sku_id": "l_partkey", "user_id": "o_custkey",
               "refund_type": "l_linestatus", "refund_reason_type": "l_returnflag", "refund_num": "quantity",
               "refund_amount": _money("l_extendedprice"), "refund_reason_txt": "null", "create_time": hour_later}
    cart = {"id": "line", "user_id": "o_custkey", "sku_id": "l_partkey", "source_id": "l_suppkey",
            "source_type": "l_returnflag", "sku_num": "quantity"}
    discount = "cast(round(l_discount * 100) as int)"
    returned = "o_orderstatus = 'P' and l_returnflag = 'R'"
    settled = "o_orderstatus in ('F', 'P')"

    branches = [
        (lines, "order_detail", "insert", "t0", {
            "id": "line", "order_id": "l_orderkey", "sku_id": "l_partkey", "sku_name": "p_name",
            "create_time": _clock("t0"), "source_id": "l_suppkey", "source_type": "l_returnflag", "sku_num": "quantity",
            "order_price": _money("p_retailprice"), "split_total_amount": _money("l_extendedprice"),
            "split_activity_amount": "null", "split_coupon_amount": "null"}),
        (orders, "order_info", "insert", "t0 + o_orderkey % 10", order("1001", "null")),
        (orders, "order_info", "update", "t0 + 3600",
                order("if(o_orderstatus = 'F', '1003', '1005')", hour_later), {"order_status": "1001"}, settled),
        (orders, "order_info", "update", "t0 + 7200", order("1006", hour_later), {"order_status": "1005"},
                "o_orderstatus = 'P' and o_orderkey % 2 = 0"),
        (dated, "order_detail_activity", "insert", "t0",
         {"order_detail_id": "line", "activity_id": discount, "activity_rule_id": discount}, None, "l_discount >= 0.05"),
        (dated, "order_detail_coupon", "insert", "t0", {"order_detail_id": "line", "coupon_id": "l_linenumber"}, None,
         "l_tax >= 0.06"),
        (orders, "payment_info", "update", "t0 + o_orderkey % 1800", payment("1602"),
                {"payment_status": "1601"}, settled),
        (orders, "payment_info", "insert", "t0", payment("1601"), None, "o_orderstatus = 'O'"),
        (dated, "order_refund_info", "insert", "t0 + 3600", request, None, returned),
        (dated, "order_refund_info", "update", "t0 + 3601", request, {"refund_num": "0"},
                f"{returned} and l_linenumber = 1"),
        (dated, "refund_payment", "update", "t0 + 7200",
                {"id": "line", "order_id": "l_orderkey", "sku_id": "l_partkey", "payment_type": "o_orderpriority",
                 "total_amount": _money("l_extendedprice"), "refund_status": "'0702'",
                 "callback_time": _clock("t0 + 7200")}, {"refund_status": "'0701'"}, f"{returned} and l_orderkey % 2 = 0"),
        (dated, "cart_info", "insert", "t0", cart, None, "l_linenumber = 1"),
        (dated, "cart_info", "update", "t0", cart, {"sku_num": "l_linenumber"}, "l_linenumber > 1"),
    ]
    if whole:
        # Lines come with their part, whose key may repeat: the other tables take theirs without. The most rows come first, so
        # that no long task is left to the end.
        made = [_branches_at_once(df, [b for b in branches if b[0] is df]) for df in (dated, orders, lines)]
    else:
        made = [_branch(*b) for b in branches]
    return reduce(lambda a, b: a.union(b), made)


def master_changes(spark, sf_dir):
    """Change log of customers, parts and suppliers: initial rows, renames and deletes."""
    customers, parts, suppliers = (table(spark, sf_dir, n) for n in ("customer", "part", "supplier"))
    customer = {"id": "c_custkey", "c_name": "c_name", "c_mktsegment": "c_mktsegment"}
    moved = {**customer, "c_name": "concat(c_name, ' (moved)')"}
    part = {"id": "p_partkey", "p_name": "p_name", "p_brand": "p_brand"}
    branches = [
        _branch(customers, "customer", "bootstrap-insert", "100", customer),
        _branch(customers, "customer", "update", "200", moved, {"c_name": "c_name"}, "c_mktsegment = 'BUILDING'"),
        _branch(customers, "customer", "delete", "300", customer, where="c_mktsegment = 'FURNITURE'"),
        _branch(parts, "part", "insert", "100", part),
        _branch(parts, "part", "update", "99", {**part, "p_brand": "'stale'"}, where="p_size > 25"),
        _branch(suppliers, "supplier", "insert", "100", {"id": "s_suppkey", "s_name": "s_name"}),
    ]
    return reduce(lambda a, b: a.union(b), branches)


def as_text(changes, keep=()):
    """Change rows as the JSON text a topic would carry, beside the columns ``keep``."""
    whole = F.struct(*[F.col(c) for c in ("database", "table", "type", "data", "old", "ts")])
    return changes.select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("value"), *keep)
