"""Streams give what the batch forms give: one file per micro-batch, run to the end, then resumed."""

import json

import pytest
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.operators.joins import retained_join
from millrace.operators.visitors import detect_bounce
from millrace.sinks.writers import write_append
from millrace.streaming import jobs, visitors

FAR = 10_000_000_000
T0 = 1_000_000      # not zero: a stream starts with its watermark at the epoch


def page(mid, ts, last=None, page_id="home", flag="0"):
    return json.dumps({"common": {"mid": mid, "is_new": flag, "os": "x"},
                       "page": {"page_id": page_id, "last_page_id": last}, "ts": ts})


class Feed:
    """A folder of parquet files that a stream reads one per micro-batch, in the order written."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, str(path), schema, 0

    def add(self, *rows):
        import os
        import time

        df = self.spark.createDataFrame(list(rows), self.schema)
        df.coalesce(1).write.mode("append").parquet(self.path)
        newest = max((os.path.join(self.path, f) for f in os.listdir(self.path) if f.endswith(".parquet")),
                     key=os.path.getctime)
        self.n += 1
        stamp = time.time() - 100_000 + self.n
        os.utime(newest, (stamp, stamp))

    def stream(self):
        return (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
                .parquet(self.path))


def finish(query):
    assert query.awaitTermination(180)


LOG = "value string, arrival bigint"


def log_rows(*records):
    return [(text, n) for n, text in records]


def bounce_stream(spark, tmp_path, batches, **options):
    feed = Feed(spark, tmp_path / "in", LOG)
    n = 0
    for batch in batches:
        rows = []
        for text in batch:
            rows.append((text, n))
            n += 1
        feed.add(*rows)
    finish(jobs.start_user_jump(feed.stream(), str(tmp_path / "out"), str(tmp_path / "ck"), **options))
    out = spark.read.parquet(str(tmp_path / "out"))
    return sorted((r.mid, r.ts) for r in out.collect() if r.mid != "end")


def test_bounce_example(spark, tmp_path):
    got = bounce_stream(spark, tmp_path, [
        [page("101", T0 + 10000), page("102", T0 + 12000)],
        [page("102", T0 + 15000, "home", "good_list"), page("102", T0 + 30000, "detail", "good_list")],
        [page("end", FAR)]])
    assert got == [("101", T0 + 10000)]


def test_bounce_out_of_order(spark, tmp_path):
    got = bounce_stream(spark, tmp_path, [
        [page("1", T0 + 0)], [page("1", T0 + 3000)], [page("1", T0 + 2000, "home")], [page("end", FAR)]])
    assert got == [("1", T0 + 3000)]


def test_bounce_two_starts_and_boundary(spark, tmp_path):
    got = bounce_stream(spark, tmp_path, [
        [page("a", T0 + 0), page("b", T0 + 0), page("c", T0 + 0)], [page("a", T0 + 3000)],
        [page("b", T0 + 9999, "home"), page("c", T0 + 10000, "home")], [page("end", FAR)]])
    assert got == [("a", T0 + 0), ("a", T0 + 3000), ("c", T0 + 0)]


def test_late_record_is_dropped(spark, tmp_path):
    # The second batch moves the watermark far past 5000; the start it would have joined has left.
    got = bounce_stream(spark, tmp_path, [
        [page("a", T0 + 0)], [page("b", T0 + 100_000)], [page("b", T0 + 100_001)], [page("a", T0 + 5000, "home")], [page("end", FAR)]])
    assert got == [("a", T0 + 0), ("b", T0 + 100_000), ("b", T0 + 100_001)]


def test_bounce_resumes(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", LOG)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    feed.add((page("a", T0 + 0), 0), (page("b", T0 + 1000), 1))
    finish(jobs.start_user_jump(feed.stream(), out, ck))
    feed.add((page("a", T0 + 4000, "home"), 2))
    feed.add((page("end", FAR), 3))
    finish(jobs.start_user_jump(feed.stream(), out, ck))
    got = [(r.mid, r.ts) for r in spark.read.parquet(out).collect()]
    assert got == [("b", T0 + 1000)]


def test_bounce_stream_equals_batch(spark, tmp_path):
    import random
    rnd = random.Random(3)
    records = [(str(rnd.randrange(6)), T0 + i * 700 + rnd.randrange(600), rnd.choice([None, "home"])) for i in range(240)]
    late = records[:]
    for i in range(0, len(late) - 1, 5):      # neighbours swapped: less than two seconds out of order
        late[i], late[i + 1] = late[i + 1], late[i]
    texts = [page(m, t, l) for m, t, l in late]
    got = bounce_stream(spark, tmp_path, [texts[i:i + 60] for i in range(0, 240, 60)] + [[page("end", FAR)]])
    rows = spark.createDataFrame([(m, t, l, i) for i, (m, t, l) in enumerate(records)],
                                 "mid string, ts bigint, last_page_id string, arrival bigint")
    assert got == sorted((r.mid, r.ts) for r in detect_bounce(rows).collect())


def test_log_split_and_flag(spark, tmp_path):
    day = 86_400_000
    feed = Feed(spark, tmp_path / "in", LOG)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    feed.add((page("1", 1000, flag="1"), 0), ("{bad", 1), (page("2", 1000, flag="0"), 2), (page("2", 2000, flag="1"), 3))
    feed.add((page("1", 5000, flag="1"), 4), (page("1", day + 5, flag="1"), 5))
    finish(jobs.start_log_split(feed.stream(), out, ck))
    feed.add((page("1", 2 * day, flag="1"), 6), (page("3", day, flag="1"), 7))
    finish(jobs.start_log_split(feed.stream(), out, ck))
    pages = spark.read.parquet(out).filter("target = 'page'")
    got = [(r.arrival, json.loads(r.value)["common"]) for r in pages.orderBy("arrival").collect()]
    assert [(a, c["is_new"]) for a, c in got] == [
        (0, "1"), (2, "0"), (3, "0"), (4, "1"), (5, "0"), (6, "0"), (7, "1")]
    assert all(c["os"] == "x" for _, c in got)


def test_flag_first_record_is_lowest_arrival(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", LOG)
    feed.add((page("1", 86_400_000 + 1, flag="1"), 1), (page("1", 1, flag="1"), 0))
    finish(jobs.start_log_split(feed.stream(), str(tmp_path / "out"), str(tmp_path / "ck")))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("arrival").collect()
    assert [json.loads(r.value)["common"]["is_new"] for r in got] == ["1", "0"]


def test_flag_of_a_visitor_larger_than_an_arrow_batch(spark, tmp_path):
    import random
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    day = 86_400_000
    rows = [(page("1", n * day // 4, flag="1"), n) for n in range(40)] + [(page("2", day, flag="1"), 99)]
    random.Random(1).shuffle(rows)
    feed = Feed(spark, tmp_path / "in", LOG)
    feed.add(*rows)
    old = spark.conf.get(limit)
    spark.conf.set(limit, "7")
    try:
        finish(jobs.start_log_split(feed.stream(), str(tmp_path / "out"), str(tmp_path / "ck")))
    finally:
        spark.conf.set(limit, old)
    got = {r.arrival: json.loads(r.value)["common"]["is_new"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {**{n: "1" if n < 4 else "0" for n in range(40)}, 99: "1"}


def test_unique_visitor(spark, tmp_path):
    day = 86_400_000
    feed = Feed(spark, tmp_path / "in", LOG)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    feed.add((page("1", 1000), 0), (page("1", 2000), 1), (page("2", 2000, "home"), 2))
    finish(jobs.start_unique_visitor(feed.stream(), out, ck))
    feed.add((page("1", 3000), 3), (page("1", day + 1), 4), (page("2", day + 2), 5))
    finish(jobs.start_unique_visitor(feed.stream(), out, ck))
    got = sorted((r.mid, r.ts // day) for r in spark.read.parquet(out).collect())
    assert got == [("1", 0), ("1", 1), ("2", 1)]


def test_unique_visitor_with_a_clock_ahead(spark, tmp_path):
    day = 86_400_000
    feed = Feed(spark, tmp_path / "in", LOG)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    feed.add((page("a", 1000), 0))
    feed.add((page("bad", 4 * day), 1))
    feed.add((page("b", 2000), 2), (page("b", 1500), 3))
    finish(jobs.start_unique_visitor(feed.stream(), out, ck))
    feed.add((page("c", 3000), 4), (page("bad", 5000), 5))
    feed.add((page("bad", 4 * day + 1), 6), (page("a", 1001), 7))
    finish(jobs.start_unique_visitor(feed.stream(), out, ck))
    got = sorted((r.mid, r.ts) for r in spark.read.parquet(out).collect())
    # Each file is a micro-batch: the clock that runs ahead returns to its first day after another.
    assert got == [("a", 1000), ("b", 1500), ("bad", 5000), ("bad", 4 * day), ("bad", 4 * day + 1), ("c", 3000)]


def test_log_split_leaves_no_record_out(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", LOG)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    dirty = [("{bad", 1), (None, 2), (json.dumps({"ts": 5}), 3), (page("1", 1 << 62), 4)]
    feed.add((page("1", 1000), 0), *dirty[:2])
    feed.add(*dirty[2:], (page("2", 1000), 5))
    finish(jobs.start_log_split(feed.stream(), out, ck))
    rows = spark.read.parquet(out).collect()
    assert sorted((r.arrival, r.value) for r in rows if r.target == "dirty") == sorted((n, t) for t, n in dirty)
    assert sorted(r.arrival for r in rows if r.target == "page") == [0, 5]


def test_topics_are_keyed_by_visitor(spark):
    from millrace.sources.topics import as_log

    rows = spark.createDataFrame([("m", "page", "{}", 1), (None, "dirty", None, 2)],
                                 "mid string, target string, value string, arrival bigint")
    assert [tuple(r) for r in jobs.as_topics(rows).collect()] == [("page", "m", "{}")]
    taken = spark.createDataFrame([(bytearray(b"{}"), 7, 1)], "value binary, offset bigint, partition int")
    assert [tuple(r) for r in as_log(taken, "kafka").collect()] == [("{}", 7)]


def test_cart_add_sees_a_code_added_between_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", CHANGE)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    names = [("a", "A")]

    def dictionary():
        return spark.createDataFrame(names, "dic_code string, dic_name string")

    def add(n, code):
        feed.add(change("cart_info", "insert", 10 + n, {"id": str(n), "sku_num": "1", "source_type": code}))

    add(1, "a")
    finish(jobs.start_cart_add(feed.stream(), dictionary, out, ck))
    names.append(("b", "B"))
    add(2, "b")
    finish(jobs.start_cart_add(feed.stream(), dictionary, out, ck))
    got = sorted((r.id, r.source_type_name) for r in spark.read.parquet(out).collect())
    assert got == [("1", "A"), ("2", "B")]


def test_streamed_flows_prune_to_their_tables(spark, tmp_path):
    from millrace.plans import flows

    folder = str(tmp_path / "landed")
    rows = spark.createDataFrame([change("order_info", "insert", 1, {"id": "1"})], CHANGE)
    rows.write.partitionBy("table").parquet(folder)
    stream = spark.readStream.schema(rows.schema).parquet(folder)
    wide = flows.order_wide(stream, spark.createDataFrame(DIC, "dic_code string, dic_name string"), 900)
    plan = wide._jdf.queryExecution().analyzed().toString().splitlines()
    marks = [i for i, text in enumerate(plan) if "EventTimeWatermark" in text]
    assert len(marks) >= 4
    # The choice of tables stands below every watermark, next to the source.
    for at in marks:
        below = plan[at + 1:at + 4]
        assert any("Filter table#" in text and " IN (" in text and "order_detail_coupon" in text for text in below)


CHANGE = "table string, type string, data map<string,string>, old map<string,string>, ts string"
DIC = [("2401", "search"), ("1101", "card")]


def change(table, kind, ts, data, old=None):
    return (table, kind, data, old, str(ts))


def line(n, order, ts):
    return change("order_detail", "insert", ts, {
        "id": f"l{n}", "order_id": order, "sku_id": "7", "sku_name": "pen", "create_time": "2020-06-14 09:28:57",
        "source_id": None, "source_type": "2401", "sku_num": "2", "order_price": "1999.00",
        "split_total_amount": "3998.00", "split_activity_amount": None, "split_coupon_amount": None})


def info(order, ts, kind="insert", status="1001", old=None):
    return change("order_info", kind, ts, {"id": order, "user_id": "u", "province_id": "3", "operate_time": None,
                                           "order_status": status}, old)


def order_feed(spark, path):
    feed = Feed(spark, path, CHANGE)
    feed.add(line(1, "o1", 100), line(2, "o1", 100), info("o1", 101),
             change("order_detail_activity", "insert", 100,
                    {"order_detail_id": "l1", "activity_id": "a", "activity_rule_id": "r"}))
    feed.add(change("order_detail_coupon", "insert", 102, {"order_detail_id": "l2", "coupon_id": "c"}),
             line(3, "o2", 103))
    feed.add(info("o2", 104), info("o2", 106, "update", "1003", {"order_status": "1001"}),
             info("o1", 900, "update", "1003", {"order_status": "1001"}))     # too late for ttl
    feed.add(line(9, "o9", FAR // 1000), info("o9", FAR // 1000))
    feed.add(line(10, "o10", FAR // 1000 + 1000))
    return feed


def test_order_wide_chain(spark, tmp_path):
    dictionary = spark.createDataFrame(DIC, "dic_code string, dic_name string")
    feed = order_feed(spark, tmp_path / "in")
    wide_path, ck = str(tmp_path / "wide"), tmp_path / "ck"
    finish(jobs.start_order_wide(feed.stream(), dictionary, wide_path, str(ck / "wide")))
    wide = spark.read.parquet(wide_path)
    assert wide.columns == S.ORDER_WIDE_COLUMNS
    got = sorted((r.id, r.type, r.activity_id or "", r.coupon_id or "") for r in wide.collect() if r.id < "l4" and r.id != "l10")
    assert got == [("l1", "insert", "a", ""), ("l2", "insert", "", "c"),
                   ("l3", "insert", "", ""), ("l3", "update", "", "")]
    assert {r.split_original_amount for r in wide.collect()} == {"3998.0000"}

    stream = spark.readStream.schema(wide.schema).parquet(wide_path)
    finish(jobs.start_order_detail(stream, str(tmp_path / "detail"), str(ck / "detail")))
    finish(jobs.start_order_cancel(stream, str(tmp_path / "cancel"), str(ck / "cancel")))
    detail = spark.read.parquet(str(tmp_path / "detail"))
    assert detail.columns == S.ORDER_DETAIL_COLUMNS
    assert sorted(r.id for r in detail.filter("id < 'l4' and id <> 'l10'").collect()) == ["l1", "l2", "l3"]
    cancelled = spark.read.parquet(str(tmp_path / "cancel"))
    assert cancelled.columns == S.ORDER_CANCEL_COLUMNS
    assert [(r.id, r.ts) for r in cancelled.collect()] == [("l3", "106")]


def test_payment_success(spark, tmp_path):
    dictionary = spark.createDataFrame(DIC, "dic_code string, dic_name string")
    detail_rows = [tuple({"id": i, "order_id": o, "ts": t}.get(c) for c in S.ORDER_DETAIL_COLUMNS)
                   for i, o, t in [("l1", "o1", "100"), ("l2", "o1", "100"), ("l3", "o2", "100")]]
    detail = Feed(spark, tmp_path / "detail", S.detail_schema(S.ORDER_DETAIL_COLUMNS))
    detail.add(*detail_rows)

    def paid(order, ts, status="1602", kind="update", how="1101"):
        return change("payment_info", kind, ts, {"user_id": "u", "order_id": order, "payment_type": how,
                                                 "callback_time": "2020-06-14 09:28:57", "payment_status": status})
    feed = Feed(spark, tmp_path / "in", CHANGE)
    feed.add(paid("o1", 1005), paid("o1", 200, status="1601"), paid("o1", 200, kind="insert"), paid("o1", 200, how="x"))
    feed.add(paid("o2", 1006))       # one second beyond the retention
    finish(jobs.start_payment_success(feed.stream(), detail.stream(), dictionary, str(tmp_path / "out"), str(tmp_path / "ck")))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.columns == S.PAYMENT_COLUMNS
    assert sorted((r.order_detail_id, r.payment_type_name, r.ts) for r in out.collect()) == [
        ("l1", "card", "1005"), ("l2", "card", "1005")]


def test_cart_add_resumes(spark, tmp_path):
    dictionary = spark.createDataFrame(DIC, "dic_code string, dic_name string")

    def cart(kind, n, before=None, source="2401"):
        data = {"id": "c", "user_id": "u", "sku_id": "7", "source_id": None, "source_type": source, "sku_num": n}
        return change("cart_info", kind, 5, data, {"sku_num": before} if before else None)
    feed = Feed(spark, tmp_path / "in", CHANGE)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    feed.add(cart("insert", "3"), cart("update", "2", "5"))
    finish(jobs.start_cart_add(feed.stream(), dictionary, out, ck))
    feed.add(cart("update", "5", "2"), cart("insert", "1", source="unknown"))
    finish(jobs.start_cart_add(feed.stream(), dictionary, out, ck))
    got = spark.read.parquet(out)
    assert got.columns == S.CART_ADD_COLUMNS
    assert sorted((r.sku_num, r.source_type_name) for r in got.collect()) == [("3", "search"), ("3", "search")]


@pytest.mark.parametrize("flow", ["refund", "success"])
def test_refund_flows(spark, tmp_path, flow):
    dictionary = spark.createDataFrame(DIC + [("1501", "money"), ("1301", "broken")], "dic_code string, dic_name string")
    request = {"id": "r1", "user_id": "u", "order_id": "o1", "sku_id": "7", "refund_type": "1501", "refund_num": "1",
               "refund_amount": "9.00", "refund_reason_type": "1301", "refund_reason_txt": None,
               "create_time": "2020-06-14 09:28:57"}
    feed = Feed(spark, tmp_path / "in", CHANGE)
    feed.add(change("order_refund_info", "insert", 100, request),
             info("o1", 102, "update", "1005", {"order_status": "1001"}))
    feed.add(info("o1", 103, "update", "1006", {"order_status": "1005"}),
             change("refund_payment", "update", 104, {
                 "id": "p1", "order_id": "o1", "sku_id": "7", "payment_type": "1101", "total_amount": "9.00",
                 "callback_time": "2020-06-14 10:00:00", "refund_status": "0702"}))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    if flow == "refund":
        finish(jobs.start_order_refund(feed.stream(), dictionary, out, ck, delay="60 seconds"))
        rows = spark.read.parquet(out)
        assert rows.columns == S.ORDER_REFUND_COLUMNS
        assert [(r.id, r.province_id, r.refund_type_name, r.refund_reason_type_name, r.date_id)
                for r in rows.collect()] == [("r1", "3", "money", "broken", "2020-06-14")]
    else:
        finish(jobs.start_refund_success(feed.stream(), dictionary, out, ck, delay="60 seconds"))
        rows = spark.read.parquet(out)
        assert rows.columns == S.REFUND_SUCCESS_COLUMNS
        assert [(r.id, r.user_id, r.payment_type_name, r.refund_num, r.refund_amount)
                for r in rows.collect()] == [("p1", "u", "card", "1", "9.00")]


def test_stream_join_needs_ttl(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", CHANGE)
    feed.add(line(1, "o1", 100))
    left = feed.stream().select(F.col("data")["id"].alias("id"), "ts")
    right = feed.stream().select(F.col("data")["id"].alias("other"), F.col("ts").alias("other_ts"))
    with pytest.raises(ValueError):
        retained_join(left, right, [("id", "other")])


def test_stream_needs_checkpoint(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", CHANGE)
    feed.add(line(1, "o1", 100))
    with pytest.raises(ValueError):
        write_append(feed.stream(), str(tmp_path / "out"))
