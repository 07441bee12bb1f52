from pyspark.sql import functions as F

from millrace.functions import cdc
from millrace.functions import records as R
from millrace.functions.times import event_day, event_time_text, to_epoch_ms

CHANGE = "`table` string, type string, data map<string,string>, old map<string,string>, ts string"


def changes(spark, *rows):
    return spark.createDataFrame([("t", *r, "1592270938") for r in rows], CHANGE)


def test_status_changed(spark):
    df = changes(spark,
                 ("update", {"order_status": "1003"}, {"order_status": "1001"}),
                 ("update", {"order_status": "1003"}, {"other": "x"}),
                 ("update", {"order_status": "1003"}, None),
                 ("update", {"order_status": "1003"}, {"order_status": None}),
                 ("update", {"order_status": "1005"}, {"order_status": "1001"}),
                 ("insert", {"order_status": "1003"}, {"order_status": "1001"}))
    assert df.filter(cdc.status_changed("order_status", "1003")).count() == 1


def test_increase(spark):
    df = changes(spark,
                 ("insert", {"sku_num": "3"}, None), ("update", {"sku_num": "5"}, {"sku_num": "2"}),
                 ("update", {"sku_num": "2"}, {"sku_num": "5"}), ("update", {"sku_num": "5"}, {"other": "1"}),
                 ("update", {"sku_num": "5"}, {"sku_num": "x"}), ("update", {"sku_num": "5"}, {"sku_num": "5"}),
                 ("delete", {"sku_num": "5"}, None), ("insert", {}, None))
    got = [r[0] for r in df.filter(cdc.is_increase("sku_num")).select(cdc.increase("sku_num")).collect()]
    assert got == ["3", "3", None]


def test_line_amount(spark):
    df = spark.createDataFrame([("2", "1999.00"), ("x", "1.00"), (None, "1.00"), ("3", "0.333")], "q string, p string")
    got = [r[0] for r in df.select(cdc.line_amount(F.col("q"), F.col("p"))).collect()]
    assert got == ["3998.0000", None, None, "0.9900"]


def test_date_id(spark):
    texts = ["2020-06-14 09:28:57", "2020-06-14", "zzz", "", None, "10:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(cdc.date_id(F.col("t"))).collect()]
    assert got == ["2020-06-14", "2020-06-14", None, None, None, None]


def test_keep_columns(spark):
    df = spark.createDataFrame([({"id": "1", "tm_name": "a", "url": "u"},)], "data map<string,string>")
    for names, left in [("id,tm_name", {"id": "1", "tm_name": "a"}), ("id, tm_name", {"id": "1"}), ("x", {})]:
        assert df.select(cdc.keep_columns(F.col("data"), F.lit(names))).first()[0] == left


def test_times(spark):
    df = spark.createDataFrame([(1592270938123,), (0,), (-1,)], "ts bigint")
    ts = F.col("ts")
    for zone in ("UTC", "America/New_York"):        # the session zone must not matter
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            rows = df.select(event_day(ts), event_day(ts, "+08:00"), event_time_text(ts),
                             event_time_text(ts, "Asia/Shanghai"),
                             to_epoch_ms(event_time_text(ts, "+08:00"), "+08:00"), to_epoch_ms(event_day(ts))).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert tuple(rows[0]) == ("2020-06-16", "2020-06-16", "2020-06-16 01:28:58", "2020-06-16 09:28:58",
                                  1592270938000, 1592265600000)
        assert tuple(rows[1])[:4] == ("1970-01-01", "1970-01-01", "1970-01-01 00:00:00", "1970-01-01 08:00:00")
        assert tuple(rows[2])[:3] == ("1969-12-31", "1970-01-01", "1969-12-31 23:59:59")


def test_hour_missing_in_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ms, text = df.select(to_epoch_ms(F.col("t")), event_time_text(to_epoch_ms(F.col("t")))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (ms, text) == (1710037800000, "2024-03-10 02:30:00")


def test_records(spark):
    df = spark.createDataFrame([('{"a":{"b":1.50,"c":null},"d":[1,"x"],"n":null}',)], "value string")
    rec = R.parse_record(F.col("value"))
    got = df.select(
        R.serialise(R.put(rec, a=F.lit("t"), z=F.lit(5))), R.serialise(R.remove(rec, "d", "missing")),
        R.get_text(rec["a"]), R.get_text(rec["n"]), R.get_long(rec["a"], "$.b"),
        F.size(R.get_items(rec["d"])), R.get_items(rec["a"])).first()
    assert tuple(got) == ('{"d":[1,"x"],"a":"t","z":5}', '{"a":{"b":1.5,"c":null}}', '{"b":1.5,"c":null}', None, 1, 2, None)


def test_extreme_values_raise_nothing(spark):
    from millrace.functions import cdc, times
    from millrace.operators.quality import parse_log, split_dirty
    from millrace.operators.selection import with_event_time

    top, low = 2 ** 63 - 1, -2 ** 63
    texts = [(f'{{"common":{{"mid":"1"}},"ts":{t}}}',) for t in (1592270938000, 1592270938000000000, low, top)]
    good, dirty = split_dirty(parse_log(spark.createDataFrame(texts, "value string")))
    assert good.count() == 1 and dirty.count() == 3
    stamps = spark.createDataFrame([(t,) for t in (0, top, low)], "t long")
    days = stamps.select(times.event_day(F.col("t")).alias("d"), times.event_time_text(F.col("t")).alias("x")).collect()
    assert [tuple(r) for r in days] == [("1970-01-01", "1970-01-01 00:00:00"), (None, None), (None, None)]
    change = "type string, data map<string,string>, old map<string,string>, ts string"
    rows = spark.createDataFrame([("update", {"n": "2147483647"}, {"n": "-5"}, str(top))], change)
    assert rows.select(cdc.increase("n").alias("g")).first().g == "2147483652"
    assert with_event_time(rows).first().event_time is None
