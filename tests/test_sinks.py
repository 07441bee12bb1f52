import json
import shutil

import pytest
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.operators.logsplit import split_log
from millrace.operators.quality import parse_log
from millrace.operators.routing import current_config, route_by_config
from millrace.session import sized_for, streaming_session, work_folder
from millrace.sinks import dimensions as D
from millrace.sinks import writers as W
from millrace.sources.changes import read_changes, read_config_changes, read_config_snapshot, read_detail
from millrace.sources.lookup import RefreshingLookup, read_lookup
from millrace.sources.topics import read_log
from millrace.streaming import jobs
from tests.test_streaming import Feed, finish

CHANGE = "database string, `table` string, type string, data map<string,string>, old map<string,string>, ts string"
ENVELOPE = {"database": "shop", "table": "cart_info", "type": "update", "ts": 1592270938, "xid": 1,
            "data": {"id": 100924, "sku_name": "p", "price": 4488.5, "is_checked": None, "nest": {"a": 1}},
            "old": {"is_ordered": 0, "order_time": None}}


def test_read_changes(spark):
    texts = [json.dumps(ENVELOPE), "{bad", "", None, '"x"', '{"type":"insert"}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    (row,) = read_changes(df).collect()
    assert row.data == {"id": "100924", "sku_name": "p", "price": "4488.5", "is_checked": None, "nest": '{"a":1}'}
    assert row.old == {"is_ordered": "0", "order_time": None} and row.ts == "1592270938"
    assert read_changes(df, tables=["cart_info"]).count() == 1 and read_changes(df, tables=["x"]).count() == 0


def test_read_config(spark):
    row = {"source_table": "a", "sink_table": "b", "sink_columns": "id", "sink_pk": "id", "sink_extend": None}
    event = {"before": None, "after": row, "source": {"db": "x"}, "op": "r", "ts_ms": 5, "transaction": None}
    df = spark.createDataFrame([(json.dumps(event),), ("{bad",)], "value string")
    (got,) = read_config_changes(df).collect()
    assert got.op == "r" and got.before is None and got.after.asDict() == row and got.ts_ms == 5
    snapshot = read_config_snapshot(spark.createDataFrame([tuple(row.values())], S.CONFIG_ROW))
    assert current_config(read_config_changes(df).unionByName(snapshot)).count() == 1


def test_read_detail_and_log(spark, tmp_path):
    text = json.dumps({"id": "1", "ts": "5", "row_op_ts": "2024-01-01T00:00:00.000Z"})
    spark.createDataFrame([(text,)], "value string").write.text(str(tmp_path / "t"))
    df = read_log(spark, "text", streaming=False, path=str(tmp_path / "t"))
    detail = read_detail(df, S.ORDER_DETAIL_COLUMNS)
    assert detail.columns == S.ORDER_DETAIL_COLUMNS and detail.first().id == "1"
    stream = read_log(spark, "text", path=str(tmp_path / "t"))
    assert stream.isStreaming and stream.columns == ["value"]


@pytest.mark.parametrize("fmt", ["text", "parquet"])
def test_read_log_streams_with_its_own_limits(spark, tmp_path, fmt):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(str(i),) for i in range(5)], "value string").write.format(fmt).save(source)
    stream = read_log(spark, fmt, path=source)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check"))
    writer.trigger(availableNow=True).start(target).awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(target).collect()) == [str(i) for i in range(5)]


def test_lookup_refresh(spark, tmp_path):
    path = str(tmp_path / "dic")
    write = lambda row, to: spark.createDataFrame([row], "dic_code string, dic_name string").coalesce(1).write.parquet(to)
    write(("a", "A"), path)
    write(("b", "B"), str(tmp_path / "more"))
    now = [0]
    lookup = RefreshingLookup(lambda: read_lookup(spark, "parquet", ["dic_code", "dic_name"], path=path), 10, lambda: now[0])
    assert lookup().count() == 1
    (added,) = (tmp_path / "more").glob("*.parquet")     # arrives without this session's knowledge
    shutil.copy(added, path)
    now[0] = 9
    assert lookup().count() == 1
    now[0] = 10
    assert lookup().count() == 2


def test_append_and_latest(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([("k", 1, "insert"), ("g", 1, "insert")], [("k", 2, "update"), ("g", 2, "delete")]):
        W.write_upsert(spark.createDataFrame(rows, "k string, n int, type string"), path, ["k"])
    got = W.read_latest(spark, path, ["k"], ["n"], deleted=F.col("type") == "delete").collect()
    assert [tuple(r) for r in got] == [("k", 2, "update")]


def test_messages(spark):
    df = spark.createDataFrame([("1", None, 5)], "id string, x string, n int")
    (row,) = W.as_messages(df, ["id"]).collect()
    assert row.key == '["1"]' and json.loads(row.value) == {"id": "1", "n": 5}
    texts = spark.createDataFrame([("t",), (None,)], "value string")
    pairs = spark.createDataFrame([("a", None), (None, "a"), ("a-b", "c"), ("a", "b-c")], "x string, y string")
    assert len({r.key for r in W.as_messages(pairs, ["x", "y"]).collect()}) == 4
    first, second = W.as_messages(texts).collect(), W.as_messages(texts).collect()
    assert len(first) == 1 and first == second


def test_land_changes_prunes(spark, tmp_path):
    rows = [("shop", t, "insert", {"id": "1"}, None, "1") for t in ("a", "b")]
    W.land_changes(spark.createDataFrame(rows, CHANGE), str(tmp_path / "c"))
    landed = spark.read.parquet(str(tmp_path / "c"))
    plan = landed.filter("table = 'a'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(table" in plan and landed.filter("table = 'a'").count() == 1


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("x",)], "value string")
    for batch in (0, 0, 1):
        W.write_batch(one, path, batch, fmt="text")
    W.write_batch(one, path, 0, writer="second", fmt="text")
    assert spark.read.text(path).count() == 3


def test_fan_out(spark, tmp_path):
    record = {"common": {"mid": "1"}, "page": {"page_id": "p"}, "ts": 1, "displays": [{"i": 1}], "err": {"c": 1}}
    batch = parse_log(spark.createDataFrame([(json.dumps(record),)], "value string"))
    targets = {t: str(tmp_path / t) for t in S.LOG_TARGETS}
    for _ in range(2):
        W.fan_out(batch, split_log, targets, 7)
    assert {t: spark.read.schema("value string").text(p).count() for t, p in targets.items()} == {
        "page": 1, "start": 0, "display": 1, "action": 0, "error": 1}


def row_of(sink, columns, pk=None, extend=None):
    return {"source_table": "s", "sink_table": sink, "sink_columns": columns, "sink_pk": pk, "sink_extend": extend}


def test_ensure_table(spark, tmp_path):
    name = D.ensure_table(spark, row_of("dim_sample", "id,aaa,bbb"), str(tmp_path))
    assert D.ensure_table(spark, row_of("dim_sample", "id,other"), str(tmp_path)) == name      # left as it is
    table = spark.table(name)
    assert [(f.name, f.dataType.simpleString()) for f in table.schema] == [
        ("id", "string"), ("aaa", "string"), ("bbb", "string")]
    details = {r.col_name: r.data_type for r in spark.sql("describe extended dim_sample").collect()}
    assert "primary_key=id" in details["Storage Properties"]
    assert D.keys_of(row_of("x", "a,b,c", "a, b")) == ["a", "b"]


CONFIG = "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string"


def config_event(n, op, source, sink, columns, pk=None):
    row = (source, sink, columns, pk, None)
    return (op, row if op == "d" else None, None if op == "d" else row, n)


EVENTS = f"op string, before struct<{CONFIG.replace(' string', ':string')}>, after struct<{CONFIG.replace(' string', ':string')}>, ts_ms bigint"


def test_dimension_stream(spark, tmp_path):
    """Configuration is read before each batch; a repeated or resumed batch adds nothing twice."""
    config_path, root, ck = str(tmp_path / "config"), str(tmp_path / "dims"), str(tmp_path / "ck")
    put = lambda *e: spark.createDataFrame(list(e), EVENTS).write.mode("append").parquet(config_path)
    read = lambda: spark.read.schema(EVENTS).parquet(config_path)
    put(config_event(1, "r", "brand", "dim_brand", "id,name"))
    feed = Feed(spark, tmp_path / "in", CHANGE)
    change = lambda t, k, ts, data: ("shop", t, k, data, None, str(ts))
    feed.add(change("brand", "insert", 1, {"id": "1", "name": "a", "url": "u"}),
             change("brand", "update", 2, {"id": "1", "name": "b"}),
             change("shopper", "insert", 1, {"k1": "1", "k2": "2", "v": None}))
    finish(jobs.start_dimensions(feed.stream(), read, root, ck, tables=str(tmp_path / "tables")))
    assert spark.table("dim_brand").columns == ["id", "name"]
    put(config_event(2, "c", "shopper", "dim_shopper", "k1,k2,v", "k1,k2"))
    feed.add(change("shopper", "bootstrap-insert", 3, {"k1": "1", "k2": "2", "v": None}),
             change("shopper", "delete", 4, {"k1": "1", "k2": "2", "v": "gone"}),
             change("brand", "insert", 3, {"id": "2", "name": None}))
    finish(jobs.start_dimensions(feed.stream(), read, root, ck))
    brand, shopper = row_of("dim_brand", "id,name"), row_of("dim_shopper", "k1,k2,v", "k1,k2")
    rows = lambda r: sorted(tuple(x) for x in D.read_dimension(spark, r, root).collect())
    assert rows(brand) == [("1", "b"), ("2", None)]
    assert rows(shopper) == [("1", "2", None)]
    assert rows(row_of("dim_none", "id")) == []
    assert rows(row_of("dim_brand", "id,name,later")) == [("1", "b", None), ("2", None, None)]
    name = D.publish_dimension(spark, brand, root, str(tmp_path / "tables"))
    D.publish_dimension(spark, brand, root, str(tmp_path / "tables"))
    assert spark.table(name).count() == 2


def test_dimension_batch_is_idempotent(spark, tmp_path):
    config = spark.createDataFrame([("brand", "dim_brand", "id,name", None, None)], CONFIG)
    df = spark.createDataFrame([("shop", "brand", "insert", {"id": "1", "name": "a"}, None, "1")], CHANGE)
    routed = route_by_config(df, config).withColumn("change_ts", F.col("ts").cast("bigint"))
    for _ in range(2):
        D.upsert_dimensions(routed, str(tmp_path), 0)
    assert spark.read.parquet(str(tmp_path)).count() == 1


def test_dimensions_with_any_column_names(spark, tmp_path):
    config = spark.createDataFrame([("a", "dim_a", "id,writer,batch_id,_version,data", None, None),
                                    ("b", "dim_b", "id,Name", None, None), ("c", "dim_c", "id,name", None, None)], CONFIG)
    rows = [("shop", "a", "insert", {"id": "1", "writer": "Ann", "batch_id": "9", "_version": "v", "data": "d"}, None, "1"),
            ("shop", "b", "insert", {"id": "1", "Name": "B"}, None, "1"), ("shop", "c", "insert", {"id": "1", "name": "c"}, None, "1")]
    routed = route_by_config(spark.createDataFrame(rows, CHANGE), config).withColumn("change_ts", F.col("ts").cast("bigint"))
    D.upsert_dimensions(routed, str(tmp_path))
    got = {r["sink_table"]: [tuple(x) for x in D.read_dimension(spark, r, str(tmp_path)).collect()] for r in D.config_rows(config)}
    assert got == {"dim_a": [("1", "Ann", "9", "v", "d")], "dim_b": [("1", "B")], "dim_c": [("1", "c")]}
    with pytest.raises(ValueError, match="reserved"):
        W.write_batch(spark.createDataFrame([("x",)], "millrace_writer string"), str(tmp_path / "w"), 0)


def test_changes_of_one_second_go_by_arrival(spark, tmp_path):
    config = spark.createDataFrame([("brand", "dim_brand2", "id,name", None, None)], CONFIG)
    rows = [("shop", "brand", "update", {"id": "1", "name": "new"}, None, "1"), ("shop", "brand", "insert", {"id": "1", "name": "old"}, None, "1")]
    routed = route_by_config(spark.createDataFrame(rows, CHANGE), config).withColumns(
        {"change_ts": F.col("ts").cast("bigint"), "arrival": F.when(F.col("type") == "insert", 1).otherwise(2)})
    D.upsert_dimensions(routed, str(tmp_path), order=("change_ts", "arrival"))
    assert [r.name for r in D.read_dimension(spark, D.config_rows(config)[0], str(tmp_path)).collect()] == ["new"]


def test_publish_goes_by_name(spark, tmp_path):
    root, tables = str(tmp_path / "dims"), str(tmp_path / "tables")
    change = [("shop", "s", "insert", {"id": "1", "name": "Ann", "url": "u", "later": "l"}, None, "1")]
    for columns in ("id,name,url", "id,url,name", "id,later,name"):
        config = spark.createDataFrame([("s", "dim_named", columns, None, None)], CONFIG)
        routed = route_by_config(spark.createDataFrame(change, CHANGE), config).withColumn("change_ts", F.col("ts").cast("bigint"))
        D.upsert_dimensions(routed, root)
        D.publish_dimension(spark, D.config_rows(config)[0], root, tables)
        row = spark.table("dim_named").first().asDict()
        assert row["name"] == "Ann" and row["id"] == "1"
    assert row == {"id": "1", "name": "Ann", "url": None, "later": "l"}


def test_sizing():
    assert sized_for(10, 8)["spark.sql.shuffle.partitions"] == "16"
    assert sized_for(10 * 2**40, 4000)["spark.sql.shuffle.partitions"] == "40960"
    assert sized_for(100 * 2**40, 4000)["spark.sql.shuffle.partitions"] == "409600"
    assert sized_for(100 * 2**40, 4000, most=50_000)["spark.sql.shuffle.partitions"] == "50000"


def test_sessions(spark):
    other = streaming_session(spark, 3)
    assert other.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    folder = work_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and folder != work_folder(spark, "x")


def test_kafka_is_an_option(spark):
    with pytest.raises(Exception, match="kafka"):
        read_log(spark, subscribe="t", **{"kafka.bootstrap.servers": "none:1"})


def test_files_and_state_are_written_compactly(spark, tmp_path):
    """Parquet outputs have zstd unless told otherwise; a micro-batch's checkpoint holds what changed of its state, not the files that hold it."""
    import pyarrow.parquet as pq

    from millrace.sinks.writers import land_changes

    rows = spark.createDataFrame([("orders", "1"), ("lines", "2")], "table string, v string")
    codecs = {}
    for name, options in (("own", {"compression": "gzip"}), ("usual", {})):
        land_changes(rows, str(tmp_path / name), **options)
        codecs[name] = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in (tmp_path / name).rglob("*.parquet")}
    assert codecs == {"own": {"GZIP"}, "usual": {"ZSTD"}}
    session = streaming_session(spark, 2)
    stream = session.readStream.schema("v string, table string").parquet(str(tmp_path / "usual"))
    query = (stream.dropDuplicates(["v"]).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2"]
    assert list((tmp_path / "ck" / "state").rglob("*.changelog")) and not list((tmp_path / "ck" / "state").rglob("*.sst"))
