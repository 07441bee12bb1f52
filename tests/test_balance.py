"""No silent loss: every text read is an output, in one pass, and the counts say so."""

import json

from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.operators.routing import tag_by_config
from millrace.sinks import dimensions as D
from millrace.sources.changes import read_config_changes, split_changes, tag_changes
from millrace.streaming import jobs
from millrace.streaming.config import ConfigLog
from tests.test_sinks import CHANGE, CONFIG, EVENTS, config_event
from tests.test_streaming import Feed, finish, page

LOG = "value string, arrival bigint"


def change(table, ts="5", kind="insert", **data):
    return json.dumps({"database": "shop", "table": table, "type": kind, "ts": ts, "data": data, "old": None})


TEXTS = [change("a", id="1"), change("a", ts=7, id="2"), change("b", kind="delete", id="3"), None, "", "{bad", '"x"', "[1]", '{"type":"insert"}',
         change("a", ts="soon", id="4"), change("a", ts=None, id="5"), change("b", ts="99999999999999", id="6")]


def test_tag_changes_leaves_nothing_out(spark):
    tagged = tag_changes(spark.createDataFrame([(t, n) for n, t in enumerate(TEXTS)], LOG), keep=["arrival"])
    got = {r.arrival: (r.outcome, r.value) for r in tagged.collect()}
    assert [got[n][0] for n in range(len(TEXTS))] == ["change"] * 3 + ["unreadable"] * 6 + ["untimed"] * 3
    assert all(got[n][1] == (None if n < 3 else TEXTS[n]) for n in got)
    good, faulty = split_changes(tagged)
    assert good.columns == ["arrival", *S.CHANGE_SCHEMA.names] and (good.count(), faulty.count()) == (3, 9)
    assert [r.data for r in good.orderBy("arrival").collect()] == [{"id": "1"}, {"id": "2"}, {"id": "3"}]


def test_changes_land_in_one_pass(spark, tmp_path):
    feed, target = Feed(spark, tmp_path / "in", LOG), str(tmp_path / "out")
    feed.add(*[(t, n) for n, t in enumerate(TEXTS[:5])])
    feed.add(*[(t, n) for n, t in enumerate(TEXTS[5:])])
    query = jobs.start_changes(feed.stream(), target, str(tmp_path / "ck"))
    finish(query)
    assert all(len(p["sources"]) == 1 for p in query.recentProgress)  # the log is scanned once
    balances = [p["observedMetrics"]["balance"].asDict() for p in query.recentProgress if p["numInputRows"]]
    assert sum(b["read"] for b in balances) == len(TEXTS) == sum(p["numInputRows"] for p in query.recentProgress)
    assert all(b["read"] == b["changes"] + b["unreadable"] + b["untimed"] for b in balances)
    landed = jobs.landed_changes(spark, target)
    assert sorted(r.data["id"] for r in landed.collect()) == ["1", "2", "3"]
    assert sorted((r.outcome, str(r.value)) for r in jobs.faulty_changes(spark, target).collect()) == sorted(
        ("unreadable" if n < 9 else "untimed", str(t)) for n, t in enumerate(TEXTS) if n > 2)
    plan = landed.filter("table = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "outcome" in plan.split("PartitionFilters: [", 1)[1] and landed.filter("table = 'a'").count() == 2
    assert jobs.landed_changes(spark, target, stream=True).isStreaming


def test_the_log_is_split_in_one_pass(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", LOG)
    dirty = ["{bad", None, json.dumps({"ts": 5}), json.dumps({"page": {}, "err": {"c": 1}, "displays": [{}], "ts": 5})]
    feed.add((page("1", 1000, flag="1"), 0), *[(t, n + 1) for n, t in enumerate(dirty)], (page("1", 90_000_000, flag="1"), 9))
    query = jobs.start_log_split(feed.stream(), str(tmp_path / "out"), str(tmp_path / "ck"))
    finish(query)
    assert all(len(p["sources"]) == 1 for p in query.recentProgress)
    (balance,) = [p["observedMetrics"]["balance"].asDict() for p in query.recentProgress if p["numInputRows"]]
    assert balance == {"read": 6, "usable": 2, "dirty": 4}
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.target, r.arrival) for r in rows) == [("dirty", 1), ("dirty", 2), ("dirty", 3), ("dirty", 4), ("page", 0), ("page", 9)]
    assert {r.arrival: r.value for r in rows if r.target == "dirty"} == dict(enumerate(dirty, 1))
    assert [json.loads(r.value)["common"]["is_new"] for r in sorted(rows, key=lambda r: r.arrival) if r.target == "page"] == ["1", "0"]


def test_tag_by_config(spark):
    config = spark.createDataFrame([("a", "dim_a", "id,n", "id", None)], CONFIG)
    rows = [("shop", "a", "insert", {"id": "1", "x": "2"}, None, "1"), ("shop", "a", "delete", {"id": "1", "x": "2"}, None, "1"),
            ("shop", "b", "insert", {"id": "1", "x": "2"}, None, "1"), ("shop", None, "insert", None, None, None), ("shop", "a", None, None, None, None)]
    got = [(r.outcome, r.sink_table, r.pk, r.data) for r in tag_by_config(spark.createDataFrame(rows, CHANGE).coalesce(1), config).collect()]
    whole = {"id": "1", "x": "2"}
    assert got == [("routed", "dim_a", ["1"], {"id": "1"}), ("no data", None, None, whole), ("unrouted", None, None, whole),
                   ("unrouted", None, None, None), ("no data", None, None, None)]


def test_rejected_rows_balance(spark, tmp_path):
    config = [config_event(1, "r", "a", "dim_bal", "id")]
    read = lambda: spark.createDataFrame(config, EVENTS)
    feed = Feed(spark, tmp_path / "in", CHANGE)
    row = lambda t, i, kind="insert": ("shop", t, kind, {"id": i}, None, "1")
    feed.add(row("a", "1"), row("b", "2"), row("a", "3", "delete"))
    feed.add(row("c", "4"), row("b", "5", "delete"))
    root, rejects = str(tmp_path / "dims"), str(tmp_path / "rejects")
    finish(jobs.start_dimensions(feed.stream(), read, root, str(tmp_path / "ck"), rejects=rejects))
    got = spark.read.parquet(f"{rejects}/rows")
    assert sorted((r.outcome, r.data["id"]) for r in got.collect()) == [("no data", "3"), ("unrouted", "2"), ("unrouted", "4"), ("unrouted", "5")]
    balances = spark.read.parquet(f"{rejects}/balance").orderBy("millrace_batch").collect()
    assert [(b["read"], b["routed"], b["unrouted"], b["no_data"]) for b in balances] == [(3, 1, 1, 1), (2, 0, 2, 0)]
    assert [r.id for r in D.read_dimension(spark, D.config_rows(spark.createDataFrame([("a", "dim_bal", "id", None, None)], CONFIG))[0], root).collect()] == ["1"]


def test_configuration_is_read_on(spark, tmp_path):
    feed = Feed(spark, tmp_path / "config", EVENTS)
    feed.add(config_event(1, "r", "brand", "dim_brand", "id,name"), config_event(1, "r", "old", "dim_old", "id"))
    log = ConfigLog(spark, feed.stream, str(tmp_path / "state"), compact_every=2)
    rows = lambda: sorted((r.source_table, r.sink_table, r.sink_columns) for r in log().collect())
    assert rows() == [("brand", "dim_brand", "id,name"), ("old", "dim_old", "id")]
    feed.add(config_event(3, "u", "brand", "dim_brand", "id,name,url"))
    feed.add(config_event(2, "u", "brand", "dim_brand", "stale"), config_event(4, "d", "old", "dim_old", "id"))
    assert rows() == [("brand", "dim_brand", "id,name,url")]
    assert rows() == [("brand", "dim_brand", "id,name,url")]
    assert log.numbers == [2, 3, 0]  # only what is new is read
    again = ConfigLog(spark, feed.stream, str(tmp_path / "state"))
    assert [r.sink_columns for r in again().collect()] == ["id,name,url"] and again.numbers == [0]


def test_dimensions_by_an_advancing_configuration(spark, tmp_path):
    feed, config = Feed(spark, tmp_path / "in", CHANGE), Feed(spark, tmp_path / "config", EVENTS)
    row = lambda t, i: ("shop", t, "insert", {"id": i, "name": "n"}, None, "1")
    config.add(config_event(1, "r", "a", "dim_adv_a", "id"))
    log = ConfigLog(spark, config.stream, str(tmp_path / "state"))
    start = lambda: finish(jobs.start_dimensions(
        feed.stream(), log, str(tmp_path / "dims"), str(tmp_path / "ck"), rejects=str(tmp_path / "rejects")))
    feed.add(row("a", "1"), row("b", "2"))
    start()
    config.add(config_event(2, "c", "b", "dim_adv_b", "id,name"))
    feed.add(row("b", "3"))
    feed.add(row("a", "4"))
    start()
    assert log.numbers == [1, 1, 0]
    a, b = (D.config_rows(spark.createDataFrame([(t, f"dim_adv_{t}", c, None, None)], CONFIG))[0] for t, c in (("a", "id"), ("b", "id,name")))
    assert sorted(r.id for r in D.read_dimension(spark, a, str(tmp_path / "dims")).collect()) == ["1", "4"]
    assert [tuple(r) for r in D.read_dimension(spark, b, str(tmp_path / "dims")).collect()] == [("3", "n")]
    assert spark.read.parquet(str(tmp_path / "rejects" / "rows")).select("data.id").collect()[0].id == "2"
    texts = spark.createDataFrame([(json.dumps({"op": "c", "after": {"source_table": "x"}, "ts_ms": 3}),)], "value string")
    assert read_config_changes(texts).count() == 1
