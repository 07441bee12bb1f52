"""Compacted upsert tables against the plain view over all versions."""

import random
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators.upsert import latest_by_key
from millrace.sinks import dimensions as D
from millrace.sinks import merged as M
from millrace.sinks import writers as W
from tests.test_sinks import CHANGE, CONFIG
from tests.test_streaming import Feed, finish

SCHEMA = "k string, g int, at bigint, v string, gone boolean"


def table(spark, root, **options):
    return M.MergedTable(spark, str(root), SCHEMA, ["k", "g"], ["at"], deleted="gone", **{"buckets": 8, **options})


def batches(seed, n, rows=60, keys=25):
    """Random versions; some keys null, some batches late (older than what they meet), some deletes; no two of a key alike."""
    r, out = random.Random(seed), []
    for b in range(n):
        moments = r.sample(range(10_000), rows)
        out.append([(r.choice([None, *map(str, range(keys))]), r.choice([None, 1, 2]), at - 3000 * (b % 3), f"{b}-{at}", r.random() < .2)
                    for at in moments])
    return out


def plain(spark, parts):
    rows = spark.createDataFrame([x for p in parts for x in p], SCHEMA)
    return Counter(map(tuple, latest_by_key(rows, ["k", "g"], ["at", "v"], deleted=F.col("gone")).collect()))


@pytest.mark.parametrize("broadcast", [True, False])
def test_compaction_equals_the_plain_view(spark, tmp_path, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(M, "fits", lambda *_: False)
    t, parts = table(spark, tmp_path / "t"), batches(1, 9)
    assert t.current().count() == 0 and t.compact() is None
    for i, part in enumerate(parts):
        t.append(spark.createDataFrame(part, SCHEMA), i % 5, f"w {i // 5}/é")  # two writers, each counts from zero
        if i in (1, 4, 5):
            assert t.compact() == {1: 1, 4: 2, 5: 3}[i] and t.compact() is None
        assert Counter(map(tuple, t.current().collect())) == plain(spark, parts[:i + 1])
    plain_readers = W.read_latest(spark, t.root, ["k", "g"], ["at", "v"], deleted=F.col("gone"))
    assert Counter(tuple(r)[:5] for r in plain_readers.select("k", "g", "at", "v", "gone").collect()) == plain(spark, parts)
    t.compact()
    t.vacuum()
    assert Counter(map(tuple, t.current().collect())) == plain(spark, parts)
    again = spark.createDataFrame(parts[0], SCHEMA)
    t.append(again, 0, "w 0/é")  # a covered batch that is written again changes nothing
    assert Counter(map(tuple, t.current().collect())) == plain(spark, parts)


def test_covered_batches_are_not_read(spark, tmp_path):
    t, parts = table(spark, tmp_path / "t"), batches(2, 4)
    for i, part in enumerate(parts[:3]):
        t.append(spark.createDataFrame(part, SCHEMA), i)
    t.compact()
    text = t.current()._jdf.queryExecution().executedPlan().toString()
    assert f"{W.BATCH}" in text.split("PartitionFilters: [", 1)[1]
    for i in range(3):
        shutil.rmtree(tmp_path / "t" / f"{W.WRITER}=main" / f"{W.BATCH}={i}")
    t.append(spark.createDataFrame(parts[3], SCHEMA), 3)
    assert Counter(map(tuple, t.current().collect())) == plain(spark, parts)


def test_the_snapshot_is_not_shuffled_by_a_small_batch(spark, tmp_path):
    t, parts = table(spark, tmp_path / "t"), batches(3, 2)
    t.append(spark.createDataFrame(parts[0], SCHEMA), 0)
    t.compact()
    t.append(spark.createDataFrame(parts[1], SCHEMA), 1)
    text = t.current()._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 0 and text.count("BroadcastHashJoin") >= 2
    # Only the batch's own versions are shuffled, once wherever they are used; the snapshot is in none of these shuffles.
    shuffled = [part.split("FileScan")[1] for part in text.split("Exchange hashpartitioning")[1:]]
    assert shuffled and all("_merged" not in scan for scan in shuffled)


def test_a_killed_compaction_leaves_the_old_view(spark, tmp_path, monkeypatch):
    t, parts = table(spark, tmp_path / "t"), batches(4, 3)
    for i, part in enumerate(parts):
        t.append(spark.createDataFrame(part, SCHEMA), i)
        if i == 0:
            t.compact()
    monkeypatch.setattr(M.MergedTable, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        t.compact()
    assert t.manifest()["generation"] == 1
    assert Counter(map(tuple, t.current().collect())) == plain(spark, parts)
    monkeypatch.undo()
    assert t.compact() == 2
    t.vacuum()
    assert Counter(map(tuple, t.current().collect())) == plain(spark, parts)
    left = {p.name for p in (tmp_path / "t" / "_merged").iterdir() if p.name[0].isdigit()}
    assert left == set(t.manifest()["places"].values())


def test_of_two_compactions_one_wins(spark, tmp_path, monkeypatch):
    t, parts = table(spark, tmp_path / "t"), batches(5, 1)
    t.append(spark.createDataFrame(parts[0], SCHEMA), 0)
    other = table(spark, tmp_path / "t")
    publish = M.MergedTable._publish

    def late(self, manifest):
        if self is t:
            other.compact()
        publish(self, manifest)

    monkeypatch.setattr(M.MergedTable, "_publish", late)
    with pytest.raises(Exception, match="exist"):
        t.compact()
    assert t.manifest()["generation"] == 1 and Counter(map(tuple, t.current().collect())) == plain(spark, parts)


def test_an_unmarked_batch_is_read_but_not_compacted(spark, tmp_path):
    t, parts = table(spark, tmp_path / "t"), batches(6, 2)
    t.append(spark.createDataFrame(parts[0], SCHEMA), 0)
    W.write_batch(spark.createDataFrame(parts[1], SCHEMA), t.root, 1)  # its writer died before it marked the batch
    assert Counter(map(tuple, t.current().collect())) == plain(spark, parts)
    t.compact()
    assert t.manifest()["covered"] == {"main": 0}
    assert Counter(map(tuple, t.current().collect())) == plain(spark, parts)


def test_tombstones_survive_until_forgotten(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    put = lambda n, *rows: t.append(spark.createDataFrame(list(rows), SCHEMA), n)
    put(0, ("a", 1, 5, "x", False), ("b", 1, 5, "x", False))
    t.compact()
    put(1, ("a", 1, 9, None, True))
    t.compact()
    put(2, ("a", 1, 7, "older", False))  # arrives late: the key stays deleted
    assert [r.k for r in t.current().collect()] == ["b"]
    t.compact()
    assert [r.k for r in t.current().collect()] == ["b"]
    put(3, ("a", 1, 10, "anew", False), ("b", 1, 11, None, True))
    t.compact(forget="at < 100")
    assert [(r.k, r.v) for r in t.current().collect()] == [("a", "anew")]
    put(4, ("b", 1, 1, "forgotten", False))
    assert {r.k for r in t.current().collect()} == {"a", "b"}


def test_untouched_buckets_stay_where_they_are(spark, tmp_path):
    t = table(spark, tmp_path / "t", buckets=64)
    t.append(spark.createDataFrame([(str(i), 1, 1, "x", False) for i in range(300)], SCHEMA), 0)
    t.compact()
    first = t.manifest()["places"]
    for n in range(1, M.MOST_FOLDERS + 3):
        t.append(spark.createDataFrame([(str(n), 1, 2, "y", False)], SCHEMA), n)
        t.compact()
        places = t.manifest()["places"]
        assert places.keys() == first.keys() and len(set(places.values())) <= M.MOST_FOLDERS + 1
        if n == 1:
            assert sum(places[b] != first[b] for b in first) == 1
    assert t.current().count() == 300 and t.current().filter("v = 'y'").count() == M.MOST_FOLDERS + 2


def test_stream_into_a_merged_table(spark, tmp_path):
    t, parts = table(spark, tmp_path / "t"), batches(7, 5)
    feed = Feed(spark, tmp_path / "in", SCHEMA)
    for part in parts:
        feed.add(*part)
    finish(M.start_upsert(feed.stream(), t, str(tmp_path / "ck"), compact_every=2))
    assert t.manifest()["covered"] == {"main": 3} and t.manifest()["generation"] == 2
    assert Counter(map(tuple, t.current().collect())) == plain(spark, parts)


def test_compacted_dimensions(spark, tmp_path):
    config = spark.createDataFrame([("a", "dim_a", "id,name", None, None), ("b", "dim_b", "id,name", None, None)], CONFIG)
    from millrace.operators.routing import route_by_config

    def put(n, *rows):
        df = spark.createDataFrame([("shop", t, "update", {"id": i, "name": v}, None, at) for t, i, v, at in rows], CHANGE)
        D.upsert_dimensions(route_by_config(df, config).withColumn("change_ts", F.col("ts").cast("bigint")), str(tmp_path), n)

    row_a, row_b = D.config_rows(config.orderBy("source_table"))
    rows = lambda row: sorted(tuple(r) for r in D.read_dimension(spark, row, str(tmp_path)).collect())
    put(0, ("a", "1", "x", "1"), ("a", "2", None, "1"), ("b", "1", "y", "1"))
    log = D.dimension_log(spark, str(tmp_path), buckets=4)
    assert log.compact() == 1
    put(1, ("a", "1", "late", "0"), ("a", "3", "z", "1"), ("b", "1", "new", "2"))
    want = [("1", "x"), ("2", None), ("3", "z")], [("1", "new")]
    assert (rows(row_a), rows(row_b)) == want
    log.compact()
    log.vacuum()
    assert (rows(row_a), rows(row_b)) == want
    files = D.dimension_log(spark, str(tmp_path)).current(F.col("sink_table") == "dim_b")
    text = files._jdf.queryExecution().executedPlan().toString()
    assert "sink_table" in text.split("PartitionFilters: [", 1)[1]


def test_messages_with_tombstones(spark):
    rows = [("a", "x", 1, "insert"), ("a", "y", 2, "delete"), ("b", "z", 3, "insert"), (None, "n", 4, "insert"), ("c", "q", 5, "delete"),
            ("c", None, 6, "insert"), ("d", "w", 7, None)]
    df = spark.createDataFrame(rows, "k string, v string, n int, type string")
    messages = W.as_messages(df, ["k"], deleted=F.col("type") == "delete")
    got = {(r.key, r.value is None) for r in messages.collect()}
    assert got == {('["a"]', False), ('["a"]', True), ('["b"]', False), ("[null]", False), ('["c"]', True), ('["c"]', False), ('["d"]', False)}
    topic = messages.withColumn("arrival", F.coalesce(F.get_json_object("value", "$.n").cast("int"), F.when(F.col("key") == '["a"]', 2).otherwise(5)))
    last = W.latest_messages(topic, "k string, v string, n int")
    assert sorted(map(tuple, last.collect()), key=str) == sorted([("b", "z", 3), (None, "n", 4), ("c", None, 6), ("d", "w", 7)], key=str)
