"""State with a time to live, and state by time span: waiting joins, the daily visit, the hot visitor's bounces."""

import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators.visitors import detect_bounce
from millrace.sinks.writers import read_latest, write_append
from millrace.streaming import jobs, processors, visitors
from millrace.streaming.joins import waiting_join
from tests.test_streaming import FAR, LOG, T0, Feed, finish, page

LEFT, RIGHT = "id string, k string, n int, at timestamp", "rk string, r string, price decimal(16,2)"


class Pair:
    """Two feeds, one query over both that is run to the end and later resumed."""

    def __init__(self, spark, tmp_path, how="left", ttl=3600):
        self.spark, self.out, self.ck = spark, str(tmp_path / "out"), str(tmp_path / "ck")
        self.left, self.right = Feed(spark, tmp_path / "l", LEFT), Feed(spark, tmp_path / "r", RIGHT)
        self.how, self.ttl = how, ttl

    def run(self):
        finish(jobs.start_waiting_join(self.left.stream(), self.right.stream(), [("k", "rk")], self.out, self.ck, ["id"],
                                       self.how, self.ttl))

    def got(self):
        return sorted(((r.id, r.r, r.revision) for r in self.spark.read.parquet(self.out).collect()), key=str)


def stamp(spark):
    return spark.sql("select timestamp'2024-03-01 10:00:00.123456' as t").first().t


def test_waiting_join_pads_early_and_corrects(spark, tmp_path):
    pair, at = Pair(spark, tmp_path), stamp(spark)
    pair.left.add(("1", "a", 5, at), ("2", "b", None, None), ("3", None, 1, at), ("4", "a", 6, at))
    pair.right.add(("a", "ra", None), (None, "none", None))
    pair.run()
    assert pair.got() == [("1", "ra", 1), ("2", None, 0), ("3", None, 0), ("4", "ra", 1)]
    pair.right.add(("b", "rb", Decimal(2)), ("c", "rc", Decimal(3)))
    pair.left.add(("5", "c", 7, at))
    pair.run()
    last = read_latest(spark, pair.out, ["id"], ["revision"]).orderBy("id").collect()
    assert [(r.id, r.n, r.at, r.r, r.price and int(r.price)) for r in last] == [
        ("1", 5, at, "ra", None), ("2", None, None, "rb", 2), ("3", 1, at, None, None), ("4", 6, at, "ra", None), ("5", 7, at, "rc", 3)]
    assert last[0].asDict().keys() == {"id", "k", "n", "at", "r", "price", "revision"}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_waiting_join_equals_the_batch_join(spark, tmp_path, how):
    r, pair = random.Random(4), Pair(spark, tmp_path, how)
    lefts = [(str(i), r.choice("abcdefgh"), i, None) for i in range(40)]
    rights = [(r.choice("abcdefxy"), f"r{i}", None) for i in range(12)]
    for i in range(4):
        pair.left.add(*lefts[10 * i:10 * i + 10])
        pair.right.add(*rights[3 * i:3 * i + 3])
    pair.run()
    want = sorted((a[0], b[1]) for a in lefts for b in rights if a[1] == b[0])
    got = pair.got()
    assert sorted((i, x) for i, x, n in got if n) == want
    padded = {i for i, _, n in got if not n}
    assert all(x is None for i, x, n in got if not n) and len(got) == len(want) + len(padded)
    alone = {a[0] for a in lefts} - {i for i, _ in want}
    assert alone <= padded if how == "left" else not padded
    for i in {i for i, _ in want}:  # revisions of one row are told apart
        numbers = sorted(n for j, _, n in got if j == i and n)
        assert numbers == list(range(1, len(numbers) + 1))


def test_waiting_rows_expire(spark, tmp_path):
    pair = Pair(spark, tmp_path, ttl=1)
    pair.left.add(("1", "a", 1, None))
    pair.right.add(("b", "rb", None))
    pair.run()
    time.sleep(1.5)
    pair.left.add(("2", "b", 1, None))
    pair.right.add(("a", "ra", None))
    pair.run()
    assert pair.got() == [("1", None, 0), ("2", None, 0)]


def test_waiting_join_refuses_what_it_cannot_hold(spark, tmp_path):
    pair = Pair(spark, tmp_path)
    pair.left.add(("1", "a", 1, None))
    pair.right.add(("a", "ra", None))
    with pytest.raises(ValueError, match="atomic"):
        waiting_join(pair.left.stream().withColumn("m", F.create_map("id", "k")), pair.right.stream(), [("k", "rk")])
    with pytest.raises(ValueError, match="both sides"):
        waiting_join(pair.left.stream(), pair.right.stream().withColumnRenamed("r", "n"), [("k", "rk")])


def daily(spark, tmp_path, feed, **options):
    rows = feed.stream().select(F.get_json_object("value", "$.common.mid").alias("mid"), F.get_json_object("value", "$.ts").cast("long").alias("ts"),
                                F.get_json_object("value", "$.page.last_page_id").alias("last_page_id"), "arrival")
    query = write_append(visitors.first_visit_per_day(rows, **options), str(tmp_path / "out"), str(tmp_path / "ck"), idle=False)
    finish(query)
    return query


def test_a_visitor_is_forgotten_after_a_day(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", LOG)
    feed.add(*[(page(str(i), T0), i) for i in range(60)])
    kept = daily(spark, tmp_path, feed, ttl=1).lastProgress["stateOperators"][0]["numRowsTotal"]
    assert kept >= 60
    time.sleep(1.5)
    feed.add((page("0", T0 + 1), 100), (page("new", T0 + 1), 101))
    query = daily(spark, tmp_path, feed, ttl=1)
    left = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]
    assert left < kept / 5  # the state rows of all who were not seen again are gone
    got = sorted((r.mid, r.ts) for r in spark.read.parquet(str(tmp_path / "out")).filter("mid in ('0', 'new')").collect())
    assert got == [("0", T0), ("0", T0 + 1), ("new", T0 + 1)]


def test_a_visitor_is_remembered_for_a_day(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", LOG)
    feed.add((page("0", T0), 0))
    daily(spark, tmp_path, feed)
    feed.add((page("0", T0 + 1), 1), (page("0", T0 + 86_400_000), 2))
    daily(spark, tmp_path, feed)
    assert sorted(r.ts for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [T0, T0 + 86_400_000]


def test_a_hot_visitor_is_spread_by_time(spark, tmp_path):
    """A third of all records is one visitor's: many groups of state, none with more than a span's records."""
    r = random.Random(9)
    records = sorted((T0 + r.randrange(4_000_000), "hot" if i % 3 == 0 else str(i % 200)) for i in range(3000))
    records = [(mid, ts, r.choice([None, None, "home"])) for ts, mid in records]
    feed = Feed(spark, tmp_path / "in", LOG)
    for i in range(0, 3000, 1000):
        feed.add(*[(page(m, t, l), i + n) for n, (m, t, l) in enumerate(records[i:i + 1000])])
    feed.add((page("end", FAR), 9999))
    finish(jobs.start_user_jump(feed.stream(), str(tmp_path / "out"), str(tmp_path / "ck")))
    got = sorted((x.mid, x.ts, x.arrival) for x in spark.read.parquet(str(tmp_path / "out")).collect() if x.mid != "end")
    rows = spark.createDataFrame([(m, t, l, i) for i, (m, t, l) in enumerate(records)], "mid string, ts long, last_page_id string, arrival long")
    assert got == sorted((x.mid, x.ts, x.arrival) for x in detect_bounce(rows).collect())
    span = visitors.BOUNCE_SPANS * 10_000
    most = max(sum(1 for m, t, _ in records if m == "hot" and b <= t < b + span + 10_000) for b in range(0, 5_000_000, span))
    assert most < 100  # of 1,000


def test_the_seam_only_follows():
    """A seam record ends the wait of a span's own start and starts none itself."""
    import pandas as pd

    from tests.test_processors import Handle, Mark

    processor = processors.BounceProcessor(10, "mid", "ts", "arrival", "start", "own", "value")
    processor.init(Handle())
    columns = ["mid", "ts", "arrival", "start", "own", "value"]
    part = pd.DataFrame([("1", 75, 1, True, True, "v"), ("1", 83, 2, True, False, None), ("1", 60, 3, True, True, "u")], columns=columns)
    list(processor.handleInputRows(("1", 0), iter([part]), Mark(0)))
    (out,) = processor.handleExpiredTimer(("1", 0), Mark(1000), None)
    assert list(out["ts"]) == [60, 75] and list(out["value"]) == ["u", "v"]
    assert not processor._waiting.exists() and not processor._pending.exists()


def test_the_waiting_join_works_on_groups_of_keys(spark, tmp_path, monkeypatch):
    """Many keys share a call and its state, whose rows are few entries; every key keeps its own partners and revisions."""
    monkeypatch.setattr("millrace.streaming.joins.GROUPS", 16, raising=False)
    pair = Pair(spark, tmp_path)
    pair.left.add(*[(str(i), f"k{i}", i, None) for i in range(4000)])
    pair.right.add(("none", "none", None))
    pair.run()
    pair.right.add(*[(f"k{i}", f"r{i}", None) for i in range(0, 4000, 2)])
    query = jobs.start_waiting_join(pair.left.stream(), pair.right.stream(), [("k", "rk")], pair.out, pair.ck, ["id"], "left", 3600)
    finish(query)
    entries = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]
    assert 0 < entries < 3000  # of 6,000 waiting rows; with times to live counted
    assert pair.got() == sorted([(str(i), None, 0) for i in range(4000)] + [(str(i), f"r{i}", 1) for i in range(0, 4000, 2)], key=str)


def test_bounces_of_many_visitors_share_a_call():
    """A call takes the records of several visitors, each by itself, whichever order they came in; a null visitor is one too."""
    import pandas as pd

    from tests.test_processors import Handle, Mark

    processor, handle = processors.BounceProcessor(10, "mid", "ts", "arrival", "start", "own", "value"), Handle()
    processor.init(handle)
    columns = ["mid", "ts", "arrival", "start", "own", "value"]
    rows = [("b", 20, 1, True, True, "b20"), ("a", 15, 2, True, True, "a15"), (None, 12, 3, True, True, "n12"), ("a", 18, 4, False, True, None),
            ("b", 25, 5, True, True, "b25"), (None, 14, 6, False, True, None), ("c", 95, 7, True, True, "c95"), ("d", 200, 8, True, True, "d200")]
    for part in (rows[:3], rows[3:]):
        list(processor.handleInputRows((0, 0), iter([pd.DataFrame(part, columns=columns)]), Mark(0)))
    (out,) = processor.handleExpiredTimer((0, 0), Mark(100), None)
    assert sorted(out["value"]) == ["b20", "b25"]  # c95 still waits, d200 has not been reached
    assert max(handle.timers) == 105
    (out,) = processor.handleExpiredTimer((0, 0), Mark(105), None)
    assert list(out["value"]) == ["c95"]
    (out,) = processor.handleExpiredTimer((0, 0), Mark(1000), None)
    assert list(out["value"]) == ["d200"]
    assert not processor._waiting.exists() and not processor._pending.exists()


class Entries:
    """State that counts the bytes written to it."""

    def __init__(self):
        self.found, self.written = {}, 0

    def exists(self):
        return bool(self.found)

    def get(self):
        return self.found.get(())

    def update(self, value):
        self.updateValue((), value)

    def updateValue(self, key, value):
        self.found[key] = value
        self.written += sum(len(v) for v in value if isinstance(v, bytes))

    def removeKey(self, key):
        del self.found[key]

    def iterator(self):
        return iter(list(self.found.items()))


def test_waiting_rows_are_not_written_again():
    """What a micro-batch writes is in proportion to its own rows, not to all that wait; after many, all rows are still there once."""
    import pandas as pd

    from millrace.streaming.joins import FAN, KEY, LEFT_SIDE, WaitingJoinProcessor

    class Handle:
        def __init__(self):
            self.made = []

        def getValueState(self, *_):
            self.made.append(Entries())
            return self.made[-1]

        getMapState = getValueState

    class Now:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentProcessingTimeInMs(self):
            return self.ms

    processor, handle, r = WaitingJoinProcessor(["l0"], ["r0"], ["l0"], ["k0"], True, 100_000), Handle(), random.Random(3)
    processor.init(handle)

    def call(rows, ms=0):
        part = pd.DataFrame(rows, columns=[LEFT_SIDE, "l0", "k0", "r0"])
        return [tuple(x) for out in processor.handleInputRows((0,), iter([part]), Now(ms)) for x in out.itertuples(index=False)]

    names = [f"{r.random()}" for _ in range(2000)]
    assert len(call([(True, n, None, None) for n in names])) == 2000
    first, got = sum(s.written for s in handle.made), []
    for i in range(100):  # each finds 20 of the 2,000 rows, and leaves 20 without a partner
        got += call([(False, None, n, f"r{i}") for n in names[20 * i:20 * i + 20]] + [(True, f"x{i}-{n}", None, None) for n in range(20)], i)
    assert sorted(x for x in got if x[2] == 1) == sorted((n, f"r{i // 20}", 1) for i, n in enumerate(names))
    assert sum(s.written for s in handle.made) < 20 * first  # over 100 times if all that waits were written
    assert all(len(s.found) < 3 * FAN for s in handle.made)
    assert sorted(call([(False, None, n, "again") for n in [*names[:40], "x3-4"]], 99_000)) == sorted(
        [(n, "again", 2) for n in names[:40]] + [("x3-4", "again", 1)])
    # 40 rows were renewed at 99 s; the others' time is over, that of the older forms of these, too.
    assert sorted(x[2] for x in call([(False, None, n, "late") for n in names], 150_000)) == [3] * 40
    assert KEY not in {c for s in handle.made for v in s.found.values() for c in processors.unpacked(v[1:])}
