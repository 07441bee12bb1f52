import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import bounds
from millrace.operators.joins import lookup_join, retained_join, two_role_lookup
from millrace.operators.logsplit import route_log, split_log, write_flag
from millrace.operators.quality import parse_log, split_dirty
from millrace.operators.routing import current_config, route_by_config, unrouted
from millrace.operators.selection import keep_types, select_table, union_all
from millrace.operators.upsert import latest_by_key
from millrace.operators.visitors import detect_bounce, first_visit_per_day, repair_new_flag

DAY = 86_400_000
PAGE = "mid string, ts bigint, last_page_id string, arrival bigint"


# ---- dirty records and the log split ----

def test_dirty(spark):
    texts = ["{bad", "", None, '"x"', '{"ts":1}', "[1]", "null", '{"common":{"mid":null},"ts":1}',
             '{"common":"q","ts":1}', '{"common":{"mid":"1"}}']
    good_text = '{"common":{"mid":"1"},"ts":1}'
    df = spark.createDataFrame([(t,) for t in [*texts, good_text]], "value string")
    good, dirty = split_dirty(parse_log(df))
    assert [r.value for r in good.collect()] == [good_text]
    assert dirty.columns == ["value"]
    assert sorted(r.value or "" for r in dirty.collect()) == sorted(t or "" for t in texts)


RECORD = {"common": {"mid": "1", "is_new": "1", "os": "x"}, "page": {"page_id": "home", "during": 7}, "ts": 5,
          "displays": [{"item": "a"}, {"item": "b"}], "actions": [{"action_id": "t", "ts": 6}], "err": {"code": 1},
          "extra": {"kept": [1]}}
START = {"common": {"mid": "2"}, "start": {"entry": "icon"}, "err": {"code": 2}, "ts": 9, "displays": [{"item": "z"}]}


def outputs(spark, *records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    parsed, _ = split_dirty(parse_log(df))
    listed = {t: [json.loads(r.value) for r in d.collect()] for t, d in split_log(parsed).items()}
    routed = {t: [] for t in listed}
    for r in route_log(parsed).collect():
        routed[r.target].append(json.loads(r.value))
    canonical = lambda texts: sorted(json.dumps(t, sort_keys=True) for t in texts)
    assert {t: canonical(v) for t, v in routed.items()} == {t: canonical(v) for t, v in listed.items()}
    return listed


def test_log_split(spark):
    out = outputs(spark, RECORD)
    assert out["error"] == [RECORD]
    assert out["page"] == [{k: v for k, v in RECORD.items() if k not in ("err", "displays", "actions")}]
    assert out["start"] == []
    assert [d["item"] for d in out["display"]] == ["a", "b"]
    display, action = out["display"][0], out["action"][0]
    assert json.loads(display.pop("common")) == RECORD["common"]
    assert display == {"item": "a", "page_id": "home", "ts": 5}
    assert json.loads(action.pop("common")) == RECORD["common"]
    assert action == {"action_id": "t", "ts": 6, "page_id": "home"}


def test_log_split_start_and_nulls(spark):
    out = outputs(spark, START)
    assert out["error"] == [START] and len(out["start"]) == 1 and "err" not in out["start"][0]
    assert out["page"] == out["display"] == out["action"] == []
    plain = {"common": {"mid": "3"}, "page": {"page_id": "p"}, "ts": 1, "err": None, "start": None, "displays": []}
    out = outputs(spark, plain)
    assert out["page"] == [{"common": {"mid": "3"}, "page": {"page_id": "p"}, "ts": 1}]
    assert out["error"] == out["start"] == out["display"] == out["action"] == []


def test_write_flag_keeps_the_rest(spark):
    df = spark.createDataFrame([(json.dumps(RECORD),)], "value string")
    parsed = parse_log(df).withColumn("is_new", F.lit("0"))
    page = split_log(write_flag(parsed))["page"].first().value
    assert json.loads(page)["common"] == {"mid": "1", "is_new": "0", "os": "x"}


# ---- visitors, against small automata ----

def flags_by_automaton(rows):
    state, out = {}, []
    for mid, flag, ts, arrival in sorted(rows, key=lambda r: r[3]):
        day = ts // DAY
        if flag == "1":
            if mid not in state:
                state[mid] = day
            elif state[mid] != day:
                flag = "0"
        elif mid not in state:
            state[mid] = day - 1
        out.append((mid, flag, ts, arrival))
    return sorted(out, key=lambda r: r[3])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repair_new_flag_random(spark, seed):
    rnd = random.Random(seed)
    rows = [(str(rnd.randrange(40)), rnd.choice(["1", "0", None, "1"]), rnd.randrange(4 * DAY), i) for i in range(400)]
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "mid string, is_new string, ts bigint, arrival bigint")
    got = sorted((tuple(r) for r in repair_new_flag(df).collect()), key=lambda r: r[3])
    assert got == flags_by_automaton(rows)


@pytest.mark.parametrize("given,want", [
    ([("1", 0), ("1", 5)], ["1", "1"]), ([("1", 0), ("1", DAY)], ["1", "0"]),
    ([("0", 0), ("1", 5)], ["0", "0"]), ([(None, 0), ("1", DAY)], [None, "0"])])
def test_repair_new_flag(spark, given, want):
    df = spark.createDataFrame([("1", f, t, i) for i, (f, t) in enumerate(given)],
                               "mid string, is_new string, ts bigint, arrival bigint")
    assert [r.is_new for r in repair_new_flag(df).orderBy("arrival").collect()] == want


def bounces_by_automaton(rows, within):
    out = []
    for mid in {r[0] for r in rows}:
        pending = None
        for r in sorted((r for r in rows if r[0] == mid), key=lambda r: (r[1], r[3])):
            if pending and (r[2] is None or r[1] - pending[1] >= within):
                out.append(pending)
            pending = r if r[2] is None else None
        if pending:
            out.append(pending)
    return sorted(out, key=lambda r: r[3])


@pytest.mark.parametrize("span", [None, 1000, 1700, 50_000])
def test_detect_bounce_random(spark, span):
    rnd = random.Random(span or 7)
    rows = [(str(rnd.randrange(5)), rnd.randrange(60_000), rnd.choice([None, "home"]), i) for i in range(600)]
    got = detect_bounce(spark.createDataFrame(rows, PAGE), within=1000, span=span).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[3]) == bounces_by_automaton(rows, 1000)


@pytest.mark.parametrize("given,want", [
    ([(0, None), (9999, "h")], []), ([(0, None), (10000, "h")], [0]), ([(0, None), (3000, None)], [0, 3000]),
    ([(0, None), (3000, None), (2000, "h")], [3000])])
def test_detect_bounce(spark, given, want):
    df = spark.createDataFrame([("1", t, last, i) for i, (t, last) in enumerate(given)], PAGE)
    for span in (10_000, 640_000):
        assert sorted(r.ts for r in detect_bounce(df, span=span).collect()) == want


def test_detect_bounce_span_too_short(spark):
    with pytest.raises(ValueError):
        detect_bounce(spark.createDataFrame([], PAGE), within=1000, span=999)


def test_first_visit_per_day(spark):
    df = spark.createDataFrame([("1", 0, None, 0), ("1", 50, None, 1), ("1", DAY, None, 2), ("1", 2 * DAY, "h", 3)], PAGE)
    assert sorted(r.arrival for r in first_visit_per_day(df).collect()) == [0, 2]


def first_visits_by_state(rows):
    state, out = {}, set()
    for mid, ts, last, _ in sorted(rows, key=lambda r: (r[1], r[3])):
        if last is None and state.get(mid) != ts // DAY:
            state[mid] = ts // DAY
            out.add((mid, ts // DAY))
    return out


def test_first_visit_random(spark):
    rnd = random.Random(5)
    rows = [(str(rnd.randrange(20)), rnd.randrange(5 * DAY), rnd.choice([None, "h"]), i) for i in range(400)]
    got = first_visit_per_day(spark.createDataFrame(rows, PAGE)).collect()
    assert {(r.mid, r.ts // DAY) for r in got} == first_visits_by_state(rows) and len(got) == len(first_visits_by_state(rows))


# ---- joins ----

LEFT = "id string, k string, lt string"
RIGHT = "rk string, v string, rt string"


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("ttl", [None, 0, 3, 17])
def test_retained_join_random(spark, how, ttl):
    rnd = random.Random(11)
    left = [(str(i), rnd.choice(["a", "b", "c", None]), str(rnd.randrange(200))) for i in range(120)]
    right = [(rnd.choice(["a", "b", "d", None]), str(i), str(rnd.randrange(200))) for i in range(60)]
    got = retained_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), [("k", "rk")],
                        how, ttl, "lt", "rt")
    assert got.columns == ["id", "k", "lt", "v", "rt"]
    want = []
    for i, k, lt in left:
        pairs = [(i, k, lt, v, rt) for rk, v, rt in right
                 if rk is not None and rk == k and (ttl is None or abs(int(lt) - int(rt)) <= ttl)]
        want += pairs or ([(i, k, lt, None, None)] if how == "left" else [])
    key = lambda row: tuple(x or "" for x in row)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_retained_join_arguments(spark):
    l, r = spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT)
    with pytest.raises(ValueError):
        retained_join(l, r, [("k", "rk")], "full")
    with pytest.raises(ValueError):
        retained_join(l, r, [("k", "rk")], ttl=5)


def test_lookup(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "z"), ("3", None)], "id string, code string")
    dic = spark.createDataFrame([("a", "Ay"), ("b", "Bee")], "dic_code string, dic_name string")
    for limit in (100, 1):       # broadcast, and too large to broadcast
        got = lookup_join(df, dic, "code", {"dic_name": "name"}, max_rows=limit)
        assert [tuple(r) for r in got.collect()] == [("1", "a", "Ay")]
        kept = lookup_join(df, dic, "code", {"dic_name": "name"}, how="left", max_rows=limit)
        assert kept.count() == 3


def test_two_roles(spark):
    df = spark.createDataFrame([("1", "a", "b"), ("2", "a", "z")], "id string, kind string, why string")
    dic = spark.createDataFrame([("a", "Ay"), ("b", "Bee")], "dic_code string, dic_name string")
    got = two_role_lookup(df, dic, {"kind": "kind_name", "why": "why_name"}).collect()
    assert [tuple(r) for r in got] == [("1", "a", "b", "Ay", "Bee")]


def test_bounds(spark):
    df = spark.range(10).select(F.lit("x" * 100).alias("t"))
    assert bounds.fits(df, 10, 10_000) and not bounds.fits(df, 9, 10_000) and not bounds.fits(df, 10, 500)
    assert bounds.fits(df.limit(0), 0, 0)


# ---- selection, configuration, upsert ----

CHANGE = "`table` string, type string, data map<string,string>, old map<string,string>, ts string"


def test_selection(spark):
    rows = [("a", t, {"id": t}, None, "1") for t in ("insert", "update", "delete", "bootstrap-insert", "bootstrap-start")]
    df = spark.createDataFrame([*rows, ("b", "insert", {"id": "x"}, None, "2")], CHANGE)
    assert {r.type for r in keep_types(df).collect()} == {"insert", "update", "bootstrap-insert"}
    got = select_table(df, "a", ["id", "missing"], ["insert"], keep={"ts": "at"}).collect()
    assert [tuple(r) for r in got] == [("insert", None, "1")]
    assert union_all(df, df, df).count() == 18


CONFIG = "struct<source_table:string,sink_table:string,sink_columns:string,sink_pk:string,sink_extend:string>"


def config_events(spark, *events):
    rows = []
    for n, (op, before, after) in enumerate(events):
        full = lambda e: (*e, "id,name", None, None) if e else None
        rows.append((op, full(before), full(after), n))
    return spark.createDataFrame(rows, f"op string, before {CONFIG}, after {CONFIG}, ts_ms bigint")


def test_current_config(spark):
    a_x, a_y, b_y = ("a", "x"), ("a", "y"), ("b", "y")
    now = lambda *e: sorted((r.source_table, r.sink_table) for r in current_config(config_events(spark, *e)).collect())
    assert now(("r", None, a_x)) == [("a", "x")]
    assert now(("r", None, a_x), ("u", a_x, a_y)) == [("a", "y")]
    assert now(("r", None, a_x), ("u", a_x, a_y), ("d", a_y, None)) == []
    assert now(("r", None, a_y), ("u", a_y, b_y)) == [("a", "y"), ("b", "y")]
    assert now(("d", a_x, None), ("c", None, a_x)) == [("a", "x")]


def test_route_by_config(spark):
    config = spark.createDataFrame([("a", "dim_a", "id,name", None, None), ("b", "dim_b", "k1,k2,v", "k1,k2", None)],
                                   "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string")
    df = spark.createDataFrame([("a", "insert", {"id": "1", "name": "n", "x": "y"}, None, "1"),
                                ("b", "insert", {"k1": "1", "k2": "2", "v": None}, None, "1"),
                                ("c", "insert", {"id": "1"}, None, "1")], CHANGE)
    for limit in (100, 1):
        got = {r.sink_table: r for r in route_by_config(df, config, max_rows=limit).collect()}
        assert set(got) == {"dim_a", "dim_b"}
        assert got["dim_a"].data == {"id": "1", "name": "n"} and got["dim_a"].pk == ["1"]
        assert got["dim_b"].data == {"k1": "1", "k2": "2", "v": None} and got["dim_b"].pk == ["1", "2"]
    assert [r["table"] for r in unrouted(df, config).collect()] == ["c"]


def test_latest_by_key(spark):
    df = spark.createDataFrame([("k", 1, "insert"), ("k", 3, "update"), ("k", 2, "update"), ("g", 1, "insert"), ("g", 2, "delete")],
                               "k string, n int, type string")
    assert sorted(tuple(r) for r in latest_by_key(df, ["k"], ["n"]).collect()) == [("g", 2, "delete"), ("k", 3, "update")]
    live = latest_by_key(df, ["k"], ["n"], deleted=F.col("type") == "delete")
    assert [r.k for r in live.collect()] == ["k"]


def test_latest_by_key_of_many_texts(spark):
    """Rows of many text columns come back as they were: nulls, empty texts, bytes that are no characters, any other type beside them."""
    from millrace.operators.upsert import PACKED_FROM, latest_by_key

    names = [f"t.{i}" for i in range(PACKED_FROM + 2)]
    rows = [("a", 1, *["old"] * len(names), {"x": "1"}), ("a", 2, None, "", "ä€", *[None] * (len(names) - 5), "x" * 70000, "y" * 126, None),
            (None, 5, *["n"] * len(names), {}), ("b", None, *[str(i) * i for i in range(len(names))], {"y": None})]
    schema = "k string, n int, " + ", ".join(f"`{n}` string" for n in names) + ", m map<string,string>"
    df = spark.createDataFrame(rows, schema).withColumn("t.0", F.when(F.col("k") == "b", F.expr("cast(x'ff00' as string)")).otherwise(F.col("`t.0`")))
    last = latest_by_key(df, ["K"], [F.coalesce("n", F.lit(0)), "`t.1`"])
    assert last.schema == df.schema
    got = {r[0]: r for r in last.withColumn("t.0", F.hex("`t.0`")).collect()}
    assert got.keys() == {"a", "b", None} and [tuple(got["a"])[2:]] == [rows[1][2:]] and got["a"][1] == 2
    assert got["b"][2] == "FF00" and tuple(got["b"])[3:] == rows[3][3:] and got[None][2] == "6E"
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "_text_bytes" in plan and "WindowGroupLimit" in plan
