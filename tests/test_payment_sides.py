from millrace import schemas
from millrace.plans import flows


def test_payments_are_the_repeated_side(spark, monkeypatch):
    """A band repeats the right rows: lines, which are many and wide, must stand on the left."""
    sides, joined = [], flows.retained_join

    def spy(left, right, *rest):
        sides.append((left.columns, right.columns))
        return joined(left, right, *rest)

    monkeypatch.setattr(flows, "retained_join", spy)
    paid = {"order_id": "1", "user_id": "7", "payment_type": "A", "payment_status": "1602", "callback_time": "2020-01-01 00:00:00"}
    rows = [("payment_info", "update", {**paid, "order_id": o}, {"payment_status": "1601"}, ts)
            for o, ts in (("1", "1000"), ("1", "1000"), ("2", "9000"), (None, "1000"))]
    changes = spark.createDataFrame(rows, "table string, type string, data map<string,string>, old map<string,string>, ts string")
    columns = [c for c in schemas.ORDER_DETAIL_COLUMNS]
    lines = [{"id": "l1", "order_id": "1", "user_id": "7", "ts": "995"}, {"id": "l2", "order_id": "1", "ts": "5000"},
             {"id": "l3", "order_id": "2", "ts": "8999"}, {"id": "l4", "order_id": None, "ts": "1000"}]
    detail = spark.createDataFrame([tuple(x.get(c) for c in columns) for x in lines], ", ".join(f"{c} string" for c in columns))
    names = spark.createDataFrame([("A", "Card")], "dic_code string, dic_name string")
    for ttl, want in ((schemas.PAYMENT_JOIN_TTL, ["l1", "l1", "l3"]), (None, ["l1", "l1", "l2", "l2", "l3"])):
        got = flows.payment_success(changes, detail, names, ttl=ttl).collect()
        assert sorted(r.order_detail_id for r in got) == want
        assert {(r.order_detail_id, r.order_id, r.user_id, r.ts) for r in got if r.order_detail_id == "l1"} == {("l1", "1", "7", "1000")}
    assert all("id" not in r and "paid_order_id" in r and "order_detail_id" in l for l, r in sides)
