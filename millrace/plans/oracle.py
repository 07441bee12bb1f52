"""The same results in SQL, written from the definitions rather than from the Spark plans."""

MONEY = "CAST(CAST({} AS DECIMAL(16,2)) AS VARCHAR)"
CLOCK = "strftime({}, '%Y-%m-%d %H:%M:%S')"

DIC = """dic(code, name) AS (VALUES ('R','Returned'),('N','None'),('O','Open'),('F','Filled'),
  ('1-URGENT','Urgent'),('2-HIGH','High'),('3-MEDIUM','Medium'))"""

ITEMS = """ord AS (SELECT *, CAST(epoch(o_orderdate) AS BIGINT) AS t0 FROM orders),
item AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line
  FROM lineitem JOIN ord ON l_orderkey = o_orderkey)"""

INFO = """info AS (
  SELECT o_orderkey, o_custkey, '1001' AS status, NULL AS operated, 'insert' AS type, t0 + o_orderkey % 10 AS sec FROM ord
  UNION ALL
  SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'F' THEN '1003' ELSE '1005' END,
    o_orderdate + INTERVAL 1 HOUR, 'update', t0 + 3600 FROM ord WHERE o_orderstatus IN ('F','P')
  UNION ALL
  SELECT o_orderkey, o_custkey, '1006', o_orderdate + INTERVAL 1 HOUR, 'update', t0 + 7200
  FROM ord WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0)"""

ACT = """act AS (SELECT line AS act_line, CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) AS activity
  FROM item WHERE l_discount >= 0.05)"""

COU = "cou AS (SELECT line AS cou_line, CAST(l_linenumber AS VARCHAR) AS coupon FROM item WHERE l_tax >= 0.06)"

WIDE = f"""{ACT}, {COU}, wide AS (
  SELECT line AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(info.o_custkey AS VARCHAR) AS user_id,
    status AS order_status, CAST(l_partkey AS VARCHAR) AS sku_id, p_name AS sku_name,
    CAST(info.o_custkey % 34 + 1 AS VARCHAR) AS province_id,
    activity AS activity_id, activity AS activity_rule_id, coupon AS coupon_id,
    strftime(o_orderdate, '%Y-%m-%d') AS date_id, {CLOCK.format('o_orderdate')} AS create_time,
    strftime(operated, '%Y-%m-%d') AS operate_date_id, {CLOCK.format('operated')} AS operate_time,
    CAST(l_suppkey AS VARCHAR) AS source_id, l_returnflag AS source_type, name AS source_type_name,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num,
    CAST(CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(16,2)) * CAST(p_retailprice AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount,
    CAST(NULL AS VARCHAR) AS split_activity_amount, CAST(NULL AS VARCHAR) AS split_coupon_amount,
    {MONEY.format('l_extendedprice')} AS split_total_amount, type,
    CAST(t0 AS VARCHAR) AS od_ts, CAST(sec AS VARCHAR) AS oi_ts
  FROM item JOIN info ON l_orderkey = info.o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN dic ON l_returnflag = code
  LEFT JOIN act ON line = act_line LEFT JOIN cou ON line = cou_line)"""

ORDER = f"WITH {DIC}, {ITEMS}, {INFO}, {WIDE}"

LINE_COLUMNS = """id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id"""
SPLIT_COLUMNS = """sku_num, split_original_amount, split_activity_amount, split_coupon_amount"""

ORDER_DETAIL = f"""{ORDER} SELECT {LINE_COLUMNS}, date_id, create_time, source_id, source_type AS source_type_code,
  source_type_name, {SPLIT_COLUMNS}, split_total_amount, od_ts AS ts FROM wide WHERE type = 'insert'"""


def _payment(band):
    return f"""{ORDER} SELECT id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id,
  activity_rule_id, coupon_id, o_orderpriority AS payment_type_code, name AS payment_type_name,
  {CLOCK.format('o_orderdate + to_seconds(o_orderkey % 1800)')} AS callback_time, source_id,
  source_type AS source_type_code, source_type_name, {SPLIT_COLUMNS}, split_total_amount AS split_payment_amount,
  CAST(t0 + o_orderkey % 1800 AS VARCHAR) AS ts
FROM wide JOIN ord ON order_id = CAST(o_orderkey AS VARCHAR) JOIN dic ON o_orderpriority = code
WHERE type = 'insert' AND o_orderstatus IN ('F','P') {band}"""


EVENT = """ev AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, event_type, epoch_us(ts) // 1000 AS ms, CAST(ts AS DATE) AS day,
    CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS flag,
    CASE WHEN event_type NOT IN ('view','signup') THEN 'home' END AS last_page_id,
    CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS shown
  FROM events)"""

# The first record of a visitor fixes the day; later records with flag 1 on another day lose it.
FLAGS = f"""{EVENT}, fixed AS (
  SELECT mid, CASE WHEN flag = '1' THEN day ELSE day - 1 END AS visit_day FROM ev
  QUALIFY row_number() OVER (PARTITION BY mid ORDER BY event_id) = 1),
rec AS (SELECT ev.*, CASE WHEN flag = '1' AND day <> visit_day THEN '0' ELSE flag END AS is_new
  FROM ev JOIN fixed USING (mid))"""

WITH_LOG = f"WITH {FLAGS}"
SIX_HOURS = 6 * 3600 * 1000


def _bounce(rows, columns):
    """A start bounces unless a non-start is its next record and comes within the limit."""
    return f"""WITH {EVENT}, r AS (SELECT * FROM ev WHERE {rows}),
n AS (SELECT *, lead(ms) OVER w AS next_ms, lead(last_page_id) OVER w AS next_last, lead(event_id) OVER w AS next_id
  FROM r WINDOW w AS (PARTITION BY mid ORDER BY ms, event_id))
SELECT {columns} FROM n WHERE last_page_id IS NULL
  AND (next_id IS NULL OR next_last IS NULL OR next_ms - ms >= {SIX_HOURS})"""


PAGE_ROW = "mid, {} AS is_new, event_type AS page_id, last_page_id, ms AS ts, event_id AS arrival"

REQUESTS = """request AS (
  SELECT *, 'insert' AS type, t0 + 3600 AS sec FROM item WHERE o_orderstatus = 'P' AND l_returnflag = 'R'
  UNION ALL
  SELECT *, 'update', t0 + 3601 FROM item WHERE o_orderstatus = 'P' AND l_returnflag = 'R' AND l_linenumber = 1),
refund AS (SELECT * FROM item WHERE o_orderstatus = 'P' AND l_returnflag = 'R' AND l_orderkey % 2 = 0)"""

CART = """cart AS (
  SELECT *, CASE WHEN l_linenumber = 1 THEN 'insert' ELSE 'update' END AS type,
    CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS INTEGER)
         ELSE CAST(l_quantity AS INTEGER) - l_linenumber END AS added
  FROM item WHERE l_linenumber = 1 OR CAST(l_quantity AS INTEGER) > l_linenumber)"""

CART_ADD = f"""WITH {DIC}, {ITEMS}, {CART}
SELECT line AS id, CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS sku_id,
  CAST(l_suppkey AS VARCHAR) AS source_id, l_returnflag AS source_type_id, name AS source_type_name,
  CAST(added AS VARCHAR) AS sku_num, CAST(t0 AS VARCHAR) AS ts
FROM cart JOIN dic ON l_returnflag = code"""

CONFIG = """WITH c AS (
  SELECT *, 't' || CAST(user_id AS VARCHAR) AS source_table,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
SELECT source_table, 'dim_' || CAST(event_id AS VARCHAR) AS sink_table, 'id,name' AS sink_columns, 'id' AS sink_pk,
  event_type AS sink_extend
FROM c WHERE n = 1 AND event_type <> 'error'"""

MASTER = """master AS (
  SELECT 'customer' AS tab, 'bootstrap-insert' AS type, 100 AS sec, CAST(c_custkey AS VARCHAR) AS id, c_name,
    CAST(NULL AS VARCHAR) AS p_name, CAST(NULL AS VARCHAR) AS p_brand FROM customer
  UNION ALL SELECT 'customer', 'update', 200, CAST(c_custkey AS VARCHAR), c_name || ' (moved)', NULL, NULL
    FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT 'customer', 'delete', 300, CAST(c_custkey AS VARCHAR), c_name, NULL, NULL
    FROM customer WHERE c_mktsegment = 'FURNITURE'
  UNION ALL SELECT 'part', 'insert', 100, CAST(p_partkey AS VARCHAR), NULL, p_name, p_brand FROM part
  UNION ALL SELECT 'part', 'update', 99, CAST(p_partkey AS VARCHAR), NULL, p_name, 'stale' FROM part WHERE p_size > 25
  UNION ALL SELECT 'supplier', 'insert', 100, CAST(s_suppkey AS VARCHAR), NULL, NULL, NULL FROM supplier)"""

CHANGE_ROWS = f"""WITH {ITEMS}, {INFO}, {REQUESTS}, chg AS (
  SELECT 'order_detail' AS "table", 'insert' AS type, t0 AS sec, line AS id, l_orderkey AS order_id, 12 AS members, NULL AS before FROM item
  UNION ALL SELECT 'order_info', type, sec, CAST(o_orderkey AS VARCHAR), NULL, 5,
    CASE WHEN type = 'update' THEN CASE status WHEN '1006' THEN '1005' ELSE '1001' END END FROM info
  UNION ALL SELECT 'order_detail_activity', 'insert', t0, line, NULL, 3, NULL FROM item WHERE l_discount >= 0.05
  UNION ALL SELECT 'order_detail_coupon', 'insert', t0, line, NULL, 2, NULL FROM item WHERE l_tax >= 0.06
  UNION ALL SELECT 'payment_info', 'update', t0 + o_orderkey % 1800, NULL, o_orderkey, 5, NULL FROM ord WHERE o_orderstatus IN ('F','P')
  UNION ALL SELECT 'payment_info', 'insert', t0, NULL, o_orderkey, 5, NULL FROM ord WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'order_refund_info', type, sec, line, l_orderkey, 10, NULL FROM request
  UNION ALL SELECT 'refund_payment', 'update', t0 + 7200, line, l_orderkey, 7, NULL FROM refund
  UNION ALL SELECT 'cart_info', CASE WHEN l_linenumber = 1 THEN 'insert' ELSE 'update' END, t0, line, NULL, 6,
    CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber AS VARCHAR) END FROM item WHERE l_linenumber >= 1)
SELECT "table", type, CAST(sec AS VARCHAR) AS ts, id, CAST(order_id AS VARCHAR) AS order_id, members, before FROM chg"""

ORACLE = {
    "order_wide": f"{ORDER} SELECT * FROM wide",
    "order_detail": ORDER_DETAIL,
    "order_cancel": f"""{ORDER} SELECT {LINE_COLUMNS}, operate_date_id AS date_id, operate_time AS cancel_time, source_id,
  source_type AS source_type_code, source_type_name, {SPLIT_COLUMNS}, split_total_amount, oi_ts AS ts
FROM wide WHERE type = 'update' AND order_status = '1003'""",
    "cart_add": CART_ADD,
    "cart_add_from_text": CART_ADD,
    "payment_success": _payment(""),
    "payment_success_band": _payment("AND o_orderkey % 1800 <= 905"),
    "order_refund": f"""WITH {DIC}, {ITEMS}, {REQUESTS}
SELECT line AS id, CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id,
  CAST(l_partkey AS VARCHAR) AS sku_id, CAST(o_custkey % 34 + 1 AS VARCHAR) AS province_id,
  strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%d') AS date_id, {CLOCK.format('o_orderdate + INTERVAL 1 HOUR')} AS create_time,
  l_linestatus AS refund_type_code, t.name AS refund_type_name, l_returnflag AS refund_reason_type_code,
  r.name AS refund_reason_type_name, CAST(NULL AS VARCHAR) AS refund_reason_txt,
  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS refund_num, {MONEY.format('l_extendedprice')} AS refund_amount,
  CAST(sec AS VARCHAR) AS ts
FROM request JOIN dic t ON l_linestatus = t.code JOIN dic r ON l_returnflag = r.code WHERE type = 'insert'""",
    "refund_success": f"""WITH {DIC}, {ITEMS}, {REQUESTS}
SELECT f.line AS id, CAST(f.o_custkey AS VARCHAR) AS user_id, CAST(f.l_orderkey AS VARCHAR) AS order_id,
  CAST(f.l_partkey AS VARCHAR) AS sku_id, CAST(f.o_custkey % 34 + 1 AS VARCHAR) AS province_id,
  f.o_orderpriority AS payment_type_code, name AS payment_type_name,
  strftime(f.o_orderdate + INTERVAL 2 HOUR, '%Y-%m-%d') AS date_id, {CLOCK.format('f.o_orderdate + INTERVAL 2 HOUR')} AS callback_time,
  CAST(CAST(q.l_quantity AS INTEGER) AS VARCHAR) AS refund_num, {MONEY.format('f.l_extendedprice')} AS refund_amount,
  CAST(f.t0 + 7200 AS VARCHAR) AS ts
FROM refund f JOIN request q ON f.l_orderkey = q.l_orderkey AND f.l_partkey = q.l_partkey
JOIN dic ON f.o_orderpriority = code""",
    "dimensions": f"""WITH {MASTER} SELECT 'dim_' || tab AS sink_table, CAST(sec AS BIGINT) AS change_ts, id, c_name, p_name, p_brand
FROM master WHERE type <> 'delete' AND tab IN ('customer','part')
QUALIFY row_number() OVER (PARTITION BY tab, id ORDER BY sec DESC) = 1""",
    "log_page": f"""{WITH_LOG} SELECT mid, is_new, event_type AS page_id, last_page_id, ms AS ts, 3 AS members
FROM rec WHERE event_type <> 'signup'""",
    "log_start": f"{WITH_LOG} SELECT mid, is_new, 'icon' AS entry, ms AS ts FROM rec WHERE event_type = 'signup'",
    "log_display": f"""{WITH_LOG} SELECT mid, is_new, event_type AS page_id, event_type AS item, ms AS ts
FROM rec, range(shown) WHERE event_type <> 'signup'""",
    "log_action": f"""{WITH_LOG} SELECT mid, event_type AS page_id, 'tap' AS action_id, ms AS ts
FROM rec WHERE event_type = 'click'""",
    "log_error": f"""{WITH_LOG} SELECT mid, '500' AS error_code, event_type AS page_id, ms AS ts, shown AS n_displays
FROM rec WHERE event_type = 'error'""",
    "log_split": f"""WITH {EVENT}
SELECT event_id AS arrival, 'page' AS target, ms AS ts FROM ev WHERE event_type <> 'signup'
UNION ALL SELECT event_id, 'start', ms FROM ev WHERE event_type = 'signup'
UNION ALL SELECT event_id, 'display', ms FROM ev, range(shown) WHERE event_type <> 'signup'
UNION ALL SELECT event_id, 'action', ms FROM ev WHERE event_type = 'click'
UNION ALL SELECT event_id, 'error', ms FROM ev WHERE event_type = 'error'""",
    "unique_visitor": f"""WITH {EVENT} SELECT mid, ms AS ts, event_id AS arrival, event_type AS page_id FROM ev
WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY mid, day ORDER BY ms, event_id) = 1""",
    "user_jump": _bounce("event_type <> 'signup'", "mid, ms AS ts, event_id AS arrival, event_type AS page_id"),
    "retained_join_band": f"""WITH {ITEMS}, {INFO}
SELECT line AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(t0 AS VARCHAR) AS od_ts, status AS order_status,
  CAST(sec AS VARCHAR) AS oi_ts
FROM item JOIN info ON l_orderkey = info.o_orderkey WHERE abs(t0 - sec) <= 5""",
    "left_join_pad": f"""WITH {ITEMS}, {ACT}
SELECT line AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(t0 AS VARCHAR) AS od_ts, activity AS activity_id,
  activity AS activity_rule_id
FROM item LEFT JOIN act ON line = act_line""",
    "left_join_pad_band": f"""WITH {ITEMS}
SELECT line AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(i.t0 AS VARCHAR) AS od_ts,
  {CLOCK.format('p.o_orderdate + to_seconds(p.o_orderkey % 1800)')} AS callback_time,
  CAST(p.t0 + p.o_orderkey % 1800 AS VARCHAR) AS pi_ts
FROM item i LEFT JOIN ord p ON l_orderkey = p.o_orderkey AND p.o_orderstatus IN ('F','P') AND p.o_orderkey % 1800 <= 900""",
    "composite_join": f"""WITH {ITEMS}, {REQUESTS}
SELECT f.line AS id, CAST(f.l_orderkey AS VARCHAR) AS order_id, CAST(f.l_partkey AS VARCHAR) AS sku_id,
  CAST(f.t0 + 7200 AS VARCHAR) AS ts, CAST(CAST(q.l_quantity AS INTEGER) AS VARCHAR) AS refund_num, q.type AS request_type
FROM refund f JOIN request q ON f.l_orderkey = q.l_orderkey AND f.l_partkey = q.l_partkey""",
    "two_role_lookup": f"""WITH {DIC}, {ITEMS}, {REQUESTS}
SELECT line AS id, l_linestatus AS refund_type, l_returnflag AS refund_reason_type, t.name AS type_name, r.name AS reason_name
FROM request JOIN dic t ON l_linestatus = t.code JOIN dic r ON l_returnflag = r.code WHERE type = 'insert'""",
    "route_by_config": f"""WITH {MASTER} SELECT 'dim_' || tab AS sink_table, type, CAST(sec AS VARCHAR) AS ts, id AS pk, c_name, p_name,
  p_brand, CASE tab WHEN 'customer' THEN 2 ELSE 3 END AS members
FROM master WHERE type <> 'delete' AND tab IN ('customer','part')""",
    "unrouted": f"""WITH {MASTER} SELECT tab AS "table", id FROM master WHERE tab = 'supplier'""",
    "current_config": CONFIG,
    "latest_by_key": f"""{ORDER} SELECT * FROM wide
QUALIFY row_number() OVER (PARTITION BY id ORDER BY CAST(oi_ts AS BIGINT) DESC, split_total_amount DESC,
  sku_num DESC, coalesce(activity_id, '') DESC, coalesce(coupon_id, '') DESC) = 1""",
    "first_visit_per_day": f"""WITH {EVENT} SELECT {PAGE_ROW.format('flag')} FROM ev WHERE last_page_id IS NULL
QUALIFY row_number() OVER (PARTITION BY mid, day ORDER BY ms, event_id) = 1""",
    "detect_bounce": _bounce("true", PAGE_ROW.format("flag")),
    "repair_new_flag": f"{WITH_LOG} SELECT {PAGE_ROW.format('is_new')} FROM rec".replace("is_new AS is_new", "is_new"),
    "session_start": f"""WITH {EVENT} SELECT mid, event_type AS page_id, ms AS ts, event_id AS arrival
FROM ev WHERE last_page_id IS NULL""",
    "assign_event_time": f"WITH {EVENT} SELECT event_id AS arrival, ms AS event_ms, ms AS ts FROM ev",
    "union_all": f"WITH {EVENT} SELECT mid, event_type AS page_id, ms AS ts, event_id AS arrival FROM ev",
    "dirty_good": f"WITH {EVENT} SELECT mid, ms AS ts, event_id AS arrival FROM ev WHERE event_id % 97 <> 0",
    "dirty_bad": "SELECT '{bad' AS value, event_id AS arrival FROM events WHERE event_id % 97 = 0",
    "keep_types": f"""WITH {MASTER} SELECT tab AS "table", type, CAST(sec AS VARCHAR) AS ts, id FROM master WHERE type <> 'delete'""",
    "status_changed": f"""WITH {ITEMS}, {INFO} SELECT CAST(o_orderkey AS VARCHAR) AS id, status AS order_status,
  CAST(sec AS VARCHAR) AS ts FROM info WHERE type = 'update' AND status = '1005'""",
    "increase": f"WITH {ITEMS}, {CART} SELECT line AS id, type, CAST(added AS VARCHAR) AS sku_num FROM cart",
    "line_amount": f"""WITH {ITEMS} SELECT line AS id,
  CAST(CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(16,2)) * CAST(p_retailprice AS DECIMAL(16,2)) AS VARCHAR) AS amount
FROM item LEFT JOIN part ON l_partkey = p_partkey""",
    "date_id": f"""WITH {ITEMS}, {INFO} SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(sec AS VARCHAR) AS ts,
  strftime(operated, '%Y-%m-%d') AS operate_date_id FROM info""",
    "event_time": """SELECT event_id AS arrival, strftime(ts, '%Y-%m-%d') AS day,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day_east, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS time_east,
  epoch_ms(date_trunc('second', ts)) AS back_ms, epoch_ms(date_trunc('day', ts)) AS midnight_ms FROM events""",
    "keep_columns": f"""WITH {MASTER} SELECT type, id, c_name, CAST(NULL AS VARCHAR) AS c_mktsegment, 2 AS members
FROM master WHERE tab = 'customer'""",
    "read_changes": CHANGE_ROWS,
    "read_config_changes": CONFIG,
    "read_detail": ORDER_DETAIL,
    "upsert_dimensions": f"""WITH {MASTER} SELECT 'dim_' || tab AS sink_table, id, c_name, p_name, p_brand
FROM master WHERE type <> 'delete' AND tab IN ('customer','part')
QUALIFY row_number() OVER (PARTITION BY tab, id ORDER BY sec DESC) = 1""",
    "write_upsert": f"""WITH {ITEMS}, {INFO} SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
  status AS order_status, CAST(sec AS VARCHAR) AS ts FROM info
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY sec DESC) = 1""",
    "stream_cart_add": CART_ADD,
    "stream_log_split": f"""{WITH_LOG}
SELECT event_id AS arrival, 'page' AS target, is_new, ms AS ts FROM rec WHERE event_type <> 'signup'
UNION ALL SELECT event_id, 'start', is_new, ms FROM rec WHERE event_type = 'signup'
UNION ALL SELECT event_id, 'display', is_new, ms FROM rec, range(shown) WHERE event_type <> 'signup'
UNION ALL SELECT event_id, 'action', is_new, ms FROM rec WHERE event_type = 'click'
UNION ALL SELECT event_id, 'error', is_new, ms FROM rec WHERE event_type = 'error'""",
    "stream_unique_visitor": f"""WITH {EVENT} SELECT DISTINCT mid, strftime(day, '%Y-%m-%d') AS day
FROM ev WHERE last_page_id IS NULL""",
    # What the watermark, two seconds behind the newest record, has not passed is not decided yet.
    "stream_user_jump": f"""WITH {EVENT}, mark AS (SELECT max(ms) - 2000 AS wm FROM ev),
n AS (SELECT *, lead(ms) OVER w AS next_ms, lead(last_page_id) OVER w AS next_last
  FROM ev WINDOW w AS (PARTITION BY mid ORDER BY ms, event_id))
SELECT mid, ms AS ts, event_id AS arrival, event_type AS page_id FROM n, mark
WHERE last_page_id IS NULL AND ms <= wm AND CASE WHEN next_ms <= wm
  THEN next_last IS NULL OR next_ms - ms >= {SIX_HOURS} ELSE ms + {SIX_HOURS} <= wm END""",
}
ORACLE["fan_out"] = f"SELECT target, ts FROM ({ORACLE['log_split']})"
ORACLE["stream_retained_join"] = ORACLE["retained_join_band"]
ORACLE |= {f"stream_{name}": ORACLE[name] for name in ("order_refund", "refund_success")}
ORACLE["stream_log_dirty"] = ORACLE["dirty_bad"]
ORACLE["stream_dimensions"] = ORACLE["upsert_dimensions"]
ORACLE |= {name: ORACLE["write_upsert"] for name in ("compact_upsert", "stream_upsert")}
ORACLE |= {name: ORACLE["upsert_dimensions"] for name in ("compact_dimensions", "publish_dimension")}
ORACLE |= {name: f"""WITH {MASTER}, last AS (SELECT * FROM master WHERE tab = 'customer'
QUALIFY row_number() OVER (PARTITION BY id ORDER BY sec DESC) = 1)
SELECT id, c_name FROM last WHERE type <> 'delete'""" for name in ("upsert_with_deletes", "topic_with_deletes")}
ORACLE["stream_left_join_early"] = f"""SELECT id, order_id, od_ts, max(activity_id) AS activity_id, max(activity_rule_id) AS activity_rule_id
FROM ({ORACLE['left_join_pad']}) GROUP BY id, order_id, od_ts"""
ORACLE["stream_unrouted"] = ORACLE["unrouted"]
ORACLE["changes_dirty"] = """SELECT CASE o_orderkey % 97 WHEN 5 THEN 'untimed' WHEN 7 THEN 'unreadable' ELSE 'change' END AS outcome,
  CAST(o_orderkey AS VARCHAR) AS id FROM orders"""
ORACLE["read_log"] = f"WITH {EVENT} SELECT mid, ms AS ts FROM ev"
ORACLE["read_lookup"] = """SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS code, n_name AS nation
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
