"""Independent SQL oracle (DuckDB dialect) for every registered query.

The SQL states the fixture rules directly on the given tables (no maps, no
JSON round trip) and then the job semantics with window functions, so it
checks the whole Spark path: fixture, change-record extraction, joins,
state operators and windows.
"""

from __future__ import annotations

FMT = "'%Y-%m-%d %H:%M:%S'"


def _money(cents: str) -> str:
    return f"CAST(CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(16,2)) AS VARCHAR)"


def _ts_text(sec: str) -> str:
    return f"strftime(epoch_ms(CAST({sec} AS BIGINT) * 1000), {FMT})"


def _labels(w: str = "w", size_ms: int = 10000) -> str:
    return (f"strftime(epoch_ms({w}), {FMT}) AS stt, strftime(epoch_ms({w} + {size_ms}), {FMT}) AS edt, "
            f"strftime(epoch_ms({w}), '%Y%m%d') AS cur_date")


def _win(ms: str, size_ms: int = 10000) -> str:
    return f"(({ms}) // {size_ms}) * {size_ms}"


def _text_date(x: str) -> str:
    return f"strftime(TRY_CAST({x} AS TIMESTAMP), '%Y-%m-%d')"


# ------------------------------------------------------------- fixture CTEs --
EV = """ev AS (
  SELECT event_id, user_id, event_type, value, ts AS ets,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS ts_ms, epoch_us(ts) // 1000000 AS esec
  FROM events)"""

PAGE = """page AS (
  SELECT e.event_id AS seq, e.k, e.event_type,
         CAST(e.user_id AS VARCHAR) AS mid, CAST(e.user_id AS VARCHAR) AS uid,
         'v' || CAST(e.k % 3 AS VARCHAR) AS vc, 'c' || CAST(e.k % 4 AS VARCHAR) AS ch,
         'a' || CAST(e.user_id % 5 AS VARCHAR) AS ar,
         CASE WHEN e.k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
         CASE e.event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
              ELSE e.event_type END AS page_id,
         CASE e.event_type WHEN 'error' THEN 'login' WHEN 'purchase' THEN 'search'
              WHEN 'click' THEN 'home' END AS last_page_id,
         CASE WHEN e.event_type = 'purchase' THEN CASE WHEN e.event_id % 5 = 0 THEN '苹果手机红色 ' ELSE '' END || p.p_name
         END AS item,
         CASE WHEN e.event_type = 'purchase' THEN 'keyword' END AS item_type,
         CAST(round(e.value * 100) AS BIGINT) AS during_time,
         e.ts_ms AS ts
  FROM ev e LEFT JOIN part p
    ON e.event_type = 'purchase' AND p.p_partkey = e.event_id % (SELECT count(*) FROM part))"""

PAGE_COLS = "mid, uid, vc, ch, ar, is_new, page_id, last_page_id, item, item_type, during_time, ts"

# T1 over the clean raw-log records (every event except k = 99).
FIXED = """clean AS (SELECT * FROM page WHERE k <> 99),
first_rec AS (
  SELECT mid, CASE WHEN is_new = '1' THEN CAST(epoch_ms(ts) AS DATE)
                   ELSE CAST(epoch_ms(ts) AS DATE) - 1 END AS first_dt
  FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, seq) AS rn FROM clean)
  WHERE rn = 1),
fixed AS (
  SELECT c.* EXCLUDE (is_new),
         CASE WHEN c.is_new = '1' AND CAST(epoch_ms(c.ts) AS DATE) = f.first_dt THEN '1' ELSE '0' END
           AS is_new
  FROM clean c JOIN first_rec f USING (mid))"""

ORD = """ord AS (
  SELECT o.*, c.c_nationkey AS province, epoch_ms(o.o_orderdate) // 1000 AS osec,
         split_part(o.o_orderpriority, '-', 1) AS prio_code
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""

DIC = """dic AS (
  SELECT DISTINCT split_part(o_orderpriority, '-', 1) AS dic_code,
         substr(o_orderpriority, instr(o_orderpriority, '-') + 1) AS dic_name
  FROM orders)"""

LINES = """lines AS (
  SELECT l.*, o.o_custkey, o.o_orderdate AS odate, epoch_ms(o.o_orderdate) // 1000 AS osec,
         split_part(o.o_orderpriority, '-', 1) AS prio_code,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-' ||
         CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) || '-' ||
         strftime(l.l_shipdate, '%Y%m%d') AS od_id,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS price_cents,
         CAST(round(l.l_discount * 100) AS BIGINT) AS disc_pct,
         CAST(round(l.l_tax * 100) AS BIGINT) AS tax_pct,
         CAST(l.l_quantity AS BIGINT) AS qty
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

OI = f"""oi AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS oi_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(province AS VARCHAR) AS province_id, CAST(NULL AS VARCHAR) AS operate_time,
         '1001' AS order_status, 'insert' AS type, CAST(NULL AS VARCHAR) AS old,
         osec AS oi_sec, {_money('round(o_totalprice * 100)')} AS total_amount
  FROM ord
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), CAST(province AS VARCHAR),
         strftime(o_orderdate + INTERVAL 1 HOUR, {FMT}),
         CASE WHEN o_orderstatus = 'F' THEN '1003' ELSE '1005' END, 'update',
         '{{"order_status":"1001"}}', osec + 3600, {_money('round(o_totalprice * 100)')}
  FROM ord WHERE o_orderstatus IN ('F', 'P'))"""

OD = f"""od AS (
  SELECT od_id AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         'sku-' || CAST(l_partkey AS VARCHAR) AS sku_name, strftime(odate, {FMT}) AS create_time,
         CAST(l_suppkey AS VARCHAR) AS source_id, prio_code AS source_type,
         CAST(qty AS VARCHAR) AS sku_num, {_money('price_cents // nullif(qty, 0)')} AS order_price,
         {_money('price_cents')} AS split_total_amount,
         CASE WHEN l_returnflag = 'R' THEN {_money('price_cents * disc_pct // 100')} END
           AS split_activity_amount,
         CASE WHEN l_returnflag = 'A' THEN {_money('price_cents * tax_pct // 100')} END
           AS split_coupon_amount,
         osec AS od_sec,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey % 7 + 1 AS VARCHAR) END AS activity_id,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey % 3 + 1 AS VARCHAR) END AS activity_rule_id,
         CASE WHEN l_returnflag = 'A' THEN CAST(l_suppkey % 11 + 1 AS VARCHAR) END AS coupon_id
  FROM lines)"""

CHG = f"""chg AS (
  SELECT od.id, od.order_id, oi.user_id, oi.order_status, od.sku_id, od.sku_name, oi.province_id,
         od.activity_id, od.activity_rule_id, od.coupon_id,
         {_text_date('od.create_time')} AS date_id, od.create_time,
         {_text_date('oi.operate_time')} AS operate_date_id, oi.operate_time,
         od.source_id, od.source_type, dic.dic_name AS source_type_name, od.sku_num,
         CAST(CAST(od.sku_num AS DECIMAL(16,2)) * CAST(od.order_price AS DECIMAL(16,2)) AS VARCHAR)
           AS split_original_amount,
         od.split_activity_amount, od.split_coupon_amount, od.split_total_amount,
         oi.type, oi.old, CAST(od.od_sec AS VARCHAR) AS od_ts, CAST(oi.oi_sec AS VARCHAR) AS oi_ts,
         greatest(od.od_sec, oi.oi_sec) AS op_sec
  FROM od JOIN oi ON od.order_id = oi.oi_id JOIN dic ON od.source_type = dic.dic_code)"""

TOD = f"""tod AS (
  SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id,
         coupon_id, date_id, create_time, source_id, source_type AS source_type_code,
         source_type_name, sku_num, split_original_amount, split_activity_amount,
         split_coupon_amount, split_total_amount, od_ts AS ts, op_sec
  FROM chg WHERE type = 'insert')"""

PAY = f"""pi AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, prio_code AS code, '1602' AS status,
         strftime(o_orderdate + INTERVAL 2 HOUR, {FMT}) AS callback_time, osec + 7200 AS sec
  FROM ord WHERE o_orderstatus IN ('F', 'O')
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CAST(CAST(prio_code AS INT) % 5 + 1 AS VARCHAR), '1603',
         strftime(o_orderdate + INTERVAL 3 HOUR, {FMT}), osec + 10800
  FROM ord WHERE o_orderstatus IN ('F', 'O') AND o_orderkey % 3 = 0),
pay AS (
  SELECT tod.id AS order_detail_id, tod.order_id, tod.user_id, tod.sku_id, tod.sku_name,
         tod.province_id, tod.activity_id, tod.activity_rule_id, tod.coupon_id,
         pi.code AS payment_type_code, dic.dic_name AS payment_type_name, pi.callback_time, pi.status,
         tod.source_id, tod.source_type_code, tod.source_type_name, tod.sku_num,
         tod.split_original_amount, tod.split_activity_amount, tod.split_coupon_amount,
         tod.split_total_amount AS split_payment_amount, CAST(pi.sec AS VARCHAR) AS ts,
         tod.op_sec
  FROM tod JOIN pi ON tod.order_id = pi.order_id JOIN dic ON pi.code = dic.dic_code)"""

REFUND = f"""refund AS (
  SELECT l.od_id AS id, CAST(l.o_custkey AS VARCHAR) AS user_id, CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CAST(l.l_partkey AS VARCHAR) AS sku_id, oi.province_id,
         strftime(l.odate + INTERVAL 1 HOUR, '%Y-%m-%d') AS date_id,
         strftime(l.odate + INTERVAL 1 HOUR, {FMT}) AS create_time,
         l.prio_code AS refund_type_code, d1.dic_name AS refund_type_name,
         l.prio_code AS refund_reason_type_code, d2.dic_name AS refund_reason_type_name,
         'reason ' || CAST(l.l_linenumber AS VARCHAR) AS refund_reason_txt,
         CAST(l.qty AS VARCHAR) AS refund_num, {_money('l.price_cents')} AS refund_amount,
         CAST(l.osec + 3600 AS VARCHAR) AS ts, greatest(l.osec + 3600, oi.oi_sec) AS op_sec
  FROM lines l
  JOIN oi ON CAST(l.l_orderkey AS VARCHAR) = oi.oi_id AND oi.type = 'update' AND oi.order_status = '1005'
  JOIN dic d1 ON l.prio_code = d1.dic_code
  JOIN dic d2 ON l.prio_code = d2.dic_code
  WHERE l.l_returnflag = 'R')"""

CART = """cart AS (
  SELECT CAST(e.event_id AS VARCHAR) AS id, CAST(e.user_id AS VARCHAR) AS user_id,
         CAST(e.k AS VARCHAR) AS sku_id, CAST(e.event_id % 50 AS VARCHAR) AS source_id,
         CAST(e.k % 6 + 1 AS VARCHAR) AS source_type_code, dic.dic_name AS source_type_name,
         CASE WHEN e.event_type = 'purchase' THEN CAST(CAST(round(e.value) AS BIGINT) AS VARCHAR)
              ELSE CAST(CAST(CAST(round(e.value) AS BIGINT) AS INTEGER) - e.k AS VARCHAR) END AS sku_num,
         CAST(e.esec AS VARCHAR) AS ts, e.esec, e.event_id
  FROM ev e JOIN dic ON CAST(e.k % 6 + 1 AS VARCHAR) = dic.dic_code
  WHERE e.event_type = 'purchase'
     OR (e.event_type = 'click' AND CAST(round(e.value) AS BIGINT) > e.k))"""

DIMS = """sku AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name, p_name AS spu_id,
                 CASE WHEN p_partkey % 40 = 0 THEN 'Brand#0' ELSE p_brand END AS tm_id, p_type AS category3_id FROM part),
spu AS (SELECT DISTINCT p_name AS id, p_name AS spu_name FROM part),
tm AS (SELECT DISTINCT p_brand AS id, 'TM ' || p_brand AS tm_name FROM part),
c3 AS (SELECT DISTINCT p_type AS id, lower(p_type) AS name, substr(p_type, 1, 1) AS category2_id FROM part),
c2 AS (SELECT DISTINCT substr(p_type, 1, 1) AS id, 'group ' || substr(p_type, 1, 1) AS name,
              CASE WHEN substr(p_type, 1, 1) <= 'M' THEN 'A-M' ELSE 'N-Z' END AS category1_id FROM part),
c1 AS (SELECT DISTINCT category1_id AS id, 'goods ' || category1_id AS name FROM c2)"""

SNOW_SELECT = """tm.tm_name AS trademark_name, c1.id AS category1_id, c1.name AS category1_name,
       c2.id AS category2_id, c2.name AS category2_name, g.category3_id, c3.name AS category3_name"""
SNOW_JOIN = """LEFT JOIN tm ON g.trademark_id = tm.id
LEFT JOIN c3 ON g.category3_id = c3.id
LEFT JOIN c2 ON c3.category2_id = c2.id
LEFT JOIN c1 ON c2.category1_id = c1.id"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _uv_rows() -> str:
    return ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, CAST(epoch_ms(ts) AS DATE) "
            "ORDER BY ts, seq) AS rn FROM page WHERE last_page_id IS NULL) WHERE rn = 1")


def _jump_rows(within_ms: int) -> str:
    return (f"SELECT * FROM (SELECT *, lead(ts) OVER w AS nts, lead(last_page_id IS NULL) OVER w AS nentry "
            f"FROM page WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)) "
            f"WHERE last_page_id IS NULL AND (nts IS NULL OR nts - ts >= {within_ms} OR nentry)")


def _login(back_days: int) -> str:
    return _with(EV, PAGE) + f"""
, firsts AS (
  SELECT uid, CAST(epoch_ms(ts) AS DATE) AS day, min(ts) AS ts FROM page
  WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')
  GROUP BY 1, 2),
flags AS (
  SELECT ts, CASE WHEN lag(day) OVER (PARTITION BY uid ORDER BY day) IS NOT NULL
                   AND day - lag(day) OVER (PARTITION BY uid ORDER BY day) >= {back_days}
                  THEN 1 ELSE 0 END AS back FROM firsts)
SELECT {_labels()}, CAST(sum(back) AS BIGINT) AS back_ct, CAST(count(*) AS BIGINT) AS uu_ct
FROM (SELECT {_win('ts')} AS w, back FROM flags) GROUP BY w"""


def _unique_new(rows_sql: str, uu: str, new: str, *ctes: str) -> str:
    return _with(*ctes) + f"""
, r AS ({rows_sql}),
d AS (SELECT user_id, CAST(epoch_ms(ms) AS DATE) AS day, min(ms) AS ms FROM r GROUP BY 1, 2),
d2 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) = 1 AS first_ever FROM d),
allw AS (SELECT {_win('ms')} AS w FROM r GROUP BY 1),
fw AS (SELECT {_win('ms')} AS w, count(*) AS uu, sum(CASE WHEN first_ever THEN 1 ELSE 0 END) AS nw
       FROM d2 GROUP BY 1)
SELECT {_labels()}, CAST(COALESCE(fw.uu, 0) AS BIGINT) AS {uu}, CAST(COALESCE(fw.nw, 0) AS BIGINT) AS {new}
FROM allw LEFT JOIN fw USING (w)"""


def _split_common() -> str:
    return "mid, uid, vc, ch, ar, is_new"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    base_log = _with(EV, PAGE, FIXED)
    q["log_split_page"] = base_log + f"SELECT {PAGE_COLS}, 'os' || CAST(k % 2 AS VARCHAR) AS os FROM fixed WHERE k <> 0"
    q["log_split_start"] = base_log + (
        f"SELECT {_split_common()}, 'icon' AS entry, CAST(k * 10 + 1000 AS VARCHAR) AS loading_time, ts "
        f"FROM fixed WHERE k = 0")
    q["log_split_display"] = base_log + f"""
SELECT {_split_common()}, page_id, last_page_id, 'promotion' AS display_type,
       CAST(k * 10 + i AS VARCHAR) AS display_item, 'sku_id' AS display_item_type,
       CAST(i AS VARCHAR) AS display_order, CAST(i AS VARCHAR) AS display_pos_id, ts
FROM (SELECT *, unnest(generate_series(1, k % 3)) AS i FROM fixed WHERE k <> 0 AND k % 3 > 0)"""
    q["log_split_action"] = base_log + f"""
SELECT {_split_common()}, page_id, last_page_id, 'favor_add' AS action_id, CAST(k AS VARCHAR) AS action_item,
       'sku_id' AS action_item_type, CAST(ts + 1000 AS VARCHAR) AS action_ts
FROM fixed WHERE k <> 0 AND k % 2 = 1"""
    q["log_split_error"] = base_log + f"""
SELECT {_split_common()}, CASE WHEN k = 0 THEN NULL ELSE page_id END AS page_id,
       CASE WHEN k = 0 THEN 'icon' END AS entry, CAST(k % 5 + 500 AS VARCHAR) AS error_code,
       'failure code ' || CAST(k AS VARCHAR) AS error_msg, ts
FROM fixed WHERE event_type = 'error'"""
    q["log_split_dirty"] = _with(EV) + """
SELECT '{"common":{"mid":"' || CAST(user_id AS VARCHAR) || '","uid":"' || CAST(user_id AS VARCHAR)
       || '"},"ts":' || CAST(ts_ms AS VARCHAR) AS line
FROM ev WHERE k = 99"""
    q["unique_visitor_detail"] = _with(EV, PAGE) + f"SELECT {PAGE_COLS} FROM ({_uv_rows()})"
    q["user_jump_detail"] = _with(EV, PAGE) + f"SELECT {PAGE_COLS} FROM ({_jump_rows(10000)})"
    q["user_jump_detail_6h"] = _with(EV, PAGE) + f"SELECT {PAGE_COLS} FROM ({_jump_rows(6 * 3600 * 1000)})"

    trade = (ORD, DIC, LINES, OI, OD, CHG)
    chg_cols = ("id, order_id, user_id, order_status, sku_id, sku_name, province_id, activity_id, "
                "activity_rule_id, coupon_id, date_id, create_time, operate_date_id, operate_time, "
                "source_id, source_type, source_type_name, sku_num, split_original_amount, "
                "split_activity_amount, split_coupon_amount, split_total_amount, type, old, od_ts, oi_ts, "
                f"{_ts_text('op_sec')} AS row_op_ts")
    q["trade_order_pre_process"] = _with(*trade) + f"""
SELECT {chg_cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY op_sec DESC, CAST(oi_ts AS BIGINT) DESC) AS rn
  FROM chg) WHERE rn = 1"""
    tod_cols = ("id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, "
                "coupon_id, date_id, create_time, source_id, source_type_code, source_type_name, sku_num, "
                "split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, ts, "
                f"{_ts_text('op_sec')} AS row_op_ts")
    q["trade_order_detail"] = _with(*trade, TOD) + f"SELECT {tod_cols} FROM tod"
    q["trade_cancel_detail"] = _with(*trade) + f"""
SELECT id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
       operate_date_id AS date_id, operate_time AS cancel_time, source_id, source_type AS source_type_code,
       source_type_name, sku_num, split_original_amount, split_activity_amount, split_coupon_amount,
       split_total_amount, oi_ts AS ts, {_ts_text('op_sec')} AS row_op_ts
FROM chg WHERE type = 'update' AND old IS NOT NULL AND order_status = '1003'"""
    q["trade_order_detail_latest"] = f"""
SELECT id, strftime(l_shipdate, {FMT}) AS row_op_ts, CAST(l_partkey AS VARCHAR) AS sku_id,
       CAST(l_suppkey AS VARCHAR) AS source_id, CAST(l_quantity AS BIGINT) AS sku_num
FROM (SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
      FROM lineitem) WHERE rn = 1"""
    q["trade_cart_add"] = _with(EV, DIC, CART) + (
        "SELECT id, user_id, sku_id, source_id, source_type_code, source_type_name, sku_num, ts FROM cart")
    pay_cols = ("order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, "
                "activity_rule_id, coupon_id, payment_type_code, payment_type_name, callback_time, source_id, "
                "source_type_code, source_type_name, sku_num, split_original_amount, split_activity_amount, "
                f"split_coupon_amount, split_payment_amount, ts, {_ts_text('op_sec')} AS row_op_ts")
    # K2: the latest version of each detail id.
    latest_pay = "SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY CAST(ts AS BIGINT) DESC) AS nth FROM pay"
    q["trade_pay_detail_suc"] = _with(*trade, TOD, PAY) + f"SELECT {pay_cols} FROM ({latest_pay}) WHERE nth = 1"
    q["trade_pay_detail_suc_success_only"] = _with(*trade, TOD, PAY) + (
        f"SELECT {pay_cols} FROM ({latest_pay} WHERE status = '1602') WHERE nth = 1")
    refund_cols = ("id, user_id, order_id, sku_id, province_id, date_id, create_time, refund_type_code, "
                   "refund_type_name, refund_reason_type_code, refund_reason_type_name, refund_reason_txt, "
                   f"refund_num, refund_amount, ts, {_ts_text('op_sec')} AS row_op_ts")
    q["trade_order_refund"] = _with(ORD, DIC, LINES, OI, REFUND) + f"SELECT {refund_cols} FROM refund"
    q["trade_refund_pay_suc"] = _with(ORD, DIC, LINES, OI) + f"""
SELECT rp.od_id AS id, oi.user_id, CAST(rp.l_orderkey AS VARCHAR) AS order_id,
       CAST(rp.l_partkey AS VARCHAR) AS sku_id, oi.province_id, rp.prio_code AS payment_type_code,
       dic.dic_name AS payment_type_name, strftime(rp.odate + INTERVAL 2 HOUR, '%Y-%m-%d') AS date_id,
       strftime(rp.odate + INTERVAL 2 HOUR, {FMT}) AS callback_time, CAST(ri.qty AS VARCHAR) AS refund_num,
       {_money('rp.price_cents')} AS refund_amount, CAST(rp.osec + 7200 AS VARCHAR) AS ts,
       {_ts_text('greatest(rp.osec + 7200, oi.oi_sec, ri.osec + 3600)')} AS row_op_ts
FROM lines rp
JOIN oi ON CAST(rp.l_orderkey AS VARCHAR) = oi.oi_id AND oi.type = 'update'
JOIN lines ri ON ri.l_returnflag = 'R' AND ri.l_orderkey = rp.l_orderkey AND ri.l_partkey = rp.l_partkey
JOIN dic ON rp.prio_code = dic.dic_code
WHERE rp.l_returnflag = 'R' AND rp.l_linestatus = 'F'"""

    cu = ("SELECT od_id AS id, CAST(l_suppkey % 11 + 1 AS VARCHAR) AS coupon_id, "
          "CAST(o_custkey AS VARCHAR) AS user_id")
    q["tool_coupon_get"] = _with(LINES) + f"""
{cu}, strftime(odate, '%Y-%m-%d') AS date_id, strftime(odate, {FMT}) AS get_time,
       CAST(osec AS VARCHAR) AS ts FROM lines WHERE l_returnflag = 'A'"""
    q["tool_coupon_order"] = _with(LINES) + f"""
{cu}, CAST(l_orderkey AS VARCHAR) AS order_id, strftime(odate + INTERVAL 1 HOUR, '%Y-%m-%d') AS date_id,
       strftime(odate + INTERVAL 1 HOUR, {FMT}) AS order_time, CAST(osec + 3600 AS VARCHAR) AS ts
FROM lines WHERE l_returnflag = 'N' AND l_linestatus = 'O'"""
    q["tool_coupon_pay"] = _with(LINES) + f"""
{cu}, CAST(l_orderkey AS VARCHAR) AS order_id, strftime(odate + INTERVAL 2 HOUR, '%Y-%m-%d') AS date_id,
       strftime(odate + INTERVAL 2 HOUR, {FMT}) AS payment_time, CAST(osec + 7200 AS VARCHAR) AS ts
FROM lines WHERE l_returnflag = 'N' AND l_linestatus = 'F'"""
    q["interaction_favor_add"] = _with(EV) + f"""
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS sku_id,
       strftime(ets, '%Y-%m-%d') AS date_id, strftime(ets, {FMT}) AS create_time, CAST(esec AS VARCHAR) AS ts
FROM ev WHERE event_type = 'view'"""
    q["interaction_comment"] = _with(EV, DIC) + f"""
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS sku_id,
       CAST(NULL AS VARCHAR) AS order_id, strftime(ets, '%Y-%m-%d') AS date_id, strftime(ets, {FMT}) AS create_time,
       CAST(k % 6 + 1 AS VARCHAR) AS appraise_code, dic.dic_name AS appraise_name, CAST(esec AS VARCHAR) AS ts
FROM ev JOIN dic ON CAST(k % 6 + 1 AS VARCHAR) = dic.dic_code
WHERE event_type = 'click' AND k % 2 = 1"""
    q["user_register"] = _with(EV) + f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(ets, '%Y-%m-%d') AS date_id,
       strftime(ets, {FMT}) AS create_time, CAST(esec AS VARCHAR) AS ts
FROM ev WHERE event_type = 'signup'"""

    # ---------------------------------------------------------------- metrics --
    q["dws_home_detail_uv"] = _with(EV, PAGE) + f"""
, f AS (SELECT page_id, ts, row_number() OVER (PARTITION BY mid, page_id, CAST(epoch_ms(ts) AS DATE)
                                            ORDER BY ts, seq) AS rn
        FROM page WHERE page_id IN ('home', 'good_detail'))
SELECT {_labels()}, CAST(sum(h) AS BIGINT) AS home_uv_ct, CAST(sum(d) AS BIGINT) AS good_detail_uv_ct
FROM (SELECT {_win('ts')} AS w, CASE WHEN page_id = 'home' THEN 1 ELSE 0 END AS h,
             CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END AS d FROM f WHERE rn = 1)
GROUP BY w"""
    q["dws_traffic_vc_ch_ar_is_new"] = _with(EV, PAGE) + f"""
, u AS (
  SELECT vc, ch, ar, is_new, ts, 0 AS uv, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv, 1 AS pv,
         COALESCE(during_time, 0) AS dur, 0 AS uj FROM page
  UNION ALL SELECT vc, ch, ar, is_new, ts, 1, 0, 0, 0, 0 FROM ({_uv_rows()})
  UNION ALL SELECT vc, ch, ar, is_new, ts + 10000, 0, 0, 0, 0, 1 FROM ({_jump_rows(10000)}))
SELECT {_labels().replace(", strftime(epoch_ms(w), '%Y%m%d') AS cur_date", "")}, vc, ch, ar, is_new,
       strftime(epoch_ms(w), '%Y%m%d') AS cur_date,
       CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
       CAST(sum(dur) AS BIGINT) AS dur_sum, CAST(sum(uj) AS BIGINT) AS uj_ct
FROM (SELECT {_win('ts')} AS w, * FROM u) GROUP BY w, vc, ch, ar, is_new"""
    q["dws_user_login"] = _login(8)
    q["dws_user_login_back3"] = _login(3)
    q["dws_keyword_window"] = _with(EV, PAGE) + f"""
, words AS (
  SELECT (ts // 1000) * 1000 AS ms, unnest(flatten([
           CASE WHEN regexp_matches(run, '^\\p{{Han}}') AND len(run) > 1 THEN [run[i:i + 1] FOR i IN range(1, len(run))]
                ELSE [run] END FOR run IN regexp_extract_all(lower(item), '\\p{{Han}}+|[\\p{{L}}\\p{{N}}]+')])) AS keyword
  FROM page WHERE item IS NOT NULL AND last_page_id = 'search' AND item_type = 'keyword')
SELECT strftime(epoch_ms(w), {FMT}) AS stt, strftime(epoch_ms(w + 10000), {FMT}) AS edt, 'SEARCH' AS source,
       keyword, strftime(epoch_ms(w), '%Y%m%d') AS cur_date, CAST(count(*) AS BIGINT) AS keyword_count
FROM (SELECT {_win('ms')} AS w, keyword FROM words) GROUP BY w, keyword"""
    q["dws_user_register"] = _with(EV) + f"""
SELECT {_labels()}, CAST(count(*) AS BIGINT) AS register_ct
FROM (SELECT {_win('esec * 1000')} AS w FROM ev WHERE event_type = 'signup') GROUP BY w"""
    q["dws_cart_add_uu"] = _with(EV, DIC, CART) + f"""
, f AS (SELECT user_id, CAST(epoch_ms(esec * 1000) AS DATE) AS day, min(esec) * 1000 AS ms FROM cart GROUP BY 1, 2)
SELECT {_labels()}, CAST(count(*) AS BIGINT) AS cart_add_uu_ct FROM (SELECT {_win('ms')} AS w FROM f) GROUP BY w"""
    q["dws_trade_order"] = _unique_new(
        "SELECT user_id, CAST(ts AS BIGINT) * 1000 AS ms FROM tod "
        "WHERE user_id IS NOT NULL AND source_type_name IS NOT NULL",
        "order_unique_user_count", "order_new_user_count", *trade, TOD)
    q["dws_trade_payment"] = _unique_new(
        "SELECT user_id, CAST(ts AS BIGINT) * 1000 AS ms FROM pay",
        "payment_suc_unique_user_count", "payment_suc_new_user_count", *trade, TOD, PAY)
    q["dws_trade_sku_order"] = _with(*trade, TOD, DIMS) + f"""
, g AS (
  SELECT {_win('CAST(ts AS BIGINT) * 1000')} AS w, sku_id,
         sum(COALESCE(CAST(split_original_amount AS DECIMAL(20,4)), 0)) AS o,
         sum(COALESCE(CAST(split_activity_amount AS DECIMAL(16,2)), 0)) AS a,
         sum(COALESCE(CAST(split_coupon_amount AS DECIMAL(16,2)), 0)) AS c,
         sum(COALESCE(CAST(split_total_amount AS DECIMAL(16,2)), 0)) AS t
  FROM tod WHERE user_id IS NOT NULL AND source_type_name IS NOT NULL GROUP BY 1, 2),
g2 AS (SELECT g.*, sku.sku_name, sku.spu_id, sku.tm_id AS trademark_id, sku.category3_id
       FROM g LEFT JOIN sku ON g.sku_id = sku.id)
SELECT strftime(epoch_ms(w), {FMT}) AS stt, strftime(epoch_ms(w + 10000), {FMT}) AS edt,
       g.trademark_id, {SNOW_SELECT}, g.sku_id, g.sku_name, g.spu_id, spu.spu_name,
       strftime(epoch_ms(w), '%Y%m%d') AS cur_date,
       CAST(o AS DOUBLE) AS original_amount, CAST(a AS DOUBLE) AS activity_amount,
       CAST(c AS DOUBLE) AS coupon_amount, CAST(t AS DOUBLE) AS order_amount
FROM g2 g LEFT JOIN spu ON g.spu_id = spu.id
{SNOW_JOIN}"""
    q["dws_trade_province_order"] = _with(ORD, OI) + f"""
, g AS (SELECT {_win('oi_sec * 1000')} AS w, province_id, count(*) AS n,
               sum(CAST(total_amount AS DECIMAL(16,2))) AS amt
        FROM oi WHERE type = 'insert' GROUP BY 1, 2)
SELECT strftime(epoch_ms(w), {FMT}) AS stt, strftime(epoch_ms(w + 10000), {FMT}) AS edt, g.province_id,
       COALESCE(n.n_name, '') AS province_name, strftime(epoch_ms(w), '%Y%m%d') AS cur_date,
       CAST(g.n AS BIGINT) AS order_count, CAST(g.amt AS DOUBLE) AS order_amount
FROM g LEFT JOIN nation n ON g.province_id = CAST(n.n_nationkey AS VARCHAR)"""
    q["dws_refund_tm_category_user"] = _with(ORD, DIC, LINES, OI, REFUND, DIMS) + f"""
, g AS (
  SELECT {_win('CAST(r.ts AS BIGINT) * 1000')} AS w, sku.tm_id AS trademark_id, sku.category3_id, r.user_id,
         count(DISTINCT r.order_id) AS n
  FROM refund r LEFT JOIN sku ON r.sku_id = sku.id GROUP BY 1, 2, 3, 4)
SELECT strftime(epoch_ms(w), {FMT}) AS stt, strftime(epoch_ms(w + 10000), {FMT}) AS edt,
       g.trademark_id, {SNOW_SELECT}, g.user_id, strftime(epoch_ms(w), '%Y%m%d') AS cur_date,
       CAST(g.n AS BIGINT) AS refund_count
FROM g {SNOW_JOIN}"""

    # The same metrics in one-hour windows (a bounce still counts 10 s later).
    for name in ("dws_keyword_window", "dws_traffic_vc_ch_ar_is_new", "dws_home_detail_uv", "dws_user_login",
                 "dws_user_register", "dws_cart_add_uu"):
        q[f"{name}_1h"] = (q[name].replace("// 10000) * 10000", "// 3600000) * 3600000")
                           .replace("w + 10000", "w + 3600000"))

    # ------------------------------------------------------------- dim sink --
    q["dim_sink"] = """
WITH kv AS (
  SELECT 'dim_base_trademark' AS sink_table, p_brand AS id, 'id' AS column_name, p_brand AS column_value FROM part
  UNION SELECT 'dim_base_trademark', p_brand, 'tm_name', 'TM ' || p_brand FROM part
  UNION SELECT 'dim_base_province', CAST(n_nationkey AS VARCHAR), 'id', CAST(n_nationkey AS VARCHAR) FROM nation
  UNION SELECT 'dim_base_province', CAST(n_nationkey AS VARCHAR), 'name', n_name FROM nation
  UNION SELECT 'dim_base_province', CAST(n_nationkey AS VARCHAR), 'region_id', CAST(n_regionkey AS VARCHAR) FROM nation
  UNION SELECT 'dim_base_category3', p_type, 'id', p_type FROM part
  UNION SELECT 'dim_base_category3', p_type, 'name', lower(p_type) FROM part
  UNION SELECT 'dim_base_category3', p_type, 'category2_id', substr(p_type, 1, 1) FROM part
  UNION SELECT 'dim_spu_info', p_name, 'id', p_name FROM part
  UNION SELECT 'dim_spu_info', p_name, 'spu_name', p_name FROM part
  UNION SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'id', CAST(p_partkey AS VARCHAR) FROM part
  UNION SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'spu_id', p_name FROM part
  UNION SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'sku_name',
               CASE WHEN p_size > 45 THEN upper(p_name) ELSE p_name END FROM part
  UNION SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'tm_id', p_brand FROM part
  UNION SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'category3_id', p_type FROM part)
SELECT sink_table, id, column_name, column_value FROM kv"""
    return q
