"""Deterministic mapping from the given test tables to the warehouse inputs.

The warehouse reads a behaviour log (``topic_log``) and database change
records (``topic_db``).  The test tables are TPC-H-like, so this module
derives both, plus the dictionary and dimension tables, with Spark jobs over
the whole tables.  Rules: see FIXTURES.md §4.  Every rule is plain column
arithmetic, so the SQL oracle can state it independently.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import FMT_DATETIME
from ..session import checkpoint_root
from .tables import read_table

DATABASE = "shop"
MAP_SS = T.MapType(T.StringType(), T.StringType())

# Text without word spaces, put in front of every fifth search.
UNSPACED_SEARCH = "苹果手机红色 "
# A trademark that no dimension row has (the left enrichment join keeps its
# skus); cart and comment codes reach 6, which the dictionary doesn't have
# (the inner lookup drops them).
UNKNOWN_BRAND = "Brand#0"


# ---------------------------------------------------------------- helpers --
def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _fmt(ts: Column) -> Column:
    return F.date_format(ts, FMT_DATETIME)


def _cents(c: str) -> Column:
    """Money as integer cents (exact; no double rounding ties)."""
    return F.round(F.col(c) * 100).cast("bigint")


def _money(cents: Column) -> Column:
    """Integer cents to a 2-decimal string, exactly."""
    return (cents.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(16,2)").cast("string")


def _kmap(**kv) -> Column:
    args = []
    for k, v in kv.items():
        args += [F.lit(k), _s(v) if not isinstance(v, str) else F.lit(v)]
    return F.create_map(*args)


def _envelope(df: DataFrame, table: str, type_: Column | str, data: Column,
              old: Column | None, ts_sec: Column, key: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(DATABASE).alias("database"),
        F.lit(table).alias("table"),
        (F.lit(type_) if isinstance(type_, str) else type_).alias("type"),
        data.alias("data"),
        (old if old is not None else F.lit(None).cast(MAP_SS)).alias("old"),
        ts_sec.cast("string").alias("ts"),
        *([key.alias("key")] if key is not None else []),
    )


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def dic_code(priority: Column) -> Column:
    return F.substring_index(priority, "-", 1)


def dic_name(priority: Column) -> Column:
    return F.expr("substr(o_orderpriority, instr(o_orderpriority, '-') + 1)")


# ------------------------------------------------------------ behaviour log --
def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with k, epoch ms and, for purchases, the searched part name."""
    ev = read_table(spark, sf_dir, "events")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    n_parts = part.select(F.count(F.lit(1))).scalar()
    base = ev.select(
        "event_id", "user_id", "event_type", "value",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        _k().alias("k"),
    )
    # Only purchases look up a part: the other rows bypass the join instead
    # of entering it with a NULL key (NULL keys all hash to one partition).
    is_purchase = F.col("event_type") == "purchase"
    purchases = base.filter(is_purchase)
    purchases = (purchases.join(part, F.pmod(purchases.event_id, n_parts) == part.p_partkey, "left")
                 .drop("p_partkey")
                 .withColumn("p_name", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit(UNSPACED_SEARCH), "p_name"))
                             .otherwise(F.col("p_name"))))
    others = base.filter(~is_purchase | F.col("event_type").isNull()).withColumn(
        "p_name", F.lit(None).cast("string"))
    return purchases.unionByName(others)


def _common(df_cols=None) -> Column:
    uid = _s("user_id")
    return F.struct(
        uid.alias("mid"), uid.alias("uid"),
        F.concat(F.lit("v"), _s(F.col("k") % 3)).alias("vc"),
        F.concat(F.lit("c"), _s(F.col("k") % 4)).alias("ch"),
        F.concat(F.lit("a"), _s(F.col("user_id") % 5)).alias("ar"),
        F.when(F.col("k") % 2 == 0, "1").otherwise("0").alias("is_new"),
    )


def _page() -> Column:
    et = F.col("event_type")
    page_id = (F.when(et == "view", "home").when(et == "click", "good_detail").otherwise(et))
    last = (F.when(et == "error", "login").when(et == "purchase", "search")
            .when(et == "click", "home"))
    purchase = et == "purchase"
    return F.struct(
        page_id.alias("page_id"),
        last.alias("last_page_id"),
        F.when(purchase, F.col("p_name")).alias("item"),
        F.when(purchase, F.lit("keyword")).alias("item_type"),
        F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
    )


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed page-log rows (``dwd_traffic_page_log``) over all events:
    ``common`` struct, ``page`` struct, ``ts`` (epoch ms), ``seq`` (arrival
    order, used only to break timestamp ties)."""
    ev = _events(spark, sf_dir)
    return ev.select(_common().alias("common"), _page().alias("page"),
                     F.col("ts_ms").alias("ts"), F.col("event_id").alias("seq"))


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log lines (``topic_log``): one JSON text per event in ``value``.

    k = 0 gives a start record (no page), k % 3 display elements, k % 2
    action elements, error events an ``err`` object, and k = 99 a truncated
    (unparsable) line."""
    ev = _events(spark, sf_dir)
    k = F.col("k")
    n_disp = k % 3
    n_act = k % 2
    displays = F.when(n_disp > 0, F.transform(
        F.sequence(F.lit(1), n_disp),
        lambda i: F.create_map(
            F.lit("display_type"), F.lit("promotion"),
            F.lit("item"), _s(k * 10 + i),
            F.lit("item_type"), F.lit("sku_id"),
            F.lit("order"), _s(i),
            F.lit("pos_id"), _s(i))))
    actions = F.when(n_act > 0, F.transform(
        F.sequence(F.lit(1), n_act),
        lambda i: F.create_map(
            F.lit("action_id"), F.lit("favor_add"),
            F.lit("item"), _s(k),
            F.lit("item_type"), F.lit("sku_id"),
            F.lit("ts"), _s(F.col("ts_ms") + i * 1000))))
    is_start = k == 0
    err = F.when(F.col("event_type") == "error", F.create_map(
        F.lit("error_code"), _s(k % 5 + 500),
        F.lit("msg"), F.concat(F.lit("failure code "), _s(k))))
    start = F.when(is_start, F.create_map(
        F.lit("entry"), F.lit("icon"),
        F.lit("loading_time"), _s(k * 10 + 1000)))
    record = F.struct(
        _common().withField("os", F.concat(F.lit("os"), _s(k % 2))).alias("common"),
        F.when(~is_start, _page().withField("source_type", F.lit("promotion"))).alias("page"),
        start.alias("start"),
        F.when(~is_start, displays).alias("displays"),
        F.when(~is_start, actions).alias("actions"),
        err.alias("err"),
        F.col("ts_ms").alias("ts"),
    )
    dirty = F.concat(F.lit('{"common":{"mid":"'), _s("user_id"), F.lit('","uid":"'),
                     _s("user_id"), F.lit('"},"ts":'), _s("ts_ms"))
    return ev.select(
        F.when(k == 99, dirty).otherwise(F.to_json(record)).alias("value"),
        F.col("event_id").alias("seq"))


# ------------------------------------------------------------- change records --
def _orders(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = o.join(c, o.o_custkey == c.c_custkey, "left")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.col("o_orderdate").cast("timestamp").alias("odate"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("osec"),
        F.col("c_nationkey").alias("province"),
        dic_code(F.col("o_orderpriority")).alias("prio_code"))


def _lines(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    # Per-order values are computed on the (smaller) order side of the join.
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.col("o_orderdate").cast("timestamp").alias("odate"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("osec"),
        dic_code(F.col("o_orderpriority")).alias("prio_code"))
    # Joined on the text that is the lines' order_id, so keyed change records
    # are partitioned by it.
    df = li.join(o, _s("l_orderkey") == _s("o_orderkey"), "inner")
    return df.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "o_custkey", "odate", "osec", "prio_code",
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"),
                    F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyyMMdd")).alias("od_id"),
        _cents("l_extendedprice").alias("price_cents"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("disc_pct"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tax_pct"),
        F.col("l_quantity").cast("bigint").alias("qty"))


def _hours(ts: Column, h: int) -> Column:
    return ts + F.make_interval(hours=F.lit(h))


def _cdc_order_info(o: DataFrame, together: bool = False) -> DataFrame:
    def data(status, operate):
        return F.create_map(
            F.lit("id"), _s("o_orderkey"), F.lit("user_id"), _s("o_custkey"),
            F.lit("province_id"), _s("province"), F.lit("order_status"), status,
            F.lit("total_amount"), _money(_cents("o_totalprice")),
            F.lit("create_time"), _fmt(F.col("odate")), F.lit("operate_time"), operate)
    has_update = F.col("o_orderstatus").isin("F", "P")
    new_status = F.when(F.col("o_orderstatus") == "F", "1003").otherwise("1005")
    operate, before = _fmt(_hours(F.col("odate"), 1)), _kmap(order_status="1001")
    if together:
        o = o.withColumn("version", F.explode(F.when(has_update, F.array(F.lit("insert"), F.lit("update"))).otherwise(F.array(F.lit("insert")))))
        later = F.col("version") == "update"
        return _envelope(o, "order_info", F.col("version"),
                         data(F.when(later, new_status).otherwise("1001"), F.when(later, operate)),
                         F.when(later, before), F.col("osec") + F.when(later, 3600).otherwise(0))
    ins = _envelope(o, "order_info", "insert",
                    data(F.lit("1001"), F.lit(None).cast("string")), None, F.col("osec"))
    upd = _envelope(o.filter(has_update), "order_info", "update",
                    data(new_status, operate), before, F.col("osec") + 3600)
    return ins.unionByName(upd)


def _cdc_order_detail(li: DataFrame, keyed: bool = False) -> DataFrame:
    price_cents = F.expr("price_cents div nullif(qty, 0)")
    data = F.create_map(
        F.lit("id"), F.col("od_id"), F.lit("order_id"), _s("l_orderkey"),
        F.lit("sku_id"), _s("l_partkey"), F.lit("sku_name"), F.concat(F.lit("sku-"), _s("l_partkey")),
        F.lit("create_time"), _fmt(F.col("odate")), F.lit("source_id"), _s("l_suppkey"),
        F.lit("source_type"), F.col("prio_code"), F.lit("sku_num"), _s("qty"),
        F.lit("order_price"), _money(price_cents),
        F.lit("split_total_amount"), _money(F.col("price_cents")),
        F.lit("split_activity_amount"),
        F.when(F.col("l_returnflag") == "R", _money(F.expr("price_cents * disc_pct div 100"))),
        F.lit("split_coupon_amount"),
        F.when(F.col("l_returnflag") == "A", _money(F.expr("price_cents * tax_pct div 100"))))
    return _envelope(li, "order_detail", "insert", data, None, F.col("osec"), _s("l_orderkey") if keyed else None)


def _cdc_detail_activity(li: DataFrame) -> DataFrame:
    r = li.filter(F.col("l_returnflag") == "R")
    data = F.create_map(
        F.lit("order_detail_id"), F.col("od_id"),
        F.lit("activity_id"), _s(F.col("l_partkey") % 7 + 1),
        F.lit("activity_rule_id"), _s(F.col("l_partkey") % 3 + 1))
    return _envelope(r, "order_detail_activity", "insert", data, None, F.col("osec"))


def _cdc_detail_coupon(li: DataFrame) -> DataFrame:
    a = li.filter(F.col("l_returnflag") == "A")
    data = F.create_map(F.lit("order_detail_id"), F.col("od_id"),
                        F.lit("coupon_id"), _s(F.col("l_suppkey") % 11 + 1))
    return _envelope(a, "order_detail_coupon", "insert", data, None, F.col("osec"))


def _cdc_payment(o: DataFrame) -> DataFrame:
    p = o.filter(F.col("o_orderstatus").isin("F", "O"))
    data = F.create_map(
        F.lit("id"), _s("o_orderkey"), F.lit("user_id"), _s("o_custkey"),
        F.lit("order_id"), _s("o_orderkey"), F.lit("payment_type"), F.col("prio_code"),
        F.lit("payment_status"), F.lit("1602"),
        F.lit("total_amount"), _money(_cents("o_totalprice")),
        F.lit("callback_time"), _fmt(_hours(F.col("odate"), 2)))
    paid = _envelope(p, "payment_info", "update", data, _kmap(payment_status="1601"),
                     F.col("osec") + 7200)
    # Some payments change once more an hour later: other type, not successful.
    again = F.map_concat(
        F.map_filter(F.col("data"), lambda k, v: ~k.isin("payment_type", "payment_status", "callback_time")),
        F.create_map(F.lit("payment_type"), _s(F.col("prio_code").cast("int") % 5 + 1), F.lit("payment_status"), F.lit("1603"),
                     F.lit("callback_time"), _fmt(_hours(F.col("odate"), 3))))
    late = _envelope(p.filter(F.col("o_orderkey") % 3 == 0).withColumn("data", data), "payment_info", "update", again,
                     _kmap(payment_status="1602"), F.col("osec") + 10800)
    return paid.unionByName(late)


def _cdc_refund_info(li: DataFrame) -> DataFrame:
    r = li.filter(F.col("l_returnflag") == "R")
    data = F.create_map(
        F.lit("id"), F.col("od_id"), F.lit("user_id"), _s("o_custkey"),
        F.lit("order_id"), _s("l_orderkey"), F.lit("sku_id"), _s("l_partkey"),
        F.lit("refund_type"), F.col("prio_code"), F.lit("refund_num"), _s("qty"),
        F.lit("refund_amount"), _money(F.col("price_cents")),
        F.lit("refund_reason_type"), F.col("prio_code"),
        F.lit("refund_reason_txt"), F.concat(F.lit("reason "), _s("l_linenumber")),
        F.lit("create_time"), _fmt(_hours(F.col("odate"), 1)))
    return _envelope(r, "order_refund_info", "insert", data, None, F.col("osec") + 3600)


def _cdc_refund_payment(li: DataFrame) -> DataFrame:
    r = li.filter(F.col("l_returnflag") == "R")
    done = F.col("l_linestatus") == "F"
    data = F.create_map(
        F.lit("id"), F.col("od_id"), F.lit("order_id"), _s("l_orderkey"),
        F.lit("sku_id"), _s("l_partkey"), F.lit("payment_type"), F.col("prio_code"),
        F.lit("callback_time"), _fmt(_hours(F.col("odate"), 2)),
        F.lit("total_amount"), _money(F.col("price_cents")),
        F.lit("refund_status"), F.when(done, "0702").otherwise("0701"))
    return _envelope(r, "refund_payment", F.when(done, "update").otherwise("insert"), data,
                     F.when(done, _kmap(refund_status="0701")), F.col("osec") + 7200)


def _cdc_coupon_use(li: DataFrame) -> DataFrame:
    base = dict(id=F.col("od_id"), coupon_id=_s(F.col("l_suppkey") % 11 + 1),
                user_id=_s("o_custkey"), get_time=_fmt(F.col("odate")))

    def m(**kv):
        args = []
        for k, v in {**base, **kv}.items():
            args += [F.lit(k), v if isinstance(v, Column) else F.lit(v)]
        return F.create_map(*args)

    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    got = _envelope(li.filter(flag == "A"), "coupon_use", "insert",
                    m(order_id=F.lit(None).cast("string"), coupon_status="1401"), None, F.col("osec"))
    using = _envelope(li.filter((flag == "N") & (status == "O")), "coupon_use", "update",
                      m(order_id=_s("l_orderkey"), coupon_status="1402",
                        using_time=_fmt(_hours(F.col("odate"), 1))),
                      _kmap(coupon_status="1401"), F.col("osec") + 3600)
    used = _envelope(li.filter((flag == "N") & (status == "F")), "coupon_use", "update",
                     m(order_id=_s("l_orderkey"), coupon_status="1403",
                       using_time=_fmt(_hours(F.col("odate"), 1)),
                       used_time=_fmt(_hours(F.col("odate"), 2))),
                     _kmap(coupon_status="1402"), F.col("osec") + 7200)
    return got.unionByName(using).unionByName(used)


def _event_rows(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "user_id", "event_type", "value", _k().alias("k"),
        F.col("ts").cast("timestamp").alias("ets"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("esec"))


def _cdc_cart(ev: DataFrame) -> DataFrame:
    et = F.col("event_type")
    rows = ev.filter(et.isin("purchase", "click"))
    data = F.create_map(
        F.lit("id"), _s("event_id"), F.lit("user_id"), _s("user_id"),
        F.lit("sku_id"), _s("k"), F.lit("source_id"), _s(F.col("event_id") % 50),
        F.lit("source_type"), _s(F.col("k") % 6 + 1),
        F.lit("sku_num"), _s(F.round(F.col("value")).cast("bigint")))
    is_upd = et == "click"
    return _envelope(rows, "cart_info", F.when(is_upd, "update").otherwise("insert"), data,
                     F.when(is_upd, F.create_map(F.lit("sku_num"), _s("k"))), F.col("esec"))


def _cdc_comment(ev: DataFrame) -> DataFrame:
    rows = ev.filter((F.col("event_type") == "click") & (F.col("k") % 2 == 1))
    data = F.create_map(
        F.lit("id"), _s("event_id"), F.lit("user_id"), _s("user_id"), F.lit("sku_id"), _s("k"),
        F.lit("order_id"), F.lit(None).cast("string"), F.lit("create_time"), _fmt(F.col("ets")),
        F.lit("appraise"), _s(F.col("k") % 6 + 1))
    return _envelope(rows, "comment_info", "insert", data, None, F.col("esec"))


def _cdc_favor(ev: DataFrame) -> DataFrame:
    rows = ev.filter(F.col("event_type") == "view")
    data = F.create_map(
        F.lit("id"), _s("event_id"), F.lit("user_id"), _s("user_id"), F.lit("sku_id"), _s("k"),
        F.lit("create_time"), _fmt(F.col("ets")), F.lit("is_cancel"), F.lit("0"))
    return _envelope(rows, "favor_info", "insert", data, None, F.col("esec"))


def _cdc_user(ev: DataFrame) -> DataFrame:
    rows = ev.filter(F.col("event_type") == "signup")
    data = F.create_map(F.lit("id"), _s("user_id"), F.lit("create_time"), _fmt(F.col("ets")))
    return _envelope(rows, "user_info", "insert", data, None, F.col("esec"))


ORDER_TABLES = ("order_info", "payment_info")
LINE_TABLES = ("order_detail", "order_detail_activity", "order_detail_coupon",
               "order_refund_info", "refund_payment", "coupon_use")
EVENT_TABLES = ("cart_info", "comment_info", "favor_info", "user_info")


def topic_db(spark: SparkSession, sf_dir: str, tables=None, keyed: bool = False, together: bool = False) -> DataFrame:
    """The change-record envelope (``database, table, type, data, old, ts``)
    for the business tables.  ``tables`` limits the branches built; a filter
    on ``table`` downstream prunes the rest anyway.  ``keyed`` adds the
    records' ``key``: the order's id on order lines, null on all others.
    ``together`` reads the orders once for both versions of each, for what
    needs both; else each version has its own branch, which filters prune."""
    want = set(tables) if tables else set(ORDER_TABLES + LINE_TABLES + EVENT_TABLES)
    parts = []
    if want & set(ORDER_TABLES):
        o = _orders(spark, sf_dir)
        if "order_info" in want:
            parts.append(_cdc_order_info(o, together))
        if "payment_info" in want:
            parts.append(_cdc_payment(o))
    if want & set(LINE_TABLES):
        li = _lines(spark, sf_dir)
        builders = {"order_detail": lambda rows: _cdc_order_detail(rows, keyed), "order_detail_activity": _cdc_detail_activity,
                    "order_detail_coupon": _cdc_detail_coupon, "order_refund_info": _cdc_refund_info,
                    "refund_payment": _cdc_refund_payment, "coupon_use": _cdc_coupon_use}
        parts += [builders[t](li) for t in LINE_TABLES if t in want]
    if want & set(EVENT_TABLES):
        ev = _event_rows(spark, sf_dir)
        builders = {"cart_info": _cdc_cart, "comment_info": _cdc_comment,
                    "favor_info": _cdc_favor, "user_info": _cdc_user}
        parts += [builders[t](ev) for t in EVENT_TABLES if t in want]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=keyed), parts)


# ---------------------------------------------------- dictionary and dims --
def base_dic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base_dic(dic_code, dic_name, parent_code)`` from the distinct order
    priorities.

    Stored as a table of its own, as the warehouse has it.  Spark then knows
    its size: a small one is broadcast.  As a part of the query it would pass
    for as large as the orders, and every lookup would shuffle all rows by
    the few codes."""
    o = read_table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    dic = (o.select(dic_code(F.col("o_orderpriority")).alias("dic_code"),
                    dic_name(F.col("o_orderpriority")).alias("dic_name"),
                    F.lit(None).cast("string").alias("parent_code")))
    path = f"{checkpoint_root(spark).rstrip('/')}/base_dic-{uuid.uuid4().hex}"
    dic.write.parquet(path)
    return spark.read.schema(dic.schema).parquet(path)


def _category1(letter: Column) -> Column:
    """Category 1 of a category-2 letter: ``A-M`` or ``N-Z``."""
    return F.when(letter <= F.lit("M"), F.lit("A-M")).otherwise(F.lit("N-Z"))


def dim_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimension tables as the warehouse stores them (all string columns)."""
    part = read_table(spark, sf_dir, "part")
    nation = read_table(spark, sf_dir, "nation")
    sku = part.select(_s("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
                      F.col("p_name").alias("spu_id"),
                      F.when(F.col("p_partkey") % 40 == 0, UNKNOWN_BRAND).otherwise(F.col("p_brand")).alias("tm_id"),
                      F.col("p_type").alias("category3_id"))
    spu = part.select(F.col("p_name").alias("id"), F.col("p_name").alias("spu_name")).distinct()
    tm = (part.select(F.col("p_brand").alias("id")).distinct()
          .select("id", F.concat(F.lit("TM "), F.col("id")).alias("tm_name")))
    c3 = (part.select(F.col("p_type").alias("id")).distinct()
          .select("id", F.lower("id").alias("name"), F.substring("id", 1, 1).alias("category2_id")))
    c2 = (part.select(F.substring("p_type", 1, 1).alias("id")).distinct()
          .select("id", F.concat(F.lit("group "), F.col("id")).alias("name"),
                  _category1(F.col("id")).alias("category1_id")))
    c1 = (c2.select(F.col("category1_id").alias("id")).distinct()
          .select("id", F.concat(F.lit("goods "), F.col("id")).alias("name")))
    prov = nation.select(_s("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return {"sku_info": sku, "spu_info": spu, "base_trademark": tm, "base_category3": c3,
            "base_category2": c2, "base_category1": c1, "base_province": prov}


# ------------------------------------------- dimension change records + config --
# fixed values: the dimension configuration (table_process change log).
# (op, source_table, sink_table, sink_columns, sink_pk, sink_extend, ts)
TABLE_PROCESS_CHANGES = [
    ("r", "base_trademark", "dim_base_trademark", "id,tm_name", "id", None, 0),
    ("r", "base_province", "dim_base_province", "id,name,region_id", "id", None, 0),
    ("r", "base_category3", "dim_base_category3", "id,name,category2_id", "id", None, 0),
    ("r", "sku_info", "dim_sku_info", "id,spu_id,price,sku_name,tm_id,category3_id", "id",
     " SALT_BUCKETS = 4", 0),
    ("r", "spu_info", "dim_spu_info", "id,spu_name", None, None, 0),
    ("r", "base_region", "dim_base_region", "id,region_name", "id", None, 0),
    ("u", "sku_info", "dim_sku_info", "id,spu_id,sku_name,tm_id,category3_id", "id",
     " SALT_BUCKETS = 4", 1),
    ("d", "base_region", "dim_base_region", "id,region_name", "id", None, 2),
]
CONFIG_SCHEMA = ("op string, source_table string, sink_table string, sink_columns string, "
                 "sink_pk string, sink_extend string, ts bigint")


def table_process_changes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TABLE_PROCESS_CHANGES, CONFIG_SCHEMA)


def topic_db_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records of the dimension source tables, derived from part,
    nation and region: inserts, a later update of large parts (p_size > 45,
    name upper-cased), and bootstrap markers."""
    part = read_table(spark, sf_dir, "part")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")

    def sku(name_col, type_, ts):
        return _envelope(part, "sku_info", type_, F.create_map(
            F.lit("id"), _s("p_partkey"), F.lit("spu_id"), F.col("p_name"),
            F.lit("price"), _money(_cents("p_retailprice")), F.lit("sku_name"), name_col,
            F.lit("tm_id"), F.col("p_brand"), F.lit("category3_id"), F.col("p_type"),
            F.lit("weight"), _s("p_size")), None, F.lit(ts))

    ins = sku(F.col("p_name"), "insert", 1000)
    upd = sku(F.upper(F.col("p_name")), "update", 2000).where(F.col("data")["weight"].cast("int") > 45)
    brands = part.select("p_brand").distinct()
    tm = _envelope(brands, "base_trademark", "insert", F.create_map(
        F.lit("id"), F.col("p_brand"), F.lit("tm_name"), F.concat(F.lit("TM "), F.col("p_brand")),
        F.lit("logo_url"), F.lit("/logo.png")), None, F.lit(1000))
    types = part.select("p_type").distinct()
    c3 = _envelope(types, "base_category3", "insert", F.create_map(
        F.lit("id"), F.col("p_type"), F.lit("name"), F.lower(F.col("p_type")),
        F.lit("category2_id"), F.substring("p_type", 1, 1)), None, F.lit(1000))
    names = part.select("p_name").distinct()
    spu = _envelope(names, "spu_info", "insert", F.create_map(
        F.lit("id"), F.col("p_name"), F.lit("spu_name"), F.col("p_name")), None, F.lit(1000))
    prov = _envelope(nation, "base_province", "insert", F.create_map(
        F.lit("id"), _s("n_nationkey"), F.lit("name"), F.col("n_name"),
        F.lit("region_id"), _s("n_regionkey"), F.lit("area_code"), F.lit("000")), None, F.lit(1000))
    reg = _envelope(region, "base_region", "insert", F.create_map(
        F.lit("id"), _s("r_regionkey"), F.lit("region_name"), F.col("r_name")), None, F.lit(1000))
    marks = _envelope(region, "sku_info", "bootstrap-start",
                      F.lit(None).cast(MAP_SS), None, F.lit(999))
    return reduce(DataFrame.unionByName, [ins, upd, tm, c3, spu, prov, reg, marks])


def detail_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successive versions of order lines for T9: id = orderkey-linenumber
    (not unique in lineitem), version time = ship date, arrival order =
    (partkey, suppkey)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")).alias("id"),
        F.col("l_shipdate").cast("timestamp").alias("row_op_ts"),
        F.struct(F.col("l_partkey"), F.col("l_suppkey")).alias("arrival"),
        _s("l_partkey").alias("sku_id"), _s("l_suppkey").alias("source_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"))
