"""Ten-second window metrics (the DWS layer)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (BACK_USER_DAYS, JUMP_SHIFT_SECONDS, KEYWORD_SOURCE_SEARCH,
                         PAGE_GOOD_DETAIL, PAGE_HOME, PAGE_LOGIN, PAGE_SEARCH, ITEM_TYPE_KEYWORD,
                         WINDOW_SECONDS)
from ..functions.timefmt import sec_to_ms
from ..functions.tokenize import explode_keywords
from ..operators import visits
from ..operators.enrich import lookup, snowflake_sku
from ..operators.keyed import latest_rows
from ..operators.windows import tumbling_agg, with_event_time
from . import log as logplans


def _sum(c: str):
    return F.sum(F.col(c)).cast("bigint")


def home_detail_uv(page: DataFrame, size: int = WINDOW_SECONDS) -> DataFrame:
    """(window): home / good-detail unique visitors; only windows with one
    (P11, T4, W1, A7).  ``page`` is flat with ``seq``."""
    p = page.filter(F.col("page_id").isin(PAGE_HOME, PAGE_GOOD_DETAIL))
    firsts = visits.first_time_per_day(p.select("mid", "page_id", "ts"), ["mid", "page_id"])
    flags = firsts.select(
        "ts", (F.col("page_id") == PAGE_HOME).cast("bigint").alias("home"),
        (F.col("page_id") == PAGE_GOOD_DETAIL).cast("bigint").alias("detail"))
    return tumbling_agg(with_event_time(flags), {"home_uv_ct": _sum("home"),
                                                 "good_detail_uv_ct": _sum("detail")},
                        size_seconds=size)


TRAFFIC_KEYS = ["vc", "ch", "ar", "is_new"]


def traffic_measures() -> dict:
    return {"uv_ct": _sum("uv"), "sv_ct": _sum("sv"), "pv_ct": _sum("pv"), "dur_sum": _sum("dur"), "uj_ct": _sum("uj")}


def traffic_rows(page: DataFrame, uv_rows: DataFrame, uj_rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What page views, unique visitors and bounces add to the traffic
    measures (P15); bounces count ``JUMP_SHIFT_SECONDS`` later (W6)."""
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    pv = page.select(*TRAFFIC_KEYS, "ts", zero.alias("uv"), F.col("last_page_id").isNull().cast("bigint").alias("sv"),
                     one.alias("pv"), F.coalesce(F.col("during_time"), zero).alias("dur"), zero.alias("uj"))
    uv = uv_rows.select(*TRAFFIC_KEYS, "ts", one.alias("uv"), zero.alias("sv"), zero.alias("pv"), zero.alias("dur"), zero.alias("uj"))
    uj = uj_rows.select(*TRAFFIC_KEYS, (F.col("ts") + JUMP_SHIFT_SECONDS * 1000).alias("ts"), zero.alias("uv"),
                        zero.alias("sv"), zero.alias("pv"), zero.alias("dur"), one.alias("uj"))
    return pv, uv, uj


def traffic_vc_ch_ar_is_new(page: DataFrame, size: int = WINDOW_SECONDS,
                            jump_within: int = 10, uv_rows: DataFrame | None = None,
                            uj_rows: DataFrame | None = None) -> DataFrame:
    """(window, vc, ch, ar, is_new): uv, sessions, page views, duration,
    bounces (P15, W6, U1, A2).  ``uv_rows`` / ``uj_rows`` are the
    unique-visitor and bounce detail tables when they are already
    materialised; else they are derived."""
    uv_rows = uv_rows if uv_rows is not None else logplans.unique_visitor_detail(page)
    uj_rows = uj_rows if uj_rows is not None else logplans.user_jump_detail(page, jump_within)
    pv, uv, uj = traffic_rows(page, uv_rows, uj_rows)
    return tumbling_agg(with_event_time(pv.unionByName(uv).unionByName(uj)), traffic_measures(),
                        keys=TRAFFIC_KEYS, size_seconds=size)


def user_login(page: DataFrame, back_days: int = BACK_USER_DAYS, size: int = WINDOW_SECONDS) -> DataFrame:
    """(window): unique logged-in users and returning users."""
    logins = page.filter(F.col("uid").isNotNull()
                         & (F.col("last_page_id").isNull() | (F.col("last_page_id") == PAGE_LOGIN)))
    flags = visits.login_flags(logins.select("uid", "ts"), "uid", back_days)
    return tumbling_agg(with_event_time(flags), {"back_ct": _sum("back_ct"), "uu_ct": _sum("uu_ct")},
                        size_seconds=size)


def keyword_window(page: DataFrame, size: int = WINDOW_SECONDS) -> DataFrame:
    """(window, keyword): searches per token (P13, F1, A1).  Event time is
    cut to the second as in the reference."""
    s = page.filter(F.col("item").isNotNull() & (F.col("last_page_id") == PAGE_SEARCH)
                    & (F.col("item_type") == ITEM_TYPE_KEYWORD))
    s = s.select(F.date_trunc("second", F.timestamp_millis("ts")).alias("row_time"), "item")
    words = explode_keywords(s, "item").select("row_time", "keyword")
    g = tumbling_agg(words, {"keyword_count": F.count(F.lit(1)).cast("bigint")},
                     keys=["keyword"], size_seconds=size)
    return g.select("stt", "edt", F.lit(KEYWORD_SOURCE_SEARCH).alias("source"), "keyword",
                    "cur_date", "keyword_count")


def user_register(register: DataFrame, size: int = WINDOW_SECONDS) -> DataFrame:
    """(window): registrations (A6).  ``register`` is ``user_register``."""
    r = register.withColumn("ms", sec_to_ms("ts"))
    return tumbling_agg(with_event_time(r, "ms"), {"register_ct": F.count(F.lit(1)).cast("bigint")},
                        size_seconds=size)


def cart_add_uu(cart: DataFrame, size: int = WINDOW_SECONDS, count_every_add: bool = False) -> DataFrame:
    """(window): unique cart-add users per day (T8, A6).  The reference never
    writes its state, so every add counts; ``count_every_add=True`` gives
    that literal behaviour."""
    c = cart.select("user_id", sec_to_ms("ts").alias("ts"))
    if not count_every_add:
        c = visits.first_time_per_day(c, ["user_id"])
    return tumbling_agg(with_event_time(c), {"cart_add_uu_ct": F.count(F.lit(1)).cast("bigint")},
                        size_seconds=size)


def _unique_new_window(rows: DataFrame, uu_name: str, new_name: str, size: int) -> DataFrame:
    """Windows over every row (zero windows kept), with unique users (first
    row per user and day) and new users (first day ever).

    One shuffle of the detail rows: ``g`` = min time per (user, day,
    window), map-side combined.  Every later step reads ``g`` (identical
    subtree, so its exchange is reused) and works on reduced rows: the
    windows that saw events, the first time per (user, day), the first day
    per user (joined back; a hot user is split by the skew-join rule)."""
    size_ms = size * 1000
    r = rows.select("user_id", "ts",
                    F.to_date(F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")).alias("_day"),
                    (F.floor(F.col("ts") / size_ms) * size_ms).alias("_w"))
    g = r.groupBy("user_id", "_day", "_w").agg(F.min("ts").alias("ts"))
    allw = g.groupBy("_w").agg(F.min("ts").alias("_any"))
    daily = g.groupBy("user_id", "_day").agg(F.min("ts").alias("ts"))
    first_day = daily.groupBy("user_id").agg(F.min("_day").alias("_first_day"))
    flags = (daily.join(first_day, "user_id")
             .select((F.floor(F.col("ts") / size_ms) * size_ms).alias("_w"),
                     (F.col("_day") == F.col("_first_day")).cast("bigint").alias("new")))
    fw = flags.groupBy("_w").agg(F.count(F.lit(1)).cast("bigint").alias(uu_name),
                                 F.sum("new").cast("bigint").alias(new_name))
    out = allw.join(fw, "_w", "left")
    start = F.timestamp_millis(F.col("_w"))
    return out.select(
        F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("stt"),
        F.date_format(F.timestamp_millis(F.col("_w") + size_ms), "yyyy-MM-dd HH:mm:ss").alias("edt"),
        F.date_format(start, "yyyyMMdd").alias("cur_date"),
        F.coalesce(F.col(uu_name), F.lit(0).cast("bigint")).alias(uu_name),
        F.coalesce(F.col(new_name), F.lit(0).cast("bigint")).alias(new_name))


def trade_order(order_detail: DataFrame, size: int = WINDOW_SECONDS) -> DataFrame:
    """(window): unique and first-time ordering users."""
    d = order_detail.filter(F.col("user_id").isNotNull() & F.col("source_type_name").isNotNull())
    rows = d.select("user_id", sec_to_ms("ts").alias("ts"))
    return _unique_new_window(rows, "order_unique_user_count", "order_new_user_count", size)


def trade_payment(pay: DataFrame, size: int = WINDOW_SECONDS) -> DataFrame:
    """(window): unique and first-time paying users."""
    rows = pay.select("user_id", sec_to_ms("ts").alias("ts"))
    return _unique_new_window(rows, "payment_suc_unique_user_count",
                              "payment_suc_new_user_count", size)


def trade_sku_order(order_detail: DataFrame, dims: dict, size: int = WINDOW_SECONDS) -> DataFrame:
    """(window, sku): amounts + 10 dimension columns.

    T9 keeps the latest version of each detail id (by ``row_op_ts``, ties by
    the later arrival).  Enrichment runs after aggregation, on one row per
    (window, sku)."""
    d = order_detail.filter(F.col("user_id").isNotNull() & F.col("source_type_name").isNotNull())
    d = d.select("id", "sku_id", "ts", "row_op_ts", "split_original_amount", "split_activity_amount",
                 "split_coupon_amount", "split_total_amount", "arrival")
    d = latest_rows(d, ["id"], ["row_op_ts", "arrival"])
    dec = lambda c: F.coalesce(F.col(c).cast("decimal(16,2)"), F.lit(0).cast("decimal(16,2)"))
    rows = d.select("sku_id", sec_to_ms("ts").alias("ms"),
                    F.coalesce(F.col("split_original_amount").cast("decimal(20,4)"),
                               F.lit(0).cast("decimal(20,4)")).alias("o"),
                    dec("split_activity_amount").alias("a"), dec("split_coupon_amount").alias("c"),
                    dec("split_total_amount").alias("t"))
    g = tumbling_agg(with_event_time(rows, "ms"),
                     {"original_amount": F.sum("o"), "activity_amount": F.sum("a"),
                      "coupon_amount": F.sum("c"), "order_amount": F.sum("t")},
                     keys=["sku_id"], size_seconds=size)
    e = snowflake_sku(g, dims, "sku_id")
    return e.select("stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name",
                    "category2_id", "category2_name", "category3_id", "category3_name",
                    "sku_id", "sku_name", "spu_id", "spu_name", "cur_date",
                    *[F.col(c).cast("double").alias(c) for c in
                      ("original_amount", "activity_amount", "coupon_amount", "order_amount")])


def trade_province_order(order_info_inserts: DataFrame, dims: dict, size: int = WINDOW_SECONDS) -> DataFrame:
    """(window, province): order count and amount, province name default ''
    (A4, J11).  Input: order_info insert records, projected."""
    rows = order_info_inserts.select(
        "province_id", sec_to_ms("ts").alias("ms"),
        F.col("total_amount").cast("decimal(16,2)").alias("amt"))
    g = tumbling_agg(with_event_time(rows, "ms"),
                     {"order_count": F.count(F.lit(1)).cast("bigint"), "order_amount": F.sum("amt")},
                     keys=["province_id"], size_seconds=size)
    e = lookup(g, dims["base_province"], "province_id", {"name": "province_name"})
    return e.select("stt", "edt", "province_id",
                    F.coalesce(F.col("province_name"), F.lit("")).alias("province_name"),
                    "cur_date", "order_count", F.col("order_amount").cast("double").alias("order_amount"))


def refund_tm_category_user(refund: DataFrame, dims: dict, size: int = WINDOW_SECONDS) -> DataFrame:
    """(window, trademark, category3, user): distinct refunded orders (J10,
    A5).  Trademark and category3 are group keys, so the sku hop runs
    before aggregation; the rest after."""
    r = lookup(refund.select("order_id", "user_id", "sku_id", sec_to_ms("ts").alias("ms")),
               dims["sku_info"], "sku_id", {"tm_id": "trademark_id", "category3_id": "category3_id"})
    g = tumbling_agg(with_event_time(r, "ms"),
                     {"refund_count": F.count_distinct("order_id").cast("bigint")},
                     keys=["trademark_id", "category3_id", "user_id"], size_seconds=size)
    e = snowflake_sku(g, dims, with_sku=False)
    return e.select("stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name",
                    "category2_id", "category2_name", "category3_id", "category3_name",
                    "user_id", "cur_date", "refund_count")
