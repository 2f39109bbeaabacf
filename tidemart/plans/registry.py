"""Every dataset as a ``(spark, sf_dir) -> DataFrame`` query over the test
tables: fixture mapping, then the job.  Outputs are made comparable with the
SQL oracle: timestamps as ``yyyy-MM-dd HH:mm:ss`` text, maps as JSON text,
money as text (detail tables) or double (metrics)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import fixtures as fx
from . import dim, log, metrics, tool, trade


HOUR = 3600


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ inputs --
def page(spark, sf) -> DataFrame:
    return log.flat_page(fx.page_log(spark, sf))


def env(spark, sf, *tables) -> DataFrame:
    return fx.topic_db(spark, sf, tables)


def order_env(spark, sf, together=False) -> DataFrame:
    return fx.topic_db(spark, sf, ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon"], keyed=True, together=together)


def changelog(spark, sf) -> DataFrame:
    return trade.order_pre_process_changelog(order_env(spark, sf), fx.base_dic(spark, sf))


def order_detail(spark, sf) -> DataFrame:
    return trade.order_detail(changelog(spark, sf))


def paid_lines(spark, sf, success_only=False, upsert=True) -> DataFrame:
    """Order placements with their payments, then their promotions: all joins
    on the order come before the exchange by detail id."""
    e, dic = order_env(spark, sf), fx.base_dic(spark, sf)
    return trade.pay_detail_suc(trade.order_detail(trade.dated(trade.order_lines(e, dic))), env(spark, sf, "payment_info"), dic,
                                success_only, upsert, promotions=e)


# ------------------------------------------------------------------ queries --
def _split(route: str):
    def q(spark, sf):
        routes = log.log_split(fx.raw_log(spark, sf))
        return log.flat_route(route, routes[route])
    return q


def q_unique_visitor_detail(spark, sf):
    return log.unique_visitor_detail(page(spark, sf)).drop("seq")


def q_user_jump_detail(spark, sf, within=10):
    return log.user_jump_detail(page(spark, sf), within).drop("seq")


def q_trade_order_pre_process(spark, sf):
    return trade.order_pre_process_table(order_env(spark, sf, together=True), fx.base_dic(spark, sf))


def q_trade_order_detail(spark, sf):
    return order_detail(spark, sf).drop("arrival")


def q_trade_cancel_detail(spark, sf):
    return trade.cancel_detail(changelog(spark, sf))


def q_trade_cart_add(spark, sf):
    return trade.cart_add(env(spark, sf, "cart_info"), fx.base_dic(spark, sf))


def q_trade_pay_detail_suc(spark, sf, success_only=False):
    return paid_lines(spark, sf, success_only)


def q_trade_order_refund(spark, sf):
    return trade.order_refund(env(spark, sf, "order_refund_info", "order_info"), fx.base_dic(spark, sf))


def q_trade_refund_pay_suc(spark, sf):
    return trade.refund_pay_suc(env(spark, sf, "refund_payment", "order_info", "order_refund_info"),
                                fx.base_dic(spark, sf))


def q_trade_order_detail_latest(spark, sf):
    return trade.detail_versions_latest(fx.detail_versions(spark, sf)).drop("arrival")


def q_dim_sink(spark, sf):
    rows = dim.dim_sink(fx.topic_db_dims(spark, sf), fx.table_process_changes(spark))
    return rows.select("sink_table", "id", F.explode("data").alias("column_name", "column_value"))


def q_dws_keyword_window(spark, sf):
    return metrics.keyword_window(page(spark, sf))


def q_dws_traffic(spark, sf):
    return metrics.traffic_vc_ch_ar_is_new(page(spark, sf))


def q_dws_home_detail_uv(spark, sf):
    return metrics.home_detail_uv(page(spark, sf))


def q_dws_user_login(spark, sf, back_days=8):
    return metrics.user_login(page(spark, sf), back_days)


def q_dws_user_register(spark, sf):
    return metrics.user_register(tool.user_register(env(spark, sf, "user_info")))


def q_dws_cart_add_uu(spark, sf):
    return metrics.cart_add_uu(q_trade_cart_add(spark, sf))


def q_dws_trade_order(spark, sf):
    return metrics.trade_order(order_detail(spark, sf))


def q_dws_trade_payment(spark, sf):
    # The metric reads the payment topic as a plain stream: every version,
    # not the upserted table.
    return metrics.trade_payment(paid_lines(spark, sf, upsert=False))


def q_dws_trade_sku_order(spark, sf):
    return metrics.trade_sku_order(order_detail(spark, sf), fx.dim_tables(spark, sf))


def q_dws_trade_province_order(spark, sf):
    from ..functions.cdc import data, rows_of
    oi = rows_of(env(spark, sf, "order_info"), "order_info", ["insert"]).select(
        data("province_id").alias("province_id"), data("total_amount").alias("total_amount"), "ts")
    return metrics.trade_province_order(oi, fx.dim_tables(spark, sf))


def q_dws_refund_tm_category_user(spark, sf):
    return metrics.refund_tm_category_user(q_trade_order_refund(spark, sf), fx.dim_tables(spark, sf))


def _tool(fn, *tables, with_dic=False):
    def q(spark, sf):
        e = env(spark, sf, *tables)
        return fn(e, fx.base_dic(spark, sf)) if with_dic else fn(e)
    return q


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dim_sink": q_dim_sink,
    "log_split_page": _split("page"),
    "log_split_start": _split("start"),
    "log_split_display": _split("display"),
    "log_split_action": _split("action"),
    "log_split_error": _split("error"),
    "log_split_dirty": _split("dirty"),
    "unique_visitor_detail": q_unique_visitor_detail,
    "user_jump_detail": q_user_jump_detail,
    "user_jump_detail_6h": lambda s, sf: q_user_jump_detail(s, sf, 6 * 3600),
    "trade_order_pre_process": q_trade_order_pre_process,
    "trade_order_detail": q_trade_order_detail,
    "trade_order_detail_latest": q_trade_order_detail_latest,
    "trade_cancel_detail": q_trade_cancel_detail,
    "trade_cart_add": q_trade_cart_add,
    "trade_pay_detail_suc": q_trade_pay_detail_suc,
    "trade_pay_detail_suc_success_only": lambda s, sf: q_trade_pay_detail_suc(s, sf, True),
    "trade_order_refund": q_trade_order_refund,
    "trade_refund_pay_suc": q_trade_refund_pay_suc,
    "tool_coupon_get": _tool(tool.coupon_get, "coupon_use"),
    "tool_coupon_order": _tool(tool.coupon_order, "coupon_use"),
    "tool_coupon_pay": _tool(tool.coupon_pay, "coupon_use"),
    "interaction_favor_add": _tool(tool.favor_add, "favor_info"),
    "interaction_comment": _tool(tool.comment, "comment_info", with_dic=True),
    "user_register": _tool(tool.user_register, "user_info"),
    "dws_keyword_window": q_dws_keyword_window,
    "dws_traffic_vc_ch_ar_is_new": q_dws_traffic,
    "dws_home_detail_uv": q_dws_home_detail_uv,
    "dws_user_login": q_dws_user_login,
    "dws_user_login_back3": lambda s, sf: q_dws_user_login(s, sf, 3),
    # One-hour windows hold many rows of these tables, ten-second ones hardly two.
    "dws_keyword_window_1h": lambda s, sf: metrics.keyword_window(page(s, sf), HOUR),
    "dws_traffic_vc_ch_ar_is_new_1h": lambda s, sf: metrics.traffic_vc_ch_ar_is_new(page(s, sf), HOUR),
    "dws_home_detail_uv_1h": lambda s, sf: metrics.home_detail_uv(page(s, sf), HOUR),
    "dws_user_login_1h": lambda s, sf: metrics.user_login(page(s, sf), size=HOUR),
    "dws_user_register_1h": lambda s, sf: metrics.user_register(tool.user_register(env(s, sf, "user_info")), HOUR),
    "dws_cart_add_uu_1h": lambda s, sf: metrics.cart_add_uu(q_trade_cart_add(s, sf), HOUR),
    "dws_user_register": q_dws_user_register,
    "dws_cart_add_uu": q_dws_cart_add_uu,
    "dws_trade_order": q_dws_trade_order,
    "dws_trade_payment": q_dws_trade_payment,
    "dws_trade_sku_order": q_dws_trade_sku_order,
    "dws_trade_province_order": q_dws_trade_province_order,
    "dws_refund_tm_category_user": q_dws_refund_tm_category_user,
}


def _wrap(fn):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(fn(spark, sf_dir))
    q.__name__ = getattr(fn, "__name__", "query")
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _wrap(v) for k, v in RAW.items()}
