"""Coupon, interaction and user detail tables (simple CDC extracts)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..constants import COUPON_STATUS_UNUSED, COUPON_STATUS_USING
from ..functions.cdc import data, rows_of, transition
from ..functions.timefmt import text_date
from ..operators.enrich import dic_lookup


def coupon_get(env: DataFrame) -> DataFrame:
    c = rows_of(env, "coupon_use", ["insert"])
    return c.select(data("id").alias("id"), data("coupon_id").alias("coupon_id"),
                    data("user_id").alias("user_id"), text_date(data("get_time")).alias("date_id"),
                    data("get_time").alias("get_time"), "ts")


def coupon_order(env: DataFrame) -> DataFrame:
    c = rows_of(env, "coupon_use", ["update"]).filter(
        transition("coupon_status", COUPON_STATUS_UNUSED, COUPON_STATUS_USING))
    return c.select(data("id").alias("id"), data("coupon_id").alias("coupon_id"),
                    data("user_id").alias("user_id"), data("order_id").alias("order_id"),
                    text_date(data("using_time")).alias("date_id"),
                    data("using_time").alias("order_time"), "ts")


def coupon_pay(env: DataFrame) -> DataFrame:
    c = rows_of(env, "coupon_use", ["update"]).filter(data("used_time").isNotNull())
    return c.select(data("id").alias("id"), data("coupon_id").alias("coupon_id"),
                    data("user_id").alias("user_id"), data("order_id").alias("order_id"),
                    text_date(data("used_time")).alias("date_id"),
                    data("used_time").alias("payment_time"), "ts")


def favor_add(env: DataFrame) -> DataFrame:
    f = rows_of(env, "favor_info", ["insert"])
    return f.select(data("id").alias("id"), data("user_id").alias("user_id"),
                    data("sku_id").alias("sku_id"), text_date(data("create_time")).alias("date_id"),
                    data("create_time").alias("create_time"), "ts")


def comment(env: DataFrame, dic: DataFrame) -> DataFrame:
    c = rows_of(env, "comment_info", ["insert"]).select(
        data("id").alias("id"), data("user_id").alias("user_id"), data("sku_id").alias("sku_id"),
        data("order_id").alias("order_id"), data("create_time").alias("create_time"),
        data("appraise").alias("appraise_code"), "ts")
    c = dic_lookup(c, dic, "appraise_code", "appraise_name")
    return c.select("id", "user_id", "sku_id", "order_id", text_date("create_time").alias("date_id"),
                    "create_time", "appraise_code", "appraise_name", "ts")


def user_register(env: DataFrame) -> DataFrame:
    u = rows_of(env, "user_info", ["insert"])
    return u.select(data("id").alias("user_id"), text_date(data("create_time")).alias("date_id"),
                    data("create_time").alias("create_time"), "ts")
