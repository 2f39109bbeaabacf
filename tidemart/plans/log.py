"""Log layer: log split (+ new-visitor repair), unique visitors, bounces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import JUMP_WITHIN_SECONDS
from ..operators import logsplit, visits

PAGE_COLS = ["mid", "uid", "vc", "ch", "ar", "is_new", "page_id", "last_page_id",
             "item", "item_type", "during_time", "ts"]
COMMON_COLS = ["mid", "uid", "vc", "ch", "ar", "is_new"]


def flat_page(df: DataFrame, *more: str) -> DataFrame:
    """Nested page-log record -> flat columns (+ ``seq`` when present, and
    ``more`` fields of ``common``)."""
    extra = ["seq"] if "seq" in df.columns else []
    extra += [F.col(f"common.{c}").alias(c) for c in more]
    return df.select(*[F.col(f"common.{c}").alias(c) for c in COMMON_COLS],
                     *[F.col(f"page.{c}").alias(c) for c in ("page_id", "last_page_id", "item", "item_type")],
                     F.col("page.during_time").cast("bigint").alias("during_time"), "ts", *extra)


def repair_records(clean: DataFrame) -> DataFrame:
    """T1 over nested records: the repaired flag is written back into
    ``common.is_new``."""
    d = clean.withColumn("_mid", F.col("common.mid")).withColumn("_is_new", F.col("common.is_new"))
    d = visits.repair_new_flag(d, mid="_mid", is_new="_is_new")
    return d.withColumn("common", with_flag(F.col("common"), F.col("_is_new"))).drop("_mid", "_is_new")


def with_flag(common: Column, is_new: Column) -> Column:
    """``common`` with its ``is_new`` replaced (a null flag changes nothing)."""
    rest = F.map_filter(common, lambda k, v: k != "is_new")
    return F.when(is_new.isNull(), common).otherwise(F.map_concat(rest, F.create_map(F.lit("is_new"), is_new)))


def log_split(raw: DataFrame) -> dict[str, DataFrame]:
    """Parse, repair the new-visitor flag, route.  Returns the five routes
    plus ``dirty``; all nested, as written to the detail topics."""
    clean, dirty = logsplit.parse(raw)
    routes = logsplit.route(repair_records(clean))
    routes["dirty"] = dirty
    return routes


def _common_flat(df: DataFrame) -> list:
    return [F.col(f"common.{c}").alias(c) for c in COMMON_COLS]


def flat_route(name: str, df: DataFrame) -> DataFrame:
    """Flat, comparable projection of one routed output."""
    if name == "page":
        return flat_page(df.drop("seq"), "os")
    if name == "start":
        return df.select(*_common_flat(df), F.col("start")["entry"].alias("entry"),
                         F.col("start")["loading_time"].alias("loading_time"), "ts")
    if name == "display":
        d = F.col("display")
        return df.select(*_common_flat(df), F.col("page.page_id").alias("page_id"),
                         F.col("page.last_page_id").alias("last_page_id"),
                         d["display_type"].alias("display_type"), d["item"].alias("display_item"),
                         d["item_type"].alias("display_item_type"), d["order"].alias("display_order"),
                         d["pos_id"].alias("display_pos_id"), "ts")
    if name == "action":
        a = F.col("action")
        return df.select(*_common_flat(df), F.col("page.page_id").alias("page_id"),
                         F.col("page.last_page_id").alias("last_page_id"),
                         a["action_id"].alias("action_id"), a["item"].alias("action_item"),
                         a["item_type"].alias("action_item_type"), a["ts"].alias("action_ts"))
    if name == "error":
        return df.select(*_common_flat(df), F.col("page.page_id").alias("page_id"),
                         F.col("start")["entry"].alias("entry"),
                         F.col("err")["error_code"].alias("error_code"),
                         F.col("err")["msg"].alias("error_msg"), "ts")
    if name == "dirty":
        return df
    raise KeyError(name)


def unique_visitor_detail(page: DataFrame) -> DataFrame:
    """First session-entry page row per (device, day).
    ``page`` is flat with ``seq``."""
    entries = page.filter(F.col("last_page_id").isNull())
    return visits.first_visit_per_day(entries, "mid")


def user_jump_detail(page: DataFrame, within_seconds: int = JUMP_WITHIN_SECONDS) -> DataFrame:
    """Bounced session entries (W3, T3, U2).  ``page`` is flat with ``seq``."""
    return visits.bounce_entries(page, within_seconds * 1000)
