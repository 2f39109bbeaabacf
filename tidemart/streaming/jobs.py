"""Streaming jobs: readStream -> transformations -> writeStream.

Sinks are ``foreachBatch`` functions that write each micro-batch into its
own ``batch_id`` partition (idempotent on replay), so every query survives
a restart from its checkpoint.  Checkpoints live under the shared
``spark.checkpoint.dir``.

Window metrics use native watermarked window aggregation in update mode;
the per-key operators use :mod:`.state`, and their flagged rows are
aggregated per micro-batch into partial windows whose sums are the metric
(``read_partial_windows``), the same incremental pre-aggregation the
reference does per window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..constants import (ITEM_TYPE_KEYWORD, JOIN_TTL_ORDER_SECONDS, JOIN_TTL_REFUND_SECONDS, KEYWORD_SOURCE_SEARCH,
                         PAGE_GOOD_DETAIL, PAGE_HOME, PAGE_SEARCH, PAYMENT_STATUS_SUCCESS, WATERMARK_KEYWORD_SECONDS,
                         WINDOW_SECONDS)
from ..functions.cdc import data, rows_of
from ..functions.timefmt import sec_to_ts, text_date
from ..functions.tokenize import explode_keywords
from ..operators import logsplit
from ..operators.enrich import dic_lookup, lookup
from ..operators.windows import tumbling_agg, with_event_time
from ..plans import log as logplans
from ..session import checkpoint_root
from ..sources import sinks
from ..sources.readers import FLAT_PAGE_SCHEMA, cdc_flagged, cdc_split
from . import runtime, state

#: Dimension tables, the dictionary or the configuration: a table, or a
#: function that reads it again for every micro-batch.
Lookup = DataFrame | Callable[[], DataFrame]
Dims = dict[str, DataFrame] | Callable[[], dict[str, DataFrame]]
#: The lines of a job's topic that are no change records, and where they go.
Dirty = tuple[DataFrame, str]


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{name}"


def start(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None], mode: str = "append",
          dirty: Dirty | None = None) -> StreamingQuery:
    """Start a query with a ``foreachBatch`` sink and its own checkpoint, at
    the trigger of :func:`.runtime.settings`.  ``dirty`` lines pass through
    the same query beside its rows and are split off in the sink (Q11)."""
    if dirty is not None:
        df, sink = _beside(df, sink, *dirty)
    w = (df.writeStream.queryName(name).outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint_for(df.sparkSession, name)))
    return runtime.triggered(w).start()


def _beside(df: DataFrame, sink: Callable[[DataFrame, int], None], lines: DataFrame, path: str) -> tuple:
    write, none = rows_to(path), F.lit(None)
    both = (df.select(F.struct("*").alias("row"), none.cast("string").alias("line"))
            .unionByName(lines.select(none.cast(df.schema).alias("row"), "line")))

    def split(batch: DataFrame, bid: int) -> None:
        batch = batch.persist()  # two outputs of one run
        try:
            sink(batch.filter("row IS NOT NULL").select("row.*"), bid)
            bad = batch.filter("row IS NULL").select("line")
            if not bad.isEmpty():
                write(bad, bid)
        finally:
            batch.unpersist()

    return both, split


def rows_to(path: str) -> Callable[[DataFrame, int], None]:
    """The sink of a job that appends rows: replay-safe parquet, or JSON
    lines in a topic folder (:func:`.runtime.settings`)."""
    if runtime.current().sink == "topic":
        return lambda batch, bid: sinks.publish_batch(batch, path, bid)
    return lambda batch, bid: sinks.write_append(batch, path, "parquet", batch_id=bid)


def table_at(path: str, keys: list[str], order=(), measures=(), part: str | None = "cur_date") -> Callable[[DataFrame, int], None]:
    """The sink of a job that keeps a table: every micro-batch is written once
    into its own folder, and every few of them the job folds them into the
    parts (dates, or buckets of the key) they belong to."""
    every = runtime.current().fold_every

    def write(batch: DataFrame, bid: int) -> None:
        sinks.write_append(batch, path, "parquet", batch_id=bid)
        if every and (bid + 1) % every == 0:
            sinks.fold(batch.sparkSession, path, keys, order, measures, part)

    return write


WINDOW = ["stt", "edt", "cur_date"]
DIM_KEY, DIM_ORDER = ["sink_table", "id"], ["ts"]


def now(table):
    """A lookup table as it is at this micro-batch."""
    return table() if callable(table) else table


def page_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Flat page-log rows from a folder of parquet files, in file order."""
    return (spark.readStream.schema(FLAT_PAGE_SCHEMA).option("maxFilesPerTrigger", max_files)
            .parquet(path))


def read_partial_windows(spark: SparkSession, path: str, keys: list[str], measures: list[str],
                         drop_zero: bool = False) -> DataFrame:
    """The metric table from partial window rows: sums per (window, keys);
    ``drop_zero`` leaves out windows whose counts were all taken back."""
    out = sinks.read_sums(spark, path, [*WINDOW, *keys], measures).select(
        *WINDOW, *keys, *[F.col(m).cast("bigint").alias(m) for m in measures])
    return out.filter(" OR ".join(f"{m} <> 0" for m in measures)) if drop_zero else out


# ---------------------------------------------------------------- log layer --
def log_split(raw: DataFrame, out_root: str, tz: str = "UTC", name: str = "log_split") -> list[StreamingQuery]:
    """P1 + T1 + P8/P9 + K3 in one query: every line is parsed once, clean
    records go through the new-visitor state, and one pass over the
    micro-batch writes the five routes (all fields of the records) and the
    dirty lines.  Dirty lines have no device; they pass the state by keys of
    their own, spread over tasks, and leave nothing in it."""
    write = {r: rows_to(f"{out_root.rstrip('/')}/{r}") for r in ("page", "start", "display", "action", "error", "dirty")}
    schema = T.StructType([f for f in logsplit.LOG_SCHEMA.fields if f.name != "_corrupt_record"] + [T.StructField("seq", T.LongType())])
    flagged = logsplit.flagged(raw)
    record = F.to_json(F.struct(*[F.col(f"_j.{f.name}").alias(f.name) for f in schema.fields if f.name != "seq"], "seq"))
    keyed = flagged.select(
        F.when(F.col("_dirty"), F.concat(F.lit("\0"), F.pmod(F.xxhash64("value"), F.lit(1024)).cast("string")))
        .otherwise(F.col("_j.common.mid")).alias("mid"), F.col("_dirty").alias("dirty"),
        F.coalesce(F.col("_j.ts"), F.lit(0)).alias("ts"), "seq", F.col("_j.common.is_new").alias("is_new"),
        F.when(F.col("_dirty"), F.col("value")).otherwise(record).alias("record"))
    fixed = state.repair_new_flag(keyed, tz)

    def sink(batch: DataFrame, bid: int) -> None:
        batch = batch.persist()  # the routes share one parse
        try:
            records = (batch.filter("NOT dirty").select(F.from_json("record", schema).alias("r"), "is_new").select("r.*", "is_new")
                       .withColumn("common", logplans.with_flag(F.col("common"), F.col("is_new"))).drop("is_new"))
            routes = logsplit.route(records) | {"dirty": batch.filter("dirty").select(F.col("record").alias("line"))}
            for route, rows in routes.items():
                write[route](rows, bid)
        finally:
            batch.unpersist()

    return [start(fixed, name, sink)]


def user_jump_detail(page: DataFrame, out_path: str, within_seconds: int = 10,
                     name: str = "user_jump_detail") -> StreamingQuery:
    """W3 + T3: bounced entries, released by the next row or the watermark."""
    rows = (page.withColumn("row_time", F.timestamp_millis("ts")).withWatermark("row_time", "0 seconds")
            .select("mid", "ts", "seq", F.col("last_page_id").isNull().alias("is_entry"),
                    F.to_json(F.struct(*[c for c in page.columns if c != "seq"])).alias("record"),
                    "row_time"))
    out = state.bounce_entries(rows, within_seconds * 1000)
    recs = out.select(F.from_json("record", FLAT_PAGE_SCHEMA).alias("r")).select("r.*").drop("seq")
    return start(recs, name, rows_to(out_path))


# ------------------------------------------------------------------ metrics --
def home_detail_uv(page: DataFrame, out_path: str, tz: str = "UTC", size: int = WINDOW_SECONDS,
                   name: str = "dws_home_detail_uv") -> StreamingQuery:
    """P11 + T4 state + per-batch partial windows."""
    p = page.filter(F.col("page_id").isin(PAGE_HOME, PAGE_GOOD_DETAIL)).select("mid", "page_id", "ts", "seq")
    firsts = state.first_per_day(p, ["mid", "page_id"])
    write = table_at(out_path, WINDOW, measures=["home_uv_ct", "good_detail_uv_ct"])

    def sink(batch: DataFrame, bid: int) -> None:
        flags = batch.select("ts", (F.col("page_id") == PAGE_HOME).cast("bigint").alias("home"),
                             (F.col("page_id") == PAGE_GOOD_DETAIL).cast("bigint").alias("detail"))
        part = tumbling_agg(with_event_time(flags), {"home_uv_ct": F.sum("home").cast("bigint"),
                                                     "good_detail_uv_ct": F.sum("detail").cast("bigint")},
                            size_seconds=size)
        write(part, bid)

    return start(firsts, name, sink)


def trade_unique_new(rows: DataFrame, out_path: str, uu: str, new: str, tz: str = "UTC",
                     size: int = WINDOW_SECONDS, name: str = "dws_trade_order", keep_days: int = 2) -> StreamingQuery:
    """T6 / T7 state + per-batch partial windows; windows with events but no
    unique user still get a 0/0 row.  Rows up to ``keep_days`` late count."""
    flags = state.unique_new_flags(rows.select("user_id", "ts"), tz, keep_days)
    write = table_at(out_path, WINDOW, measures=[uu, new])

    def sink(batch: DataFrame, bid: int) -> None:
        part = tumbling_agg(with_event_time(batch), {uu: F.sum("uu").cast("bigint"),
                                                     new: F.sum("new").cast("bigint")}, size_seconds=size)
        write(part, bid)

    return start(flags, name, sink)


def traffic_vc_ch_ar_is_new(page: DataFrame, out_root: str, tz: str = "UTC", size: int = WINDOW_SECONDS,
                            lateness_seconds: int = 10, jump_within_seconds: int = 10,
                            jump_page: DataFrame | None = None,
                            name: str = "dws_traffic_vc_ch_ar_is_new") -> list[StreamingQuery]:
    """P15 + U1 + W5/W6 + A2 as three queries writing into one metric:

    - page views: native window aggregation, watermark = allowed lateness
      (later rows are dropped, as in the reference), update mode, upserted;
    - unique visitors: first entry per (device, day) state, partial windows;
    - bounces: bounce state, counted ``JUMP_SHIFT`` later, partial windows.

    :func:`read_traffic` adds the three parts per (window, vc, ch, ar,
    is_new).  ``jump_page`` lets the bounce query read its own copy of the
    stream (a source can feed several queries)."""
    from ..constants import JUMP_SHIFT_SECONDS
    keys = ["vc", "ch", "ar", "is_new"]
    pv = (with_event_time(page, watermark_seconds=lateness_seconds)
          .select(*keys, "row_time", F.col("last_page_id").isNull().cast("bigint").alias("sv"),
                  F.coalesce(F.col("during_time"), F.lit(0)).cast("bigint").alias("dur")))
    pv = tumbling_agg(pv, {"sv_ct": F.sum("sv").cast("bigint"), "pv_ct": F.count(F.lit(1)).cast("bigint"),
                           "dur_sum": F.sum("dur").cast("bigint")}, keys=keys, size_seconds=size)
    q_pv = start(pv, f"{name}_pv", table_at(f"{out_root}/pv", ["stt", *keys]), mode="update")
    write_uv = table_at(f"{out_root}/uv", [*WINDOW, *keys], measures=["uv_ct"])
    write_uj = table_at(f"{out_root}/uj", [*WINDOW, *keys], measures=["uj_ct"])

    entries = page.filter(F.col("last_page_id").isNull()).select("mid", *keys, "ts", "seq")

    def uv_fn(batch: DataFrame, bid: int) -> None:
        part = tumbling_agg(with_event_time(batch), {"uv_ct": F.count(F.lit(1)).cast("bigint")},
                            keys=keys, size_seconds=size)
        write_uv(part, bid)

    firsts = state.first_per_day(entries, ["mid"])
    q_uv = start(firsts, f"{name}_uv", uv_fn)

    src = jump_page if jump_page is not None else page
    rows = (src.withColumn("row_time", F.timestamp_millis("ts")).withWatermark("row_time", "0 seconds")
            .select("mid", "ts", "seq", F.col("last_page_id").isNull().alias("is_entry"),
                    F.to_json(F.struct(*keys)).alias("record"), "row_time"))
    bounced = state.bounce_entries(rows, jump_within_seconds * 1000)
    dims_schema = "vc string, ch string, ar string, is_new string"
    uj = bounced.select(F.from_json("record", dims_schema).alias("r"),
                        (F.col("ts") + JUMP_SHIFT_SECONDS * 1000).alias("ts")).select("r.*", "ts")

    def uj_fn(batch: DataFrame, bid: int) -> None:
        part = tumbling_agg(with_event_time(batch), {"uj_ct": F.count(F.lit(1)).cast("bigint")},
                            keys=keys, size_seconds=size)
        write_uj(part, bid)

    q_uj = start(uj, f"{name}_uj", uj_fn)
    return [q_pv, q_uv, q_uj]


def traffic_from_topics(page: DataFrame, uv: DataFrame, uj: DataFrame, out_path: str, size: int = WINDOW_SECONDS,
                        lateness_seconds: int = 10, name: str = "dws_traffic_vc_ch_ar_is_new") -> StreamingQuery:
    """P15 + U1 + W5/W6 + A2 over the page, unique-visitor and bounce topics,
    as one window aggregation: one rule of lateness for all measures.  The
    watermark is that of the input furthest behind, so a topic that lags
    (bounces wait for their horizon) loses nothing; rows more than
    ``lateness_seconds`` behind it are dropped.  Update mode, upserted."""
    from ..plans.metrics import TRAFFIC_KEYS, traffic_measures, traffic_rows
    parts = [with_event_time(p, watermark_seconds=lateness_seconds) for p in traffic_rows(page, uv, uj)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return start(tumbling_agg(rows, traffic_measures(), keys=TRAFFIC_KEYS, size_seconds=size), name,
                 table_at(out_path, ["stt", *TRAFFIC_KEYS]), mode="update")


def read_traffic(spark: SparkSession, out_root: str) -> DataFrame:
    """The traffic metric: upserted page-view windows plus the summed
    unique-visitor and bounce partials, per (window, vc, ch, ar, is_new)."""
    keys = ["stt", "edt", "cur_date", "vc", "ch", "ar", "is_new"]
    pv = sinks.read_upserted(spark, f"{out_root}/pv", ["stt", "vc", "ch", "ar", "is_new"])
    z = F.lit(0).cast("bigint")
    parts = [pv.select(*keys, z.alias("uv_ct"), "sv_ct", "pv_ct", "dur_sum", z.alias("uj_ct"))]
    for sub, col in (("uv", "uv_ct"), ("uj", "uj_ct")):
        if not sinks.exists(spark, f"{out_root}/{sub}"):
            continue  # no rows yet; any other trouble shows when it is read
        p = sinks.read_changes(spark, f"{out_root}/{sub}")
        parts.append(p.select(*keys, *[(F.col(col) if c == col else z).alias(c)
                                       for c in ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return (u.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c)
                                   for c in ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")])
            .select("stt", "edt", "vc", "ch", "ar", "is_new", "cur_date", "uv_ct", "sv_ct", "pv_ct",
                    "dur_sum", "uj_ct"))


def user_login(page: DataFrame, out_path: str, back_days: int = 8, tz: str = "UTC",
               size: int = WINDOW_SECONDS, name: str = "dws_user_login", keep_days: int = 2) -> StreamingQuery:
    """P12 + T5 state + per-batch partial windows (:func:`read_logins`).
    Rows up to ``keep_days`` late count."""
    logins = page.filter(F.col("uid").isNotNull()
                         & (F.col("last_page_id").isNull() | (F.col("last_page_id") == "login")))
    flags = state.login_flags(logins.select("uid", "ts"), back_days, tz, keep_days)
    write = table_at(out_path, WINDOW, measures=["back_ct", "uu_ct"])

    def sink(batch: DataFrame, bid: int) -> None:
        part = tumbling_agg(with_event_time(batch), {"back_ct": F.sum("back_ct").cast("bigint"),
                                                     "uu_ct": F.sum("uu_ct").cast("bigint")}, size_seconds=size)
        write(part, bid)

    return start(flags, name, sink)


def read_logins(spark: SparkSession, path: str) -> DataFrame:
    """The login metric; windows without a unique user aren't part of it."""
    return read_partial_windows(spark, path, [], ["back_ct", "uu_ct"], drop_zero=True)


def keyword_window(page: DataFrame, out_path: str, size: int = WINDOW_SECONDS,
                   watermark_seconds: int = WATERMARK_KEYWORD_SECONDS,
                   name: str = "dws_keyword_window") -> StreamingQuery:
    """S4 + P13 + F1 + W1/W4 + A1: native watermarked window count, update
    mode, upserted on (stt, keyword) by the sink."""
    s = page.filter(F.col("item").isNotNull() & (F.col("last_page_id") == PAGE_SEARCH)
                    & (F.col("item_type") == ITEM_TYPE_KEYWORD))
    s = (s.select(F.date_trunc("second", F.timestamp_millis("ts")).alias("row_time"), "item")
         .withWatermark("row_time", f"{watermark_seconds} seconds"))
    words = explode_keywords(s, "item").select("row_time", "keyword")
    g = tumbling_agg(words, {"keyword_count": F.count(F.lit(1)).cast("bigint")}, keys=["keyword"],
                     size_seconds=size)
    g = g.select("stt", "edt", F.lit(KEYWORD_SOURCE_SEARCH).alias("source"), "keyword", "cur_date",
                 "keyword_count")
    return start(g, name, table_at(out_path, ["stt", "keyword"]), mode="update")


def province_order(cdc: DataFrame, province_dim: Lookup, out_path: str, size: int = WINDOW_SECONDS,
                   name: str = "dws_trade_province_order", dirty: Dirty | None = None) -> StreamingQuery:
    """S2 + P2 + W1/W3 + A4, then J11 against the province dimension as it is
    at the micro-batch; update mode, upserted on (stt, province_id)."""
    oi = rows_of(cdc, "order_info", ["insert"]).select(
        data("province_id").alias("province_id"),
        data("total_amount").cast("decimal(16,2)").alias("amt"), sec_to_ts("ts").alias("row_time"))
    g = tumbling_agg(oi.withWatermark("row_time", "0 seconds"),
                     {"order_count": F.count(F.lit(1)).cast("bigint"), "order_amount": F.sum("amt")},
                     keys=["province_id"], size_seconds=size)
    write = table_at(out_path, ["stt", "province_id"])

    def sink(batch: DataFrame, bid: int) -> None:
        e = lookup(batch, now(province_dim), "province_id", {"name": "province_name"})
        e = e.select("stt", "edt", "province_id",
                     F.coalesce(F.col("province_name"), F.lit("")).alias("province_name"), "cur_date",
                     "order_count", F.col("order_amount").cast("double").alias("order_amount"))
        write(e, bid)

    return start(g, name, sink, mode="update", dirty=dirty)


def order_pre_process_changelog(cdc: DataFrame, dic: DataFrame,
                                ttl_seconds: int = JOIN_TTL_ORDER_SECONDS) -> DataFrame:
    """J1 + J2 + J6 as stream joins: order lines join every order_info
    insert / update and their activity / coupon rows within ``ttl_seconds``
    of event time (the reference's state TTL as an event-time bound), then
    the dictionary (stream-static).  Append mode: a line without activity
    is emitted once the watermark passes its bound."""
    from ..plans.trade import PRE_PROCESS_COLS, arrival
    wm = f"{ttl_seconds} seconds"
    od = (rows_of(cdc, "order_detail", ["insert"]).select(
        *[data(k).alias(k) for k in ("id", "order_id", "sku_id", "sku_name", "create_time", "source_id",
                                     "source_type", "sku_num", "split_total_amount",
                                     "split_activity_amount", "split_coupon_amount")],
        (data("sku_num").cast("decimal(16,2)") * data("order_price").cast("decimal(16,2)"))
        .cast("string").alias("split_original_amount"),
        F.col("ts").alias("od_ts"), sec_to_ts("ts").alias("od_time")).withWatermark("od_time", wm))
    oi = (rows_of(cdc, "order_info", ["insert", "update"]).select(
        data("id").alias("oi_id"), data("user_id").alias("user_id"),
        data("province_id").alias("province_id"), data("operate_time").alias("operate_time"),
        data("order_status").alias("order_status"), "type", "old", F.col("ts").alias("oi_ts"), arrival(cdc),
        sec_to_ts("ts").alias("oi_time")).withWatermark("oi_time", wm))
    act = (rows_of(cdc, "order_detail_activity", ["insert"]).select(
        data("order_detail_id").alias("act_od_id"), data("activity_id").alias("activity_id"),
        data("activity_rule_id").alias("activity_rule_id"), sec_to_ts("ts").alias("act_time"))
        .withWatermark("act_time", wm))
    cou = (rows_of(cdc, "order_detail_coupon", ["insert"]).select(
        data("order_detail_id").alias("cou_od_id"), data("coupon_id").alias("coupon_id"),
        sec_to_ts("ts").alias("cou_time")).withWatermark("cou_time", wm))
    bound = lambda a, b: F.expr(f"{b} BETWEEN {a} - INTERVAL {ttl_seconds} SECONDS "
                                f"AND {a} + INTERVAL {ttl_seconds} SECONDS")
    j = od.join(act, (od.id == act.act_od_id) & bound("od_time", "act_time"), "leftOuter")
    j = j.join(cou, (j.id == cou.cou_od_id) & bound("od_time", "cou_time"), "leftOuter")
    j = j.join(oi, (j.order_id == oi.oi_id) & bound("od_time", "oi_time"), "inner")
    if dic is not None:
        j = dic_lookup(j, dic, "source_type", "source_type_name")
    else:  # the sink looks it up
        j = j.withColumn("source_type_name", F.lit(None).cast("string"))
    j = (j.withColumn("date_id", text_date("create_time"))
          .withColumn("operate_date_id", text_date("operate_time"))
          .withColumn("row_op_ts", F.greatest(F.col("od_time"), F.col("oi_time"))))
    return j.select(*PRE_PROCESS_COLS, "arrival")


def _named(rows: DataFrame, dic: Lookup) -> DataFrame:
    """Rows with the source type's name in the dictionary as it is now."""
    return dic_lookup(rows, now(dic), "source_type", "source_type_name").select(*rows.columns)


def order_pre_process(cdc: DataFrame, dic: Lookup, out_path: str,
                      ttl_seconds: int = JOIN_TTL_ORDER_SECONDS,
                      name: str = "trade_order_pre_process", dirty: Dirty | None = None) -> StreamingQuery:
    """K2: the changelog upserted on the detail id (merge-on-read, see
    :func:`read_pre_process`); as a topic, every version of it, from which
    the order and cancel details are filtered.  The dictionary is looked up
    as it is at the micro-batch."""
    ch = order_pre_process_changelog(cdc, None, ttl_seconds)
    topic = runtime.current().sink == "topic"
    write = rows_to(out_path) if topic else table_at(out_path, ["id"], pre_process_order(), part=None)
    return start(ch, name, lambda b, i: write(_named(b, dic), i), dirty=dirty)


def pre_process_order() -> list:
    """The rule of the batch form, whatever batch a version came in."""
    return ["row_op_ts", F.col("oi_ts").cast("bigint"), "arrival"]


def read_pre_process(spark: SparkSession, path: str) -> DataFrame:
    return sinks.read_upserted(spark, path, ["id"], pre_process_order())


def order_detail(cdc: DataFrame, dic: Lookup, out_path: str,
                 ttl_seconds: int = JOIN_TTL_ORDER_SECONDS, name: str = "trade_order_detail", dirty: Dirty | None = None) -> StreamingQuery:
    """S3 filter over the pre-process changelog: order placements, with the
    columns of the batch form (T9 orders by the last two)."""
    from ..plans import trade
    ch = order_pre_process_changelog(cdc, None, ttl_seconds)
    write = rows_to(out_path)
    return start(ch.filter(F.col("type") == "insert"), name, lambda b, i: write(trade.order_detail(_named(b, dic)), i), dirty=dirty)


def cancel_detail(cdc: DataFrame, dic: Lookup, out_path: str, ttl_seconds: int = JOIN_TTL_ORDER_SECONDS,
                  name: str = "trade_cancel_detail", dirty: Dirty | None = None) -> StreamingQuery:
    """P3 over the pre-process changelog: order lines whose order was
    cancelled, as the batch form selects them."""
    from ..plans import trade
    ch = order_pre_process_changelog(cdc, None, ttl_seconds)
    write = rows_to(out_path)
    return start(ch.filter(F.col("type") == "update"), name, lambda b, i: write(trade.cancel_detail(_named(b, dic)), i), dirty=dirty)


def unique_visitor_detail(page: DataFrame, out_path: str, keep_days: int = 2,
                          name: str = "unique_visitor_detail") -> StreamingQuery:
    """P10 + T2: the first session entry of every (device, day)."""
    entries = page.filter(F.col("last_page_id").isNull())
    out = state.first_per_day(entries, ["mid"], keep_days).drop("seq")
    return start(out, name, rows_to(out_path))


def _timed(rows: DataFrame, ts: str, time: str, ttl_seconds: int) -> DataFrame:
    return rows.withColumn(time, sec_to_ts(ts)).withWatermark(time, f"{ttl_seconds} seconds")


def _within(a: str, b: str, ttl_seconds: int):
    return F.expr(f"{b} BETWEEN {a} - INTERVAL {ttl_seconds} SECONDS AND {a} + INTERVAL {ttl_seconds} SECONDS")


def pay_detail_suc(order_detail_rows: DataFrame, cdc: DataFrame, dic: Lookup, out_path: str,
                   ttl_seconds: int = JOIN_TTL_ORDER_SECONDS, success_only: bool = False,
                   name: str = "trade_pay_detail_suc", dirty: Dirty | None = None) -> StreamingQuery:
    """J3 + J6 + K2: order lines and payments that come within ``ttl_seconds``
    of each other, upserted on the detail id (:func:`read_payments`)."""
    from ..plans import trade
    p = rows_of(cdc, "payment_info")
    if success_only:
        p = p.filter((F.col("type") == "update") & (data("payment_status") == PAYMENT_STATUS_SUCCESS))
    p = _timed(p.select(data("order_id").alias("pi_order_id"), data("payment_type").alias("payment_type_code"),
                        data("callback_time").alias("callback_time"), F.col("ts").alias("pi_ts"), trade.arrival(cdc)),
               "pi_ts", "pi_time", ttl_seconds)
    od = _timed(order_detail_rows.drop("arrival"), "ts", "od_time", ttl_seconds)
    j = od.join(p, (od.order_id == p.pi_order_id) & _within("od_time", "pi_time", ttl_seconds), "inner").drop("od_time", "pi_time")
    topic = runtime.current().sink == "topic"
    write = rows_to(out_path) if topic else table_at(out_path, ["order_detail_id"], payment_order(), part=None)
    return start(j, name, lambda b, i: write(trade.pay_columns(dic_lookup(b, now(dic), "payment_type_code", "payment_type_name")), i), dirty=dirty)


def payment_order() -> list:
    return [F.col("ts").cast("bigint"), "arrival"]


def read_payments(spark: SparkSession, path: str) -> DataFrame:
    return sinks.read_upserted(spark, path, ["order_detail_id"], payment_order()).drop("arrival")


def order_refund(cdc: DataFrame, dic: Lookup, out_path: str, ttl_seconds: int = JOIN_TTL_REFUND_SECONDS,
                 name: str = "trade_order_refund", dirty: Dirty | None = None) -> StreamingQuery:
    """J4 + J7: refund lines and the refund update of their order, within
    ``ttl_seconds`` of each other."""
    from ..plans import trade
    ri, oi = trade.refund_sides(cdc)
    ri, oi = _timed(ri, "ts", "ri_time", ttl_seconds), _timed(oi, "oi_ts", "oi_time", ttl_seconds)
    j = ri.join(oi, (ri.order_id == oi.oi_id) & _within("ri_time", "oi_time", ttl_seconds), "inner").drop("ri_time", "oi_time")
    write = rows_to(out_path)
    return start(j, name, lambda b, i: write(trade.refund_columns(b, now(dic)), i), dirty=dirty)


def refund_pay_suc(cdc: DataFrame, dic: Lookup, out_path: str, ttl_seconds: int = JOIN_TTL_REFUND_SECONDS,
                   strict: bool = False, name: str = "trade_refund_pay_suc", dirty: Dirty | None = None) -> StreamingQuery:
    """J5 + J6: refund payment, order and refund line, each within
    ``ttl_seconds`` of the payment."""
    from ..plans import trade
    rp, oi, ri = trade.refund_pay_sides(cdc, strict)
    rp, oi, ri = (_timed(rp, "ts", "rp_time", ttl_seconds), _timed(oi, "oi_ts", "oi_time", ttl_seconds),
                  _timed(ri, "ri_ts", "ri_time", ttl_seconds))
    j = rp.join(oi, (rp.order_id == oi.oi_id) & _within("rp_time", "oi_time", ttl_seconds), "inner").drop("oi_time")
    j = j.join(ri, (j.order_id == ri.ri_order_id) & (j.sku_id == ri.ri_sku_id) & _within("rp_time", "ri_time", ttl_seconds), "inner").drop("rp_time", "ri_time")
    write = rows_to(out_path)
    return start(j, name, lambda b, i: write(trade.refund_pay_columns(b, now(dic)), i), dirty=dirty)


def trade_sku_order(order_detail_rows: DataFrame, dims: Dims, out_path: str, size: int = WINDOW_SECONDS,
                    watermark_seconds: int = 5, name: str = "dws_trade_sku_order") -> StreamingQuery:
    """P14 + T9 + W1/W4 + A3 + J9.  All versions of a detail id share its
    ``ts``, so T9 is a window aggregation too: latest version per (window,
    id) by (row_op_ts, arrival), then sums per (window, sku).  The chain of
    two window aggregations runs in append mode; the enrichment joins the
    dimensions as they are at the micro-batch."""
    d = order_detail_rows.filter(F.col("user_id").isNotNull() & F.col("source_type_name").isNotNull())
    d = (d.withColumn("row_time", sec_to_ts("ts")).withWatermark("row_time", f"{watermark_seconds} seconds"))
    dec = lambda c: F.coalesce(F.col(c).cast("decimal(16,2)"), F.lit(0).cast("decimal(16,2)"))
    latest = (d.groupBy(F.window("row_time", f"{size} seconds").alias("w1"), "id")
               .agg(F.max_by(F.struct("sku_id",
                                      F.coalesce(F.col("split_original_amount").cast("decimal(20,4)"),
                                                 F.lit(0).cast("decimal(20,4)")).alias("o"),
                                      dec("split_activity_amount").alias("a"),
                                      dec("split_coupon_amount").alias("c"),
                                      dec("split_total_amount").alias("t")),
                             F.struct("row_op_ts", "arrival")).alias("v"))
               .select(F.window_time("w1").alias("row_time"), "v.*"))
    g = tumbling_agg(latest, {"original_amount": F.sum("o"), "activity_amount": F.sum("a"),
                              "coupon_amount": F.sum("c"), "order_amount": F.sum("t")},
                     keys=["sku_id"], size_seconds=size)
    write = table_at(out_path, ["stt", "sku_id"])

    def sink(batch: DataFrame, bid: int) -> None:
        from ..operators.enrich import snowflake_sku
        e = snowflake_sku(batch, now(dims), "sku_id")
        e = e.select("stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name",
                     "category2_id", "category2_name", "category3_id", "category3_name", "sku_id", "sku_name",
                     "spu_id", "spu_name", "cur_date",
                     *[F.col(c).cast("double").alias(c) for c in
                       ("original_amount", "activity_amount", "coupon_amount", "order_amount")])
        write(e, bid)

    return start(g, name, sink, mode="append")


def refund_tm_category_user(refund_rows: DataFrame, dims: Dims, out_path: str, size: int = WINDOW_SECONDS,
                            name: str = "dws_refund_tm_category_user") -> StreamingQuery:
    """J10 + W1/W3 + A5: trademark / category3 (stream-static join before the
    aggregation, they are group keys: as the skus are at the start), distinct
    orders as ``size(collect_set)`` (streaming count-distinct is not
    supported), rest of the snowflake as it is at the micro-batch; update
    mode, upserted."""
    from ..operators.enrich import snowflake_sku
    r = lookup(refund_rows.select("order_id", "user_id", "sku_id", sec_to_ts("ts").alias("row_time")),
               now(dims)["sku_info"], "sku_id", {"tm_id": "trademark_id", "category3_id": "category3_id"})
    g = tumbling_agg(r.withWatermark("row_time", "0 seconds"),
                     {"refund_count": F.size(F.collect_set("order_id")).cast("bigint")},
                     keys=["trademark_id", "category3_id", "user_id"], size_seconds=size)
    write = table_at(out_path, ["stt", "trademark_id", "category3_id", "user_id"])

    def sink(batch: DataFrame, bid: int) -> None:
        e = snowflake_sku(batch, now(dims), with_sku=False)
        e = e.select("stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name",
                     "category2_id", "category2_name", "category3_id", "category3_name", "user_id",
                     "cur_date", "refund_count")
        write(e, bid)

    return start(g, name, sink, mode="update")


def cart_add_uu(cart_rows: DataFrame, out_path: str, tz: str = "UTC", size: int = WINDOW_SECONDS,
                count_every_add: bool = False, name: str = "dws_cart_add_uu") -> StreamingQuery:
    """T8 (first add per user and day, keyed state) + A6 partial windows.
    ``count_every_add`` keeps the reference's literal behaviour."""
    c = cart_rows.select("user_id", (F.col("ts").cast("bigint") * 1000).alias("ts"),
                         F.col("id").cast("bigint").alias("seq"))
    firsts = c if count_every_add else state.first_per_day(c, ["user_id"])
    write = table_at(out_path, WINDOW, measures=["cart_add_uu_ct"])

    def sink(batch: DataFrame, bid: int) -> None:
        part = tumbling_agg(with_event_time(batch), {"cart_add_uu_ct": F.count(F.lit(1)).cast("bigint")},
                            size_seconds=size)
        write(part, bid)

    return start(firsts.select("ts"), name, sink)


def user_register(register_rows: DataFrame, out_path: str, size: int = WINDOW_SECONDS,
                  name: str = "dws_user_register") -> StreamingQuery:
    """W1/W3 + A6: registrations per window, native watermarked count."""
    r = register_rows.select(sec_to_ts("ts").alias("row_time")).withWatermark("row_time", "0 seconds")
    g = tumbling_agg(r, {"register_ct": F.count(F.lit(1)).cast("bigint")}, size_seconds=size)
    return start(g, name, table_at(out_path, ["stt"]), mode="update")


def trade_payment(pay_rows: DataFrame, out_path: str, tz: str = "UTC", size: int = WINDOW_SECONDS,
                  name: str = "dws_trade_payment") -> StreamingQuery:
    """T7 + A7: the payment form of :func:`trade_unique_new`."""
    rows = pay_rows.select("user_id", (F.col("ts").cast("bigint") * 1000).alias("ts"))
    return trade_unique_new(rows, out_path, "payment_suc_unique_user_count", "payment_suc_new_user_count",
                            tz, size, name)


def changes(lines: DataFrame, rows: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None],
            dirty_path: str, name: str) -> StreamingQuery:
    """A job that maps change records, straight from the topic's lines: one
    parse feeds the rows and the dirty lines (Q11), which are written under
    ``dirty_path``, with one checkpoint.  ``rows`` is applied to each
    micro-batch, so lookups inside it are as fresh as it makes them."""
    write_dirty = rows_to(dirty_path)

    def sink(batch: DataFrame, bid: int) -> None:
        batch = cdc_flagged(batch).persist()
        try:
            records, dirty = cdc_split(batch)
            write(rows(records), bid)
            if not dirty.isEmpty():
                write_dirty(dirty, bid)
        finally:
            batch.unpersist()

    return start(lines, name, sink)


def dim_sink(cdc: DataFrame, config: Lookup, out_path: str, name: str = "dim_sink") -> StreamingQuery:
    """S2 + S6 + P6 + J12 + P7 + T10 + K4: dimension change records,
    whitelisted and stored with their type and time; :func:`read_dims` folds
    them by the rule of the batch form, deletes included.  ``config`` may be
    a function: it is then called for every micro-batch, so tables added,
    changed or removed in the configuration take effect while the job runs
    (for the changes that come after, as in the reference)."""
    from ..operators import dims as dimops
    write = dims_table(out_path)
    return start(cdc, name, lambda b, i: write(dimops.dim_changes(b, now(config)), i))


def dims_table(path: str) -> Callable[[DataFrame, int], None]:
    """K4: the latest change per (table, key); deletes are kept as changes."""
    return table_at(path, DIM_KEY, DIM_ORDER, part=None)


def read_dims(spark: SparkSession, path: str, apply_deletes: bool = False) -> DataFrame:
    """The latest row per (table, key) by change time, ties by the later batch."""
    from ..operators import dims as dimops
    return dimops.current_dims(sinks.read_changes(spark, path), apply_deletes, ("ts", "batch_id"))


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """An update-mode metric table: the latest row per key."""
    return sinks.read_upserted(spark, path, keys)

