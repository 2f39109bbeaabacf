"""Every job on real topics: what it reads, its batch form, its stream form.

A job reads one topic (files of lines, or Kafka) and, where it enriches, the
dictionary and the dimension tables as files.  ``JOBS`` is what the command
line's ``run-job`` offers.  Jobs feed each other through topics: what one
writes with the ``json`` sink, another reads as its source.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .functions.cdc import data, rows_of
from .operators import dims as dimops
from .plans import log, metrics, tool, trade
from .sources import readers, sinks, snapshots
from .streaming import dims as typed_dims
from .streaming import jobs, runtime

DIM_TABLES = ("sku_info", "spu_info", "base_trademark", "base_category3", "base_category2", "base_category1", "base_province")
CHANGELOG = [*trade.PRE_PROCESS_COLS, "arrival"]
ORDER_DETAIL = [*trade.DETAIL_COMMON, "date_id", "create_time", "source_id", "source_type_code", "source_type_name",
                "sku_num", *trade.SPLIT, "ts", "row_op_ts", "arrival"]
PAYMENT = ["order_detail_id", "order_id", "user_id", "ts"]
REFUND = ["id", "user_id", "order_id", "sku_id", "ts"]
CART = ["id", "user_id", "sku_id", "ts"]


@dataclass
class Inputs:
    """Where a job's inputs are; each is read when it is asked for.

    In a stream, ``limits`` bound what one trigger takes (``maxFilesPerTrigger``,
    ``maxBytesPerTrigger``, Kafka's ``maxOffsetsPerTrigger``), and dictionary,
    dimensions and configuration are read anew for every micro-batch, in the
    newest version of their folder (:mod:`.sources.snapshots`)."""

    spark: SparkSession
    source: str
    fmt: str = "text"
    stream: bool = False
    options: dict | None = None
    dictionary: str | None = None
    dims_root: str | None = None
    config: str | None = None
    details: str | None = None  # the order detail lines, for the payment join
    tz: str = "UTC"
    limits: dict | None = None
    changelog: str | None = None  # the pre-process topic, for the order and cancel details
    visitors: str | None = None  # the unique-visitor and bounce topics, for the traffic metric
    bounces: str | None = None
    lateness: int = 10  # seconds, of the traffic metric from topics

    def lines(self, source: str | None = None) -> DataFrame:
        options = (self.options or {}) | ((self.limits or {}) if self.stream else {})
        return readers.read_topic(self.spark, source or self.source, self.fmt, self.stream, options)

    @cached_property
    def page(self) -> DataFrame:
        return log.flat_page(readers.page_log_records(self.lines()))

    def flat_page(self, source: str) -> DataFrame:
        return readers.flat_page_records(self.lines(source))

    @cached_property
    def changes(self) -> tuple[DataFrame, DataFrame]:
        """The change records of the topic, and its lines that are none."""
        return readers.cdc_records(self.lines(), with_dirty=True)

    @property
    def env(self) -> DataFrame:
        return self.changes[0]

    def dirty(self, output: str) -> jobs.Dirty:
        return self.changes[1], f"{output.rstrip('/')}_dirty"

    def detail(self, columns: list[str], source: str | None = None) -> DataFrame:
        return readers.typed_records(self.lines(source), columns)

    def dic(self) -> DataFrame:
        return snapshots.read(self.spark, self.dictionary)

    def dims(self) -> dict[str, DataFrame]:
        """The tables that ``dim_tables`` keeps (``dim_<name>``), else plain ones."""
        def one(name: str) -> DataFrame:
            if typed_dims.exists(self.spark, self.dims_root, f"dim_{name}"):
                return typed_dims.read_dim(self.spark, self.dims_root, f"dim_{name}")
            return snapshots.read(self.spark, f"{self.dims_root}/{name}.parquet")

        return {t: one(t) for t in DIM_TABLES}

    def fold_config(self) -> DataFrame:
        return dimops.fold_config(snapshots.read(self.spark, self.config))

    @cached_property
    def order_infos(self) -> DataFrame:
        return rows_of(self.env, "order_info", ["insert"]).select(
            data("province_id").alias("province_id"), data("total_amount").alias("total_amount"), "ts")


@dataclass
class Job:
    """``sinks``: what the stream form can write, besides its own table."""

    batch: Callable[[Inputs], DataFrame | dict[str, DataFrame]]
    stream: Callable[[Inputs, str, str], StreamingQuery | list[StreamingQuery]]
    sinks: tuple[str, ...] = ("parquet",)


APPENDS = ("parquet", "json")


def _changes(rows: Callable[[Inputs, DataFrame], DataFrame]) -> Job:
    """A job that maps change records: the same function on the whole topic
    and on every micro-batch, whose dirty lines go to ``<output>_dirty``."""
    def stream(i: Inputs, out: str, name: str) -> StreamingQuery:
        return jobs.changes(i.lines(), lambda env: rows(i, env), jobs.rows_to(out), f"{out.rstrip('/')}_dirty", name)

    return Job(lambda i: rows(i, i.env), stream, APPENDS)


def _changelog(i: Inputs) -> DataFrame:
    return i.detail(CHANGELOG, i.changelog) if i.changelog else trade.order_pre_process_changelog(i.env, i.dic())


def _from_changelog(rows: Callable[[DataFrame], DataFrame], joined: Callable) -> Job:
    """Order lines: from the pre-process topic if it is named, else by the
    pre-process joins."""
    def stream(i: Inputs, out: str, name: str) -> StreamingQuery:
        if i.changelog:
            return jobs.start(rows(_changelog(i)), name, jobs.rows_to(out))
        return joined(i.env, i.dic, out, name=name, dirty=i.dirty(out))

    return Job(lambda i: rows(_changelog(i)), stream, APPENDS)


def _traffic(i: Inputs, out: str, name: str):
    if i.visitors and i.bounces:
        return jobs.traffic_from_topics(i.page, i.flat_page(i.visitors), i.flat_page(i.bounces), out,
                                        lateness_seconds=i.lateness, name=name)
    return jobs.traffic_vc_ch_ar_is_new(i.page, out, i.tz, name=name)


def _traffic_batch(i: Inputs) -> DataFrame:
    return metrics.traffic_vc_ch_ar_is_new(i.page, uv_rows=i.flat_page(i.visitors) if i.visitors else None,
                                           uj_rows=i.flat_page(i.bounces) if i.bounces else None)


def _typed(i: Inputs) -> dict[str, DataFrame]:
    rows = dimops.dim_rows(i.env, i.fold_config())
    return {c.sink_table: dimops.typed_dim(rows, c.sink_table, c.sink_columns) for c in i.fold_config().collect()}  # a row a dimension


def _milliseconds(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", (F.col("ts").cast("bigint") * 1000).alias("ts"))


JOBS: dict[str, Job] = {
    "log_split": Job(lambda i: log.log_split(i.lines()), lambda i, out, n: jobs.log_split(i.lines(), out, i.tz, n), APPENDS),
    "dim_sink": Job(lambda i: dimops.dim_rows(i.env, i.fold_config(), True),
                    lambda i, out, n: jobs.changes(i.lines(), lambda env: dimops.dim_changes(env, i.fold_config()),
                                                   jobs.dims_table(out), f"{out.rstrip('/')}_dirty", n)),
    "dim_tables": Job(_typed, lambda i, out, n: jobs.changes(i.lines(), lambda env: env, typed_dims.writer(i.fold_config, out), f"{out.rstrip('/')}_dirty", n)),
    "unique_visitor_detail": Job(lambda i: log.unique_visitor_detail(i.page).drop("seq"),
                                 lambda i, out, n: jobs.unique_visitor_detail(i.page, out, name=n), APPENDS),
    "user_jump_detail": Job(lambda i: log.user_jump_detail(i.page).drop("seq"),
                            lambda i, out, n: jobs.user_jump_detail(i.page, out, name=n), APPENDS),
    "trade_order_pre_process": Job(lambda i: trade.order_pre_process(trade.order_pre_process_changelog(i.env, i.dic())),
                                   lambda i, out, n: jobs.order_pre_process(i.env, i.dic, out, name=n, dirty=i.dirty(out)), APPENDS),
    "trade_order_detail": _from_changelog(trade.order_detail, jobs.order_detail),
    "trade_cancel_detail": _from_changelog(trade.cancel_detail, jobs.cancel_detail),
    "trade_pay_detail_suc": Job(
        lambda i: trade.pay_detail_suc(i.detail(ORDER_DETAIL, i.details) if i.details else trade.order_detail(_changelog(i)), i.env, i.dic()),
        lambda i, out, n: jobs.pay_detail_suc(i.detail(ORDER_DETAIL, i.details), i.env, i.dic, out, name=n, dirty=i.dirty(out)), APPENDS),
    "trade_order_refund": Job(lambda i: trade.order_refund(i.env, i.dic()),
                              lambda i, out, n: jobs.order_refund(i.env, i.dic, out, name=n, dirty=i.dirty(out)), APPENDS),
    "trade_refund_pay_suc": Job(lambda i: trade.refund_pay_suc(i.env, i.dic()),
                                lambda i, out, n: jobs.refund_pay_suc(i.env, i.dic, out, name=n, dirty=i.dirty(out)), APPENDS),
    "trade_cart_add": _changes(lambda i, env: trade.cart_add(env, i.dic())),
    "tool_coupon_get": _changes(lambda i, env: tool.coupon_get(env)),
    "tool_coupon_order": _changes(lambda i, env: tool.coupon_order(env)),
    "tool_coupon_pay": _changes(lambda i, env: tool.coupon_pay(env)),
    "interaction_favor_add": _changes(lambda i, env: tool.favor_add(env)),
    "interaction_comment": _changes(lambda i, env: tool.comment(env, i.dic())),
    "user_register": _changes(lambda i, env: tool.user_register(env)),
    "dws_keyword_window": Job(lambda i: metrics.keyword_window(i.page), lambda i, out, n: jobs.keyword_window(i.page, out, name=n)),
    "dws_traffic_vc_ch_ar_is_new": Job(_traffic_batch, _traffic),
    "dws_home_detail_uv": Job(lambda i: metrics.home_detail_uv(i.page), lambda i, out, n: jobs.home_detail_uv(i.page, out, i.tz, name=n)),
    "dws_user_login": Job(lambda i: metrics.user_login(i.page), lambda i, out, n: jobs.user_login(i.page, out, tz=i.tz, name=n)),
    "dws_user_register": Job(lambda i: metrics.user_register(i.detail(["user_id", "ts"])),
                             lambda i, out, n: jobs.user_register(i.detail(["user_id", "ts"]), out, name=n)),
    "dws_cart_add_uu": Job(lambda i: metrics.cart_add_uu(i.detail(CART)),
                           lambda i, out, n: jobs.cart_add_uu(i.detail(CART), out, i.tz, name=n)),
    "dws_trade_order": Job(lambda i: metrics.trade_order(i.detail(ORDER_DETAIL)), lambda i, out, n: jobs.trade_unique_new(
        _milliseconds(i.detail(ORDER_DETAIL).filter("user_id IS NOT NULL AND source_type_name IS NOT NULL")), out,
        "order_unique_user_count", "order_new_user_count", i.tz, name=n)),
    "dws_trade_payment": Job(lambda i: metrics.trade_payment(i.detail(PAYMENT)),
                             lambda i, out, n: jobs.trade_payment(i.detail(PAYMENT), out, i.tz, name=n)),
    "dws_trade_sku_order": Job(lambda i: metrics.trade_sku_order(i.detail(ORDER_DETAIL), i.dims()),
                               lambda i, out, n: jobs.trade_sku_order(i.detail(ORDER_DETAIL), i.dims, out, name=n)),
    "dws_trade_province_order": Job(lambda i: metrics.trade_province_order(i.order_infos, i.dims()),
                                    lambda i, out, n: jobs.province_order(i.env, lambda: i.dims()["base_province"], out, name=n, dirty=i.dirty(out))),
    "dws_refund_tm_category_user": Job(lambda i: metrics.refund_tm_category_user(i.detail(REFUND), i.dims()),
                                       lambda i, out, n: jobs.refund_tm_category_user(i.detail(REFUND), i.dims, out, name=n)),
}


def write(df: DataFrame, path: str, sink: str, options: dict | None = None) -> None:
    """K1 / K5: JSON lines (what the next job's topic holds), Kafka, parquet,
    or parquet partitioned by ``cur_date``."""
    if sink == "json":
        sinks.to_json_value(df).write.mode("overwrite").text(path)
    elif sink == "kafka":
        sinks.write_kafka(df, path, options or {})
    elif sink == "olap":
        sinks.olap_write(df, path, df.columns)
    else:
        df.write.mode("overwrite").parquet(path)


def query_name(name: str, output: str) -> str:
    """A job's query and checkpoint belong to its output: started again with
    the same output it goes on, with another it begins anew."""
    return f"{name}-{zlib.crc32(output.rstrip('/').encode()):08x}"


def run(inputs: Inputs, name: str, output: str, sink: str = "parquet", every: str | None = None) -> list[StreamingQuery]:
    """Run one job; returns the streaming queries it started, which take what
    arrives at the interval ``every``, or what is there if it is None."""
    job = JOBS[name]
    if inputs.stream:
        if sink not in job.sinks:
            raise ValueError(f"{name} as a stream writes {' or '.join(job.sinks)}, not {sink}")
        with runtime.settings(every=runtime.interval(every), sink="topic" if sink == "json" else sink):
            started = job.stream(inputs, output, query_name(name, output))
        return started if isinstance(started, list) else [started]
    out = job.batch(inputs)
    for k, df in (out.items() if isinstance(out, dict) else [(None, out)]):
        write(df, f"{output}/{k}" if k else output, sink, inputs.options)
    return []
