"""The whole warehouse as one batch run, layer by layer.

Detail (DWD) tables are written once to the shared warehouse folder and
read back; every metric (DWS) reads those tables.  This is the reference's
topic boundary between jobs: each detail table is computed once instead of
once per metric, lineage is cut at every layer (a lost executor recomputes
at most one layer), and the written tables live under
``spark.checkpoint.dir`` (shared storage on a cluster) unless a root is
given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.cdc import data, rows_of
from ..operators import logsplit
from ..session import checkpoint_root
from ..sources import fixtures as fx
from ..sources import sinks
from . import dim, log, metrics, tool, trade
from .registry import finalize


class _Layer:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.paths = spark, root.rstrip("/"), {}

    def put(self, name: str, df: DataFrame, partition_by: str | None = None,
            cluster: bool = True) -> DataFrame:
        path = f"{self.root}/{name}"
        if partition_by and cluster:
            df = sinks.clustered(df, partition_by)
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(path)
        self.paths[name] = path
        return self.spark.read.parquet(path)


def build(spark: SparkSession, sf_dir: str, root: str | None = None,
          partition_metrics: bool = False) -> dict[str, str]:
    """Build every dataset from the tables in ``sf_dir``; returns name ->
    path.  With ``partition_metrics`` the metric tables are partitioned by
    ``cur_date`` (K5, the reference's layout); worth it when a day holds
    real volume, not for years of sparse test data (one tiny file per day)."""
    root = root or f"{checkpoint_root(spark).rstrip('/')}/warehouse"
    L = _Layer(spark, root)

    # ---- ODS inputs, derived once from the given tables
    # Partitioned by table: every detail job prunes to its own folders.  The
    # union's partitions each come from one table already, so no clustering
    # step (a range repartition would sample, i.e. recompute, the input).
    env = L.put("ods_topic_db", fx.topic_db(spark, sf_dir), partition_by="table", cluster=False)
    dic = L.put("ods_base_dic", fx.base_dic(spark, sf_dir))
    dims = {k: L.put(f"dim_{k}", v) for k, v in fx.dim_tables(spark, sf_dir).items()}

    # ---- DWD: log layer
    page = L.put("dwd_traffic_page_log", log.flat_page(fx.page_log(spark, sf_dir)))
    # Each line is parsed once and repaired once; the routes read the table.
    clean, dirty = logsplit.parse(fx.raw_log(spark, sf_dir))
    L.put("dwd_log_split_dirty", dirty)
    records = L.put("dwd_log_records", log.repair_records(L.put("ods_log_records", clean)))
    for r, rows in logsplit.route(records).items():
        L.put(f"dwd_log_split_{r}", log.flat_route(r, rows))
    uv = L.put("dwd_traffic_unique_visitor_detail", log.unique_visitor_detail(page))
    uj = L.put("dwd_traffic_user_jump_detail", log.user_jump_detail(page))

    # ---- DWD: trade, tool, interaction, user
    chg = L.put("dwd_trade_order_pre_process_changelog", trade.order_pre_process_changelog(env, dic))
    L.put("dwd_trade_order_pre_process", trade.order_pre_process(chg))
    od = L.put("dwd_trade_order_detail", trade.order_detail(chg))
    L.put("dwd_trade_cancel_detail", trade.cancel_detail(chg))
    cart = L.put("dwd_trade_cart_add", trade.cart_add(env, dic))
    pay = L.put("dwd_trade_pay_detail_suc_changes", trade.pay_detail_suc(od, env, dic, upsert=False))
    L.put("dwd_trade_pay_detail_suc", trade.latest_payments(pay))
    refund = L.put("dwd_trade_order_refund", trade.order_refund(env, dic))
    L.put("dwd_trade_refund_pay_suc", trade.refund_pay_suc(env, dic))
    L.put("dwd_tool_coupon_get", tool.coupon_get(env))
    L.put("dwd_tool_coupon_order", tool.coupon_order(env))
    L.put("dwd_tool_coupon_pay", tool.coupon_pay(env))
    L.put("dwd_interaction_favor_add", tool.favor_add(env))
    L.put("dwd_interaction_comment", tool.comment(env, dic))
    reg = L.put("dwd_user_register", tool.user_register(env))
    L.put("dim_sink", dim.dim_sink(fx.topic_db_dims(spark, sf_dir), fx.table_process_changes(spark)))

    # ---- DWS: metrics from the written detail tables
    oi = rows_of(env, "order_info", ["insert"]).select(
        data("province_id").alias("province_id"), data("total_amount").alias("total_amount"), "ts")
    dws = {
        "dws_keyword_window": metrics.keyword_window(page),
        "dws_traffic_vc_ch_ar_is_new": metrics.traffic_vc_ch_ar_is_new(page, uv_rows=uv, uj_rows=uj),
        "dws_home_detail_uv": metrics.home_detail_uv(page),
        "dws_user_login": metrics.user_login(page),
        "dws_user_register": metrics.user_register(reg),
        "dws_cart_add_uu": metrics.cart_add_uu(cart),
        "dws_trade_order": metrics.trade_order(od),
        "dws_trade_payment": metrics.trade_payment(pay),
        "dws_trade_sku_order": metrics.trade_sku_order(od, dims),
        "dws_trade_province_order": metrics.trade_province_order(oi, dims),
        "dws_refund_tm_category_user": metrics.refund_tm_category_user(refund, dims),
    }
    for name, df in dws.items():
        L.put(name, finalize(df), partition_by="cur_date" if partition_metrics else None)
    return L.paths
