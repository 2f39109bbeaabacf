"""Batch / stream parity: the same input, split into event-time ordered
files, through the streaming jobs; results equal the batch jobs."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemart.plans import log as logplans
from tidemart.plans import metrics, trade
from tidemart.plans import registry as R
from tidemart.sources import fixtures as fx
from tidemart.sources import sinks
from tidemart.streaming import jobs

N_FILES = 6


def _ordered_files(df, order_col, path):
    """Write ``df`` as N files in ascending ``order_col`` ranges and give
    them increasing modification times (the file source's order)."""
    (df.repartitionByRange(N_FILES, order_col).sortWithinPartitions(order_col)
       .write.mode("overwrite").parquet(path))
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    for i, f in enumerate(files):
        os.utime(os.path.join(path, f), (1_000_000 + i, 1_000_000 + i))
    return path


@pytest.fixture(scope="module")
def page_dir(spark):
    page = R.page(spark, SF_SMALL)
    return _ordered_files(page, "ts", tempfile.mkdtemp(prefix="page-") + "/in")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_home_detail_uv_stream_equals_batch(spark, page_dir):
    out = tempfile.mkdtemp(prefix="hduv-") + "/out"
    q = jobs.home_detail_uv(jobs.page_stream(spark, page_dir), out, name="t_hduv")
    q.awaitTermination()
    got = jobs.read_partial_windows(spark, out, [], ["home_uv_ct", "good_detail_uv_ct"])
    exp = metrics.home_detail_uv(spark.read.parquet(page_dir))
    cols = ["stt", "edt", "cur_date", "home_uv_ct", "good_detail_uv_ct"]
    assert _rows(got.select(*cols)) == _rows(exp.select(*cols))


def test_jump_stream_is_batch_minus_pending(spark, page_dir):
    out = tempfile.mkdtemp(prefix="jump-") + "/out"
    q = jobs.user_jump_detail(jobs.page_stream(spark, page_dir), out, within_seconds=6 * 3600, name="t_jump")
    q.awaitTermination()
    got = set(_rows(spark.read.parquet(out).drop("batch_id").select("mid", "ts")))
    exp = set(_rows(logplans.user_jump_detail(spark.read.parquet(page_dir), 6 * 3600).select("mid", "ts")))
    assert got <= exp                      # nothing extra
    missing = exp - got                    # only entries still pending at the end of input
    last = {r.mid: r.ts for r in spark.read.parquet(page_dir).groupBy("mid").agg(F.max("ts").alias("ts")).collect()}
    wm = max(last.values())
    assert all(ts + 6 * 3600 * 1000 > wm for _, ts in missing)


def test_trade_order_unique_new_stream(spark):
    od = R.order_detail(spark, SF_SMALL).filter("user_id IS NOT NULL AND source_type_name IS NOT NULL")
    rows = od.select("user_id", (F.col("ts").cast("long") * 1000).alias("ts"),
                     F.xxhash64("id").alias("seq"))
    d = _ordered_files(rows, "ts", tempfile.mkdtemp(prefix="tord-") + "/in")
    out = tempfile.mkdtemp(prefix="tord-") + "/out"
    src = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(d)
    jobs.trade_unique_new(src, out, "order_unique_user_count", "order_new_user_count",
                          name="t_tord").awaitTermination()
    got = jobs.read_partial_windows(spark, out, [], ["order_unique_user_count", "order_new_user_count"])
    exp = metrics.trade_order(R.order_detail(spark, SF_SMALL))
    cols = ["stt", "edt", "cur_date", "order_unique_user_count", "order_new_user_count"]
    assert _rows(got.select(*cols)) == _rows(exp.select(*cols))


def test_keyword_window_stream_update_mode(spark, page_dir):
    out = tempfile.mkdtemp(prefix="kw-") + "/out"
    jobs.keyword_window(jobs.page_stream(spark, page_dir), out, name="t_kw").awaitTermination()
    got = jobs.read_latest(spark, out, ["stt", "keyword"])
    exp = metrics.keyword_window(spark.read.parquet(page_dir))
    assert _rows(got.select(*exp.columns)) == _rows(exp)


def test_log_split_stream_routes_equal_batch(spark):
    raw = fx.raw_log(spark, SF_SMALL).withColumn("ts", F.get_json_object("value", "$.ts").cast("long"))
    raw = raw.withColumn("ts", F.coalesce("ts", F.regexp_extract("value", r'"ts":(\d+)', 1).cast("long")))
    d = _ordered_files(raw, "ts", tempfile.mkdtemp(prefix="raw-") + "/in")
    out = tempfile.mkdtemp(prefix="raw-") + "/out"
    src = (spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(d)
           .select("value", "seq"))
    for q in jobs.log_split(src, out, name="t_split"):
        q.awaitTermination()
    batch = logplans.log_split(spark.read.parquet(d).select("value", "seq"))
    for route in ("page", "start", "display", "action", "error", "dirty"):
        exp = logplans.flat_route(route, batch[route])
        got = logplans.flat_route(route, spark.read.parquet(f"{out}/{route}").drop("batch_id"))
        assert _rows(got.select(*exp.columns)) == _rows(exp), route


def test_province_order_stream(spark):
    env = fx.topic_db(spark, SF_SMALL, ["order_info"]).filter("type = 'insert'")
    d = _ordered_files(env.withColumn("o", F.col("ts").cast("long")), "o", tempfile.mkdtemp(prefix="prov-") + "/in")
    out = tempfile.mkdtemp(prefix="prov-") + "/out"
    schema = spark.read.parquet(d).schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    dims = fx.dim_tables(spark, SF_SMALL)
    jobs.province_order(src, dims["base_province"], out, name="t_prov").awaitTermination()
    got = jobs.read_latest(spark, out, ["stt", "province_id"])
    exp = R.QUERIES["dws_trade_province_order"](spark, SF_SMALL)
    assert _rows(got.select(*exp.columns)) == _rows(exp)


def test_idempotent_batch_rewrite(spark):
    out = tempfile.mkdtemp(prefix="idem-") + "/out"
    df = spark.createDataFrame([("k", 1)], "k string, v long")
    sinks.upsert_batch(df, out, 7)
    sinks.upsert_batch(df, out, 7)          # replayed batch: same files, no duplicate
    sinks.upsert_batch(spark.createDataFrame([("k", 2)], "k string, v long"), out, 8)
    assert [tuple(r) for r in sinks.read_upserted(spark, out, ["k"]).collect()] == [("k", 2)]
    assert spark.read.parquet(out).count() == 2


def test_traffic_stream_equals_batch(spark, page_dir):
    out = tempfile.mkdtemp(prefix="traffic-") + "/out"
    qs = jobs.traffic_vc_ch_ar_is_new(jobs.page_stream(spark, page_dir), out,
                                      jump_page=jobs.page_stream(spark, page_dir), name="t_traffic")
    for q in qs:
        q.awaitTermination()
    got = jobs.read_traffic(spark, out)
    exp = metrics.traffic_vc_ch_ar_is_new(spark.read.parquet(page_dir))
    # page views, sessions, durations and unique visitors are exact; bounces
    # of entries still pending at the end of input are not emitted yet, and
    # their shifted windows may be missing
    cols = ["stt", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum"]
    e_rows = _rows(exp.filter("pv_ct > 0 OR uv_ct > 0").select(*cols))
    assert _rows(got.filter("pv_ct > 0 OR uv_ct > 0").select(*cols)) == e_rows
    g = got.agg(F.sum("uj_ct")).first()[0] or 0
    e = exp.agg(F.sum("uj_ct")).first()[0]
    assert 0 < g <= e


def test_login_stream_equals_batch(spark, page_dir):
    out = tempfile.mkdtemp(prefix="login-") + "/out"
    jobs.user_login(jobs.page_stream(spark, page_dir), out, back_days=3, name="t_login").awaitTermination()
    got = jobs.read_partial_windows(spark, out, [], ["back_ct", "uu_ct"])
    exp = metrics.user_login(spark.read.parquet(page_dir), 3)
    cols = ["stt", "edt", "cur_date", "back_ct", "uu_ct"]
    assert _rows(got.select(*cols)) == _rows(exp.select(*cols))


def test_order_detail_stream_join(spark):
    env = fx.topic_db(spark, SF_SMALL, ["order_detail", "order_info", "order_detail_activity",
                                        "order_detail_coupon"])
    d = _ordered_files(env.withColumn("o", F.col("ts").cast("long")), "o", tempfile.mkdtemp(prefix="od-") + "/in")
    out = tempfile.mkdtemp(prefix="od-") + "/out"
    schema = spark.read.parquet(d).schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    dic = fx.base_dic(spark, SF_SMALL)
    jobs.order_detail(src, dic, out, name="t_od").awaitTermination()
    got = spark.read.parquet(out).drop("batch_id")
    exp = R.order_detail(spark, SF_SMALL).drop("row_op_ts")
    got_ids = {r.id for r in got.select("id").collect()}
    exp_rows = {r.id: r for r in exp.collect()}
    # every emitted line is a batch line with the same content ...
    assert got_ids <= set(exp_rows)
    for r in got.collect()[:200]:
        e = exp_rows[r.id]
        assert (r.activity_id, r.coupon_id, r.user_id, r.source_type_name) == \
            (e.activity_id, e.coupon_id, e.user_id, e.source_type_name)
    # ... and lines are only missing while their outer-join bound is still open
    assert len(got_ids) > 0.9 * len(exp_rows)


def test_sku_order_stream_equals_batch(spark):
    od = R.order_detail(spark, SF_SMALL)
    d = _ordered_files(od.withColumn("o", F.col("ts").cast("long")), "o", tempfile.mkdtemp(prefix="sku-") + "/in")
    out = tempfile.mkdtemp(prefix="sku-") + "/out"
    src = spark.readStream.schema(spark.read.parquet(d).schema).option("maxFilesPerTrigger", 1).parquet(d)
    dims = fx.dim_tables(spark, SF_SMALL)
    jobs.trade_sku_order(src, dims, out, name="t_sku").awaitTermination()
    got = spark.read.parquet(out).drop("batch_id")
    exp = metrics.trade_sku_order(spark.read.parquet(d).drop("o"), dims)
    g, e = set(_rows(got.select(*exp.columns))), set(_rows(exp))
    assert g <= e                                   # append mode: only final windows are written
    missing = e - g                                 # ... so only the newest windows can be absent
    last = max(r[0] for r in e)
    assert all(r[0] >= last[:15] for r in missing) and len(g) > 0.95 * len(e)


def test_refund_stream_equals_batch(spark):
    rf = R.q_trade_order_refund(spark, SF_SMALL)
    d = _ordered_files(rf.withColumn("o", F.col("ts").cast("long")), "o", tempfile.mkdtemp(prefix="rf-") + "/in")
    out = tempfile.mkdtemp(prefix="rf-") + "/out"
    src = spark.readStream.schema(spark.read.parquet(d).schema).option("maxFilesPerTrigger", 1).parquet(d)
    dims = fx.dim_tables(spark, SF_SMALL)
    jobs.refund_tm_category_user(src, dims, out, name="t_refund").awaitTermination()
    got = jobs.read_latest(spark, out, ["stt", "trademark_id", "category3_id", "user_id"])
    exp = metrics.refund_tm_category_user(spark.read.parquet(d).drop("o"), dims)
    assert _rows(got.select(*exp.columns)) == _rows(exp)


def _stream_of(spark, df, order_col, prefix):
    d = _ordered_files(df.withColumn("_o", F.col(order_col).cast("long")), "_o",
                       tempfile.mkdtemp(prefix=prefix) + "/in")
    return d, spark.readStream.schema(spark.read.parquet(d).schema).option("maxFilesPerTrigger", 1).parquet(d)


def test_cart_register_payment_streams(spark):
    cart = R.q_trade_cart_add(spark, SF_SMALL)
    d, src = _stream_of(spark, cart, "ts", "cart-")
    out = tempfile.mkdtemp(prefix="cart-") + "/out"
    jobs.cart_add_uu(src, out, name="t_cart").awaitTermination()
    got = jobs.read_partial_windows(spark, out, [], ["cart_add_uu_ct"])
    exp = metrics.cart_add_uu(spark.read.parquet(d))
    assert _rows(got.select(*exp.columns)) == _rows(exp)

    from tidemart.plans import tool
    reg = tool.user_register(R.env(spark, SF_SMALL, "user_info"))
    d, src = _stream_of(spark, reg, "ts", "reg-")
    out = tempfile.mkdtemp(prefix="reg-") + "/out"
    jobs.user_register(src, out, name="t_reg").awaitTermination()
    got = jobs.read_latest(spark, out, ["stt"])
    exp = metrics.user_register(spark.read.parquet(d))
    assert _rows(got.select(*exp.columns)) == _rows(exp)

    pay = trade.pay_detail_suc(R.order_detail(spark, SF_SMALL), R.env(spark, SF_SMALL, "payment_info"),
                               fx.base_dic(spark, SF_SMALL), upsert=False)
    d, src = _stream_of(spark, pay, "ts", "pay-")
    out = tempfile.mkdtemp(prefix="pay-") + "/out"
    jobs.trade_payment(src, out, name="t_pay").awaitTermination()
    got = jobs.read_partial_windows(spark, out, [], ["payment_suc_unique_user_count",
                                                     "payment_suc_new_user_count"])
    exp = metrics.trade_payment(spark.read.parquet(d))
    assert _rows(got.select(*exp.columns)) == _rows(exp)


def test_dim_sink_stream_equals_batch(spark):
    from tidemart.plans import dim
    env = fx.topic_db_dims(spark, SF_SMALL)
    d, src = _stream_of(spark, env, "ts", "dims-")
    out = tempfile.mkdtemp(prefix="dims-") + "/out"
    from tidemart.operators import dims as dimops
    conf = dimops.fold_config(fx.table_process_changes(spark))
    jobs.dim_sink(src.drop("_o"), conf, out, name="t_dims").awaitTermination()
    got = jobs.read_dims(spark, out).select("sink_table", "id", F.explode("data"))
    exp = dim.dim_sink(env, fx.table_process_changes(spark)).select("sink_table", "id", F.explode("data"))
    assert _rows(got) == _rows(exp)


@pytest.mark.parametrize("name,tables,fn_name,with_dic", [
    ("tool_coupon_get", ["coupon_use"], "coupon_get", False),
    ("tool_coupon_order", ["coupon_use"], "coupon_order", False),
    ("tool_coupon_pay", ["coupon_use"], "coupon_pay", False),
    ("interaction_favor_add", ["favor_info"], "favor_add", False),
    ("interaction_comment", ["comment_info"], "comment", True),
    ("user_register", ["user_info"], "user_register", False),
    ("trade_cart_add", ["cart_info"], "cart_add", True),
])
def test_detail_tables_on_a_streaming_envelope(spark, name, tables, fn_name, with_dic):
    """The stateless CDC detail jobs are the same functions applied to a
    streaming envelope (dictionary joins become stream-static joins)."""
    from tidemart.plans import tool
    fn = getattr(tool, fn_name, None) or getattr(trade, fn_name)
    env = fx.topic_db(spark, SF_SMALL, tables)
    d, src = _stream_of(spark, env, "ts", f"{name}-")
    src = src.drop("_o")
    dic = fx.base_dic(spark, SF_SMALL)
    out_df = fn(src, dic) if with_dic else fn(src)
    out = tempfile.mkdtemp(prefix=f"{name}-") + "/out"
    jobs.start(out_df, f"t_{name}", lambda b, i: sinks.write_append(b, out, "parquet", batch_id=i)).awaitTermination()
    got = spark.read.parquet(out).drop("batch_id")
    exp = R.QUERIES[name](spark, SF_SMALL)
    assert _rows(got.select(*exp.columns)) == _rows(exp)


def test_order_pre_process_stream_upsert(spark):
    """K2: with a join bound covering the order updates (+1 h), the stream's
    upserted table equals the batch latest-version table."""
    env = fx.topic_db(spark, SF_SMALL, ["order_detail", "order_info", "order_detail_activity",
                                        "order_detail_coupon"])
    d, src = _stream_of(spark, env, "ts", "pre-")
    out = tempfile.mkdtemp(prefix="pre-") + "/out"
    jobs.order_pre_process(src.drop("_o"), fx.base_dic(spark, SF_SMALL), out, ttl_seconds=4000,
                           name="t_pre").awaitTermination()
    got = R.finalize(jobs.read_pre_process(spark, out))
    exp = R.QUERIES["trade_order_pre_process"](spark, SF_SMALL)
    g, e = set(_rows(got.select(*exp.columns))), set(_rows(exp))
    assert g <= e and len(g) > 0.9 * len(e)     # lines still inside their outer-join bound are pending
