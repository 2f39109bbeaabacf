"""Quirk flags (literal vs intended behaviour) and allowed lateness."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemart.operators import dims
from tidemart.operators.windows import tumbling_agg, with_event_time
from tidemart.plans import metrics, trade
from tidemart.plans import registry as R
from tidemart.sources import fixtures as fx
from tidemart.sources import sinks
from tidemart.streaming import jobs


def test_cart_add_every_add_counts_more(spark):
    cart = R.q_trade_cart_add(spark, SF_SMALL)
    uu = metrics.cart_add_uu(cart).agg(F.sum("cart_add_uu_ct")).first()[0]
    every = metrics.cart_add_uu(cart, count_every_add=True).agg(F.sum("cart_add_uu_ct")).first()[0]
    assert every == cart.count() and uu < every


def test_payment_success_only_flag(spark):
    od = R.order_detail(spark, SF_SMALL)
    env = R.env(spark, SF_SMALL, "payment_info")
    dic = fx.base_dic(spark, SF_SMALL)
    literal = trade.pay_detail_suc(od, env, dic, upsert=False).count()
    strict = trade.pay_detail_suc(od, env, dic, success_only=True, upsert=False).count()
    assert literal > strict > 0           # some payments changed again, without success


def test_last_versions_before_the_lines_are_the_last_after(spark):
    """Repeated ids, several promotions of a line, null keys and times."""
    order = lambda n, status, ts, kind="update": ("order_info", kind, {"id": n, "user_id": "u", "order_status": status}, None, ts)
    line = lambda i, n, ts, source="1": ("order_detail", "insert", {"id": i, "order_id": n, "source_type": source, "sku_num": "2", "order_price": "1.50"}, None, ts)
    pay = lambda n, kind, ts, status="1602": ("payment_info", "update", {"order_id": n, "payment_type": kind, "payment_status": status}, None, ts)
    rows = [order("1", "1001", "10", "insert"), order("1", "1003", "30"), order("1", "1005", "20"), order("2", "1001", "40", "insert"),
            order(None, "1001", "1", "insert"), order("3", "1001", None, "insert"), order("3", "1003", None), line("a", "1", "25"), line("a", "1", "35"),
            line("b", "1", "50"), line("c", "2", "9"), line(None, "2", "9"), line("d", None, "9"), line("e", "1", "9", "7"), line("f", "3", "9"),
            ("order_detail_activity", "insert", {"order_detail_id": "b", "activity_id": "x"}, None, "1"),
            ("order_detail_coupon", "insert", {"order_detail_id": "c", "coupon_id": "y"}, None, "1"),
            ("order_detail_coupon", "insert", {"order_detail_id": "c", "coupon_id": "y"}, None, "2"),
            pay("1", "1", "60"), pay("1", "2", "70"), pay("1", "9", "80"), pay("2", "2", "10"), pay("3", "2", None, "1603"), pay("3", "1", None)]
    env = spark.createDataFrame(rows, "table string, type string, data map<string,string>, old map<string,string>, ts string")
    keyed = env.withColumn("key", F.when(F.col("table") == "order_detail", F.col("data")["order_id"]))
    dic = spark.createDataFrame([("1", "one"), ("2", "two")], "dic_code string, dic_name string")
    rows_in = lambda df: sorted(str(r.asDict()) for r in df.collect())
    timed = lambda df, col: df.filter(F.col(col).isNotNull())
    full, last = (trade.order_pre_process(trade.order_pre_process_changelog(e, dic, latest=x)) for e, x in ((env, False), (keyed, True)))
    assert rows_in(timed(last, "oi_ts")) == rows_in(timed(full, "oi_ts")) and last.count() == 5
    assert {r.id: r.order_status for r in last.collect()} == {"a": "1003", "b": "1003", "c": "1001", None: "1001", "f": "1001"}
    paid = trade.pay_detail_suc(trade.order_detail(trade.order_pre_process_changelog(env, dic)).filter("id <> 'f'"), env, dic)
    early = trade.pay_detail_suc(trade.order_detail(trade.dated(trade.order_lines(keyed, dic))), keyed, dic, promotions=keyed)
    assert rows_in(early.filter("order_detail_id <> 'f'").drop("row_op_ts")) == rows_in(paid.filter("order_detail_id IS NOT NULL").drop("row_op_ts"))
    assert {r.order_detail_id: r.payment_type_code for r in early.collect()} == {"a": "2", "b": "2", "c": "2", None: "2", "f": "1"}


def test_refund_pay_strict_flag(spark):
    env = R.env(spark, SF_SMALL, "refund_payment", "order_info", "order_refund_info")
    dic = fx.base_dic(spark, SF_SMALL)
    assert trade.refund_pay_suc(env, dic).count() > 0
    assert trade.refund_pay_suc(env, dic, strict=True).count() == 0   # no 1006 / 0705 rows exist there


def test_refund_pay_strict_keeps_only_the_changes_it_names(spark):
    """Order n differs from a finished refund (order 0) in one point."""
    good = {"pay": ("update", "0702", "0701"), "order": ("update", "1006", "1005"), "line": ("update", "0705", "0702")}
    cases = [{}, {"pay": ("insert", "0702", None)}, {"pay": ("update", "0702", None)}, {"pay": ("update", "0701", "0700")},
             {"order": ("update", "1005", "1001")}, {"order": ("update", "1006", None)}, {"order": ("insert", "1006", None)},
             {"line": ("insert", "0705", None)}, {"line": ("update", "0705", None)}, {"line": ("update", "0702", "0701")}]
    rows = []
    for n, case in enumerate(cases):
        for part, table, status in (("pay", "refund_payment", "refund_status"), ("order", "order_info", "order_status"), ("line", "order_refund_info", "refund_status")):
            kind, after, before = (good | case)[part]
            own = {"id": f"o{n}"} if part == "order" else {"id": f"{part}{n}", "order_id": f"o{n}", "sku_id": "s", "payment_type": "1"}
            rows.append((table, kind, own | {status: after}, {status: before} if before else None, str(100 + n)))
    env = spark.createDataFrame(rows, "table string, type string, data map<string,string>, old map<string,string>, ts string")
    dic = spark.createDataFrame([("1", "one")], "dic_code string, dic_name string")
    ids = lambda **flags: {r.id for r in trade.refund_pay_suc(env, dic, **flags).collect()}
    assert ids(strict=True) == {"pay0"}
    assert ids() == {f"pay{n}" for n in range(len(cases)) if n not in (3, 6)}  # literal: any success, any order update


def test_apply_deletes_flag(spark):
    conf = dims.fold_config(spark.createDataFrame(
        [("r", "t", "dim_t", "id,v", "id", None, 0)],
        "op string, source_table string, sink_table string, sink_columns string, sink_pk string, "
        "sink_extend string, ts bigint"))
    env = spark.createDataFrame([("t", "insert", {"id": "1", "v": "a"}, "1"),
                                 ("t", "delete", {"id": "1", "v": "a"}, "2")],
                                "table string, type string, data map<string,string>, ts string")
    assert dims.dim_rows(env, conf).count() == 1                      # literal: last image upserted
    assert dims.dim_rows(env, conf, apply_deletes=True).count() == 0


def test_lateness_updates_window_then_drops_too_late(spark):
    """With a 10 s watermark a row 5 s late still updates its window;
    a row 70 s late is dropped."""
    src = tempfile.mkdtemp(prefix="late-") + "/in"
    out = tempfile.mkdtemp(prefix="late-") + "/out"
    batches = [[(100_000,), (120_000,)], [(115_000,)], [(50_000,)], [(200_000,)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "ts long").coalesce(1).write.mode("append").parquet(src)
        for f in os.listdir(src):
            p = os.path.join(src, f)
            if f.endswith(".parquet") and os.path.getmtime(p) > 2_000_000:
                os.utime(p, (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema("ts long").option("maxFilesPerTrigger", 1).parquet(src)
    agg = tumbling_agg(with_event_time(stream, watermark_seconds=10),
                       {"pv_ct": F.count(F.lit(1)).cast("bigint")})
    q = jobs.start(agg, "t_late", lambda b, i: sinks.upsert_batch(b, out, i), mode="update")
    q.awaitTermination()
    got = {r.stt[-8:]: r.pv_ct for r in sinks.read_upserted(spark, out, ["stt"]).collect()}
    assert got["00:01:40"] == 1 and got["00:02:00"] == 1   # windows 100 s and 120 s
    assert got["00:01:50"] == 1                             # 115 s: 5 s late, counted
    assert "00:00:50" not in got                            # 50 s: 70 s late, dropped
