"""Streams that run on: later files, stop and restart, jobs that feed each
other through topics, days out of order, lookups that change."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemart import cli, topics
from tidemart.plans import log as logplans
from tidemart.plans import metrics, trade
from tidemart.plans import registry as R
from tidemart.sources import fixtures as fx
from tidemart.sources import readers, sinks, snapshots
from tidemart.streaming import jobs, runtime

from conftest import SF_SMALL
from test_disorder import DAY, feed, folder, pages

UU = ["order_unique_user_count", "order_new_user_count"]


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def add_lines(path, lines, n, at=1_000_000):
    """Put a file of lines into a topic in one step, n-th in order of time."""
    os.makedirs(path, exist_ok=True)
    aside = os.path.join(path, f".part-{n}")
    with open(aside, "w") as f:
        f.write("".join(line + "\n" for line in lines))
    os.utime(aside, (at + n, at + n))
    os.rename(aside, os.path.join(path, f"part-{n}"))


def eventually(check, seconds=120):
    until = time.time() + seconds
    while True:
        try:
            if check():
                return
        except Exception:  # nothing written yet
            if time.time() > until:
                raise
        assert time.time() < until, "nothing came of it in time"
        time.sleep(0.5)


def page_line(mid, ts, last=None, page="home", new="1", **more):
    return json.dumps({"common": {"mid": mid, "uid": mid, "vc": "v1", "ch": "c1", "ar": "a1", "is_new": new},
                       "page": {"page_id": page, "last_page_id": last, "during_time": 10}, "ts": ts, **more})


def test_run_job_goes_on_stops_and_restarts(spark):
    root = folder()
    t0 = 1_600_000_000_000
    files = [[page_line(f"m{i}", t0 + (k * 100 + i) * 60_000) for i in range(k, k + 5)] for k in range(4)]
    args = ["run-job", "dws_user_login", "--source", f"{root}/page", "--output", f"{root}/out", "--mode", "stream", "--trigger", "500ms", "--max-files", "1"]
    total = lambda: jobs.read_logins(spark, f"{root}/out").agg(F.sum("uu_ct")).first()[0]

    def session(new_files, want):
        stop, codes = folder() + "/stop", []
        t = threading.Thread(target=lambda: codes.append(cli.main([*args, "--stop-file", stop])))
        t.start()
        for n in new_files:  # after the start
            time.sleep(2)
            add_lines(f"{root}/page", files[n], n)
        eventually(lambda: total() == want)
        open(stop, "w").close()
        t.join(60)
        assert codes == [0] and not spark.streams.active

    add_lines(f"{root}/page", files[0], 0)
    session([1, 2], 7)
    session([3], 8)  # goes on behind the third file, with the state of the first run
    batch = metrics.user_login(logplans.flat_page(readers.page_log_records(readers.read_topic(spark, f"{root}/page"))))
    assert rows(jobs.read_logins(spark, f"{root}/out").select(*batch.columns)) == rows(batch)


def test_a_failing_query_stops_the_others(spark):
    def fail(batch, bid):
        raise ValueError("broken sink")

    root = folder()
    add_lines(f"{root}/a", ["x"], 0)
    lines = readers.read_topic(spark, f"{root}/a", stream=True)
    with runtime.settings(every="500 milliseconds"):
        good = jobs.start(lines, "r_good", lambda b, i: None)
        bad = jobs.start(lines, "r_bad", fail)
    with pytest.raises(Exception, match="broken sink"):
        runtime.wait(spark, [good, bad])
    assert not good.isActive and not bad.isActive


def test_settings_and_sinks(spark):
    assert runtime.interval("3s") == "3 seconds" and runtime.interval("200ms") == "200 milliseconds" and runtime.interval("1 minute") == "1 minute"
    with runtime.settings(every="1 seconds", sink="topic"):
        assert runtime.current() == runtime.Settings("1 seconds", "topic")
    assert runtime.current() == runtime.Settings()
    with pytest.raises(ValueError, match="writes parquet, not json"):
        topics.run(topics.Inputs(spark, folder(), stream=True), "dws_user_login", folder(), "json")
    with pytest.raises(ValueError, match="not olap"):
        topics.run(topics.Inputs(spark, folder(), stream=True), "tool_coupon_get", folder(), "olap")


def test_a_published_batch_appears_once_and_whole(spark):
    path = folder() + "/topic"
    df = spark.createDataFrame([(i, "x") for i in range(20)], "a long, b string").repartition(3)
    for n in (0, 0, 1):  # the second is a replay
        sinks.publish_batch(df, path, n)
    sinks.publish_batch(df.filter("a < 0"), path, 2)
    # Half a batch, left by a lost driver:
    sinks.to_json_value(df).write.text(f"{path}/_staging/batch-000000000003-x")
    got = readers.typed_records(readers.read_topic(spark, path), ["a", "b"])
    assert rows(got) == sorted([(str(i), "x") for i in range(20)] * 2, key=repr)
    assert sorted(d for d in os.listdir(path) if d.startswith("batch")) == ["batch-000000000000", "batch-000000000001"]


def run_chain(spark, chain, feeders):
    """Start jobs that read each other's topics, feed the first while they
    run, take each to its end, stop all; then again from their checkpoints."""
    for feed_files in feeders:
        started = [topics.run(i, name, out, sink, "500ms") for i, name, out, sink in chain]
        time.sleep(3)
        feed_files()
        for _ in range(2):  # what a timeout releases in the first round travels on in the second
            for queries in started:
                for q in queries:
                    q.processAllAvailable()
        for queries in started:
            runtime.stop(queries)


def test_log_split_bounce_and_traffic_as_running_streams(spark):
    root, tz = folder(), "UTC"
    raw = [r.value for r in fx.raw_log(spark, SF_SMALL).withColumn("o", F.coalesce(
        F.get_json_object("value", "$.ts").cast("long"), F.regexp_extract("value", r'"ts":(\d+)', 1).cast("long"))).orderBy("o", "value").collect()]
    far = [page_line("flush", 1_900_000_000_000)]  # every pending entry is released
    parts = [raw[:300], raw[300:600], raw[600:], far]
    inputs = lambda source, **more: topics.Inputs(spark, source, stream=True, tz=tz, **more)
    chain = [(inputs(f"{root}/log", limits={"maxFilesPerTrigger": "1"}), "log_split", f"{root}/split", "json"),
             (inputs(f"{root}/split/page"), "unique_visitor_detail", f"{root}/uv", "json"),
             (inputs(f"{root}/split/page"), "user_jump_detail", f"{root}/uj", "json"),
             (inputs(f"{root}/split/page", visitors=f"{root}/uv", bounces=f"{root}/uj", lateness=3000 * 86400), "dws_traffic_vc_ch_ar_is_new", f"{root}/traffic", "parquet")]
    put = lambda *ns: lambda: [add_lines(f"{root}/log", parts[n], n) for n in ns]
    add_lines(f"{root}/log", parts[0], 0)
    run_chain(spark, chain, [put(1), put(2, 3)])
    routes = logplans.log_split(readers.read_topic(spark, f"{root}/log"))
    page = logplans.flat_page(routes["page"])
    batch = metrics.traffic_vc_ch_ar_is_new(page).filter("stt < '2030'")
    got = sinks.read_upserted(spark, f"{root}/traffic", ["stt", *metrics.TRAFFIC_KEYS]).filter("stt < '2030'")
    assert rows(got, *batch.columns) == rows(batch) and batch.agg(F.sum("uj_ct")).first()[0] > 100
    # No field of a record is lost on the way, and dirty lines have their topic.
    record = json.loads(spark.read.option("recursiveFileLookup", "true").text(f"{root}/split/page").filter("value LIKE '%during_time%'").first().value)
    assert set(record["common"]) >= {"mid", "os", "vc"} and "seq" in record
    for route in ("start", "display", "action", "error", "dirty"):
        lines = spark.read.option("recursiveFileLookup", "true").text(f"{root}/split/{route}")
        assert lines.count() == routes[route].count() > 0, route


def test_pre_process_detail_and_sku_as_running_streams(spark):
    root = folder()
    tables = ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon"]
    env = fx.topic_db(spark, SF_SMALL, tables).select("table", "type", "data", "old", "ts")
    lines = [r.value for r in sinks.to_json_value(env.orderBy(F.col("ts").cast("long"), F.xxhash64(F.to_json("data")))).collect()]
    late = "4000000000"  # far behind all, once for each table the joins wait for, so that every bound closes
    flush = [json.dumps({"table": t, "type": "insert", "data": {"id": "flush", "order_id": "flush", "order_detail_id": "flush"}, "ts": late}) for t in tables]
    cut = len(lines) // 3
    parts = [lines[:cut], lines[cut:2 * cut], lines[2 * cut:], flush]
    snapshots.publish(fx.base_dic(spark, SF_SMALL), f"{root}/dic")
    for name, df in fx.dim_tables(spark, SF_SMALL).items():
        snapshots.publish(df, f"{root}/dims/{name}.parquet")
    inputs = lambda source, **more: topics.Inputs(spark, source, stream=True, dictionary=f"{root}/dic", dims_root=f"{root}/dims", **more)
    chain = [(inputs(f"{root}/db", limits={"maxFilesPerTrigger": "1"}), "trade_order_pre_process", f"{root}/pre", "json"),
             (inputs(f"{root}/unused", changelog=f"{root}/pre"), "trade_order_detail", f"{root}/detail", "json"),
             (inputs(f"{root}/detail"), "dws_trade_sku_order", f"{root}/sku", "parquet")]
    put = lambda *ns: lambda: [add_lines(f"{root}/db", parts[n], n) for n in ns]
    run_chain(spark, chain, [put(0, 1), put(2, 3)])
    topic = readers.cdc_records(readers.read_topic(spark, f"{root}/db"))
    want = trade.order_detail(trade.order_pre_process_changelog(topic, fx.base_dic(spark, SF_SMALL)))
    got = readers.typed_records(readers.read_topic(spark, f"{root}/detail"), topics.ORDER_DETAIL)
    assert got.schema["arrival"].dataType.simpleString() == "bigint"
    assert rows(got, *want.columns) == rows(want) and want.count() > 4000
    sku = metrics.trade_sku_order(want, fx.dim_tables(spark, SF_SMALL))
    done = spark.read.parquet(f"{root}/sku").select(*sku.columns)
    last = max(r.stt for r in sku.collect())[:10]  # append mode: the newest windows stay open
    assert rows(done.filter(F.col("stt") < last)) == rows(sku.filter(F.col("stt") < last))


def ms(day, second=0):
    return day * DAY + second * 1000


@pytest.mark.parametrize("days", [[10, 9, 10], [9, 10, 9, 11], [12, 10, 11, 10, 12], [5, 6, 5, 4]])
def test_days_in_any_order_equal_batch(spark, days):
    """Days that come interleaved over micro-batches."""
    schema = "user_id string, ts long, seq long"
    batches = [[(u, ms(d, 60 * ((7 * k + i) % 5)), k) for i, u in enumerate(("a", "b", "a"))] for k, d in enumerate(days)]
    everything = spark.createDataFrame([r for b in batches for r in b], schema)
    n = "-".join(map(str, days))
    out = folder() + "/out"
    jobs.trade_unique_new(feed(spark, folder(), batches, schema), out, *UU, name=f"r_uu{n}", keep_days=30).awaitTermination()
    want = metrics._unique_new_window(everything, *UU, 10)
    assert rows(jobs.read_partial_windows(spark, out, [], UU).select(*want.columns)) == rows(want)
    out = folder() + "/out"
    page = [pages(*[(u, None, ts) for u, ts, _ in b]) for b in batches]
    jobs.user_login(feed(spark, folder(), page, jobs.FLAT_PAGE_SCHEMA), out, back_days=2, name=f"r_login{n}", keep_days=30).awaitTermination()
    want = metrics.user_login(spark.createDataFrame([r for b in page for r in b], jobs.FLAT_PAGE_SCHEMA), 2)
    assert rows(jobs.read_logins(spark, out).select(*want.columns)) == rows(want)


@pytest.mark.parametrize("metric", ["login", "order", "payment"])
def test_shuffled_files_equal_batch(spark, metric):
    out, keep = folder() + "/out", 4000
    if metric == "login":
        source = R.page(spark, SF_SMALL)
    else:
        od = R.order_detail(spark, SF_SMALL)
        source = od if metric == "order" else trade.pay_detail_suc(od, R.env(spark, SF_SMALL, "payment_info"), fx.base_dic(spark, SF_SMALL), upsert=False)
    path = folder() + "/in"
    source.withColumn("_o", F.xxhash64(*[F.col(c) for c in source.columns[:6]])).repartitionByRange(4, "_o").drop("_o").write.parquet(path)
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(path)
    if metric == "login":
        jobs.user_login(stream, out, 3, name="r_shuffled_login", keep_days=keep).awaitTermination()
        got, want = jobs.read_logins(spark, out), metrics.user_login(spark.read.parquet(path), 3)
    elif metric == "order":
        some = stream.filter("user_id IS NOT NULL AND source_type_name IS NOT NULL")
        jobs.trade_unique_new(topics._milliseconds(some), out, *UU, name="r_shuffled_order", keep_days=keep).awaitTermination()
        got, want = jobs.read_partial_windows(spark, out, [], UU), metrics.trade_order(spark.read.parquet(path))
    else:
        names = ["payment_suc_unique_user_count", "payment_suc_new_user_count"]
        jobs.trade_unique_new(topics._milliseconds(stream), out, *names, name="r_shuffled_pay", keep_days=keep).awaitTermination()
        got, want = jobs.read_partial_windows(spark, out, [], names), metrics.trade_payment(spark.read.parquet(path))
    assert rows(got.select(*want.columns)) == rows(want) and want.count() > 100


def test_old_days_leave_the_state_and_the_first_time_stays(spark):
    from tidemart.streaming import state
    schema = "user_id string, ts long"
    batches = [[("a", ms(1))], [("a", ms(5)), ("a", ms(6))], [("b", ms(30))], [("b", ms(31))], [("a", ms(40)), ("a", ms(2)), ("b", ms(41))], [("c", ms(50))]]
    src, seen = folder(), []
    flags = state.unique_new_flags(feed(spark, src, batches, schema), keep_days=2)
    q = jobs.start(flags, "r_expire", lambda b, i: seen.extend(tuple(r) for r in b.collect()))
    q.awaitTermination()
    got = {}
    for ts, uu, new in seen:
        got[ts // DAY] = tuple(x + y for x, y in zip(got.get(ts // DAY, (0, 0)), (uu, new)))
    # Day 2 came far too late; "a" is no new user on day 40, long after its days left.
    assert got == {1: (1, 1), 5: (1, 0), 6: (1, 0), 30: (1, 1), 31: (1, 0), 40: (1, 0), 41: (1, 0), 50: (1, 1)}
    root = jobs.checkpoint_for(spark, "r_expire")
    kept = {r.user_id: r.days for r in spark.read.format("statestore").load(root).select("key.user_id", F.expr("value.groupState.days")).collect()}
    assert kept["a"] == [] or kept["a"] == [40]


def test_late_rows_change_all_measures_or_none(spark):
    """W5 on the joined metric: 10 s late counts for every measure, more for none."""
    keys = dict(vc="v", ch="c", ar="a", is_new="1")
    schema = "mid string, vc string, ch string, ar string, is_new string, last_page_id string, during_time long, ts long"
    row = lambda ts: ("m", *keys.values(), None, 5, ts)
    t = 1_600_000_000_000
    # 8 s late in the second file, 60 s late in the third; bounces count 10 s later than they are.
    ahead = [[row(t)], [row(t + 100_000)], [row(t + 92_000)], [row(t + 40_000)], [row(t + 200_000)]]
    streams = [feed(spark, folder(), ahead, schema) for _ in range(3)]
    out = folder() + "/out"
    jobs.traffic_from_topics(*streams, out, name="r_late").awaitTermination()
    got = {r.stt[-8:]: (r.uv_ct, r.sv_ct, r.pv_ct, r.dur_sum, r.uj_ct) for r in sinks.read_upserted(spark, out, ["stt", *keys]).collect()}
    label = lambda ms_: time.strftime("%H:%M:%S", time.gmtime(ms_ // 10_000 * 10))
    want = {}
    for ts in (t, t + 100_000, t + 92_000, t + 200_000):
        for k, add in ((label(ts), (1, 1, 1, 5, 0)), (label(ts + 10_000), (0, 0, 0, 0, 1))):
            want[k] = tuple(x + y for x, y in zip(want.get(k, (0,) * 5), add))
    assert got == want


def test_lookups_are_as_fresh_as_the_micro_batch(spark):
    """A dictionary and a dimension that change, and an overwritten folder,
    while the job runs."""
    root = folder()
    change = lambda n, status="1": json.dumps({"table": "cart_info", "type": "insert", "ts": str(100 + n), "data": {
        "id": str(n), "user_id": "u", "sku_id": "s", "sku_num": 2, "source_type": status}})
    dic = lambda name: spark.createDataFrame([("1", name)], "dic_code string, dic_name string")
    assert snapshots.publish(dic("one"), f"{root}/dic") == 0
    provinces = lambda name: spark.createDataFrame([("p", name)], "id string, name string")
    provinces("old").write.parquet(f"{root}/dims/base_province.parquet")
    for t in topics.DIM_TABLES[:-1]:
        provinces("x").write.parquet(f"{root}/dims/{t}.parquet")
    inputs = topics.Inputs(spark, f"{root}/db", stream=True, dictionary=f"{root}/dic", dims_root=f"{root}/dims")
    queries = topics.run(inputs, "trade_cart_add", f"{root}/cart", every="500ms") + topics.run(inputs, "dws_trade_province_order", f"{root}/province", every="500ms")
    order = lambda n: json.dumps({"table": "order_info", "type": "insert", "ts": str(n), "data": {"id": str(n), "province_id": "p", "total_amount": "1.00"}})
    add_lines(f"{root}/db", [change(1), order(1000), "{broken", '{"type": "insert"}'], 1)
    for q in queries:
        q.processAllAvailable()
    for n in range(4):
        snapshots.publish(dic(f"two{n}"), f"{root}/dic", keep=2)
    provinces("new").write.mode("overwrite").parquet(f"{root}/dims/base_province.parquet")
    add_lines(f"{root}/db", [change(2), change(3, "9"), order(2000)], 2)
    for q in queries:
        q.processAllAvailable()
    runtime.stop(queries)
    assert rows(spark.read.parquet(f"{root}/cart"), "id", "source_type_name") == [("1", "one"), ("2", "two3")]
    assert rows(spark.read.parquet(f"{root}/province"), "stt", "province_name") == [("1970-01-01 00:16:40", "old"), ("1970-01-01 00:33:20", "new")]
    for job in ("cart", "province"):
        assert rows(spark.read.parquet(f"{root}/{job}_dirty"), "line") == [('{"type": "insert"}',), ("{broken",)]
    assert sorted(os.listdir(f"{root}/dic")) == ["v=3", "v=4"]


@pytest.mark.parametrize("name, sink", [("trade_order_detail", "json"), ("trade_cancel_detail", "parquet"), ("trade_order_refund", "json"),
                                        ("trade_refund_pay_suc", "parquet"), ("trade_pay_detail_suc", "parquet")])
def test_stream_joins_keep_dirty_lines(spark, name, sink):
    """Q11 in the joins: every bad line once, beside the joined rows, over a restart."""
    root = folder()
    change = lambda table, kind, ts, old=None, **data: json.dumps({"table": table, "type": kind, "ts": str(ts), "data": data, "old": old})

    def order(n, ts):
        own = {"order_id": f"o{n}", "sku_id": f"s{n}", "source_type": "1"}
        return [change("order_info", "insert", ts, id=f"o{n}", user_id="u", order_status="1001"),
                change("order_detail", "insert", ts, id=f"d{n}", sku_num="1", order_price="2.00", create_time="2024-01-01 00:00:00", **own),
                change("order_detail_activity", "insert", ts, order_detail_id=f"d{n}", activity_id="7"),
                change("order_detail_coupon", "insert", ts, order_detail_id="none", coupon_id="8"),
                change("order_info", "update", ts + 1, {"order_status": "1001"}, id=f"o{n}", user_id="u", order_status="1003"),
                change("order_info", "update", ts + 2, {"order_status": "1003"}, id=f"o{n}", user_id="u", order_status="1005"),
                change("order_refund_info", "insert", ts + 2, id=f"r{n}", order_id=f"o{n}", sku_id=f"s{n}", refund_type="1", refund_reason_type="1"),
                change("payment_info", "update", ts + 2, {"payment_status": "1601"}, id=f"p{n}", order_id=f"o{n}", payment_type="1", payment_status="1602"),
                change("refund_payment", "update", ts + 3, {"refund_status": "0701"}, id=f"f{n}", order_id=f"o{n}", sku_id=f"s{n}", payment_type="1", refund_status="0702")]
    spark.createDataFrame([("1", "one")], "dic_code string, dic_name string").write.parquet(f"{root}/dic")
    detail = lambda n, ts: json.dumps({"id": f"d{n}", "order_id": f"o{n}", "user_id": "u", "ts": str(ts), "arrival": n})
    inputs = topics.Inputs(spark, f"{root}/db", stream=True, dictionary=f"{root}/dic", details=f"{root}/details")
    for n, bad in enumerate([["{broken", "[1, 2]"], ['{"type": "insert"}'], [], ["{broken"]]):
        # A later order carries the watermark past the outer joins of the one before.
        add_lines(f"{root}/db", [*order(n, 10_000 * (n + 1)), *bad], n)
        add_lines(f"{root}/details", [detail(n, 10_000 * (n + 1))], n)
        for q in topics.run(inputs, name, f"{root}/out", sink):
            q.awaitTermination()
    read = lambda p: (spark.read.text(p, recursiveFileLookup=True).select(F.col("value").alias("line")) if sink == "json" else spark.read.parquet(p))
    dirty = [json.loads(r.line)["line"] for r in read(f"{root}/out_dirty").collect()] if sink == "json" else [r.line for r in read(f"{root}/out_dirty").collect()]
    assert sorted(dirty) == sorted(["{broken", "[1, 2]", '{"type": "insert"}', "{broken"])
    joined = read(f"{root}/out")
    assert joined.count() >= 3 and not [x for x in joined.toJSON().collect() if "broken" in x]


def parts_of(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{path}/_folded") for f in fs if f.endswith(".parquet")}


def test_a_fold_touches_only_changed_buckets(spark):
    path, schema = folder() + "/table", "k string, ts long, v string"
    keys = [f"k{i}" for i in range(200)]
    sinks.upsert_batch(spark.createDataFrame([(k, 1, "old") for k in keys], schema), path, 0)
    assert sinks.fold(spark, path, ["k"], ["ts"]) == 0
    before = parts_of(path)
    during = sinks.read_upserted(spark, path, ["k"], ["ts"])  # planned before the next fold, read after it
    sinks.upsert_batch(spark.createDataFrame([("k7", 2, "new"), ("k8", 0, "stale")], schema), path, 1)
    assert sinks.fold(spark, path, ["k"], ["ts"]) == 1
    written = parts_of(path) - before
    assert 1 <= len({f.split("/p=")[1].split("/")[0] for f in written}) <= 2  # two keys: two of 16 buckets at most
    assert rows(during) == sorted([(k, 1, "old") for k in keys], key=repr)
    want = sorted([(k, *((2, "new") if k == "k7" else (1, "old"))) for k in keys], key=repr)
    assert rows(sinks.read_upserted(spark, path, ["k"], ["ts"])) == want
    # A fold that was cut off before its manifest leaves the table as it was, and is done over.
    sinks.upsert_batch(spark.createDataFrame([("k9", 5, "newer")], schema), path, 2)
    spark.createDataFrame([("junk", 9, "x", 2)], schema + ", batch_id long").write.parquet(f"{path}/_folded/v=2/p=3")
    want = sorted([(k, 5, "newer") if k == "k9" else (k, ts, v) for k, ts, v in want], key=repr)
    assert rows(sinks.read_upserted(spark, path, ["k"], ["ts"])) == want
    assert sinks.fold(spark, path, ["k"], ["ts"]) == 2 == sinks.fold(spark, path, ["k"], ["ts"])
    sinks.upsert_batch(spark.createDataFrame([("k9", 5, "newer")], schema), path, 2)  # replayed
    assert rows(sinks.read_upserted(spark, path, ["k"], ["ts"])) == want


def test_a_metric_table_folds_into_its_dates(spark):
    """K5: however many triggers, a date has a few files, and sums stay."""
    out, days = folder() + "/out", 3
    batches = [[(f"u{k}{i}", ms(10 + k % days, 7 * i), 0) for i in range(5)] for k in range(12)]
    schema = "user_id string, ts long, seq long"
    with runtime.settings(fold_every=3):
        jobs.trade_unique_new(feed(spark, folder(), batches, schema), out, *UU, name="r_fold", keep_days=30).awaitTermination()
    want = metrics._unique_new_window(spark.createDataFrame([r for b in batches for r in b], schema), *UU, 10)
    assert rows(jobs.read_partial_windows(spark, out, [], UU).select(*want.columns)) == rows(want)
    left = [d for d in os.listdir(out) if d.startswith("batch_id")]
    assert len(left) <= 3 and len(sinks.children(spark, f"{out}/_manifest", "n=")) <= 2
    live = {f for f in sinks.read_changes(spark, out).inputFiles() if "/_folded/" in f}
    assert len(live) <= 4 * days and len({f.split("/p=")[1].split("/")[0] for f in live}) == days


def test_lines_of_one_time_keep_their_order_in_the_file(spark):
    """Equal times in one file, the later line is the later."""
    root, t = folder(), 1_600_000_000_000
    log = [page_line(f"m{i}", t, new=flag) for i in range(30) for flag in ("01" if i % 2 else "10")]
    add_lines(f"{root}/log", log, 0)
    page = logplans.flat_page(logplans.log_split(readers.read_topic(spark, f"{root}/log"))["page"])
    # A device whose first line says it isn't new stays old; the others' second line is repaired by no one.
    got = {r.mid: sorted(r.flags) for r in page.groupBy("mid").agg(F.collect_list("is_new").alias("flags")).collect()}
    assert got == {f"m{i}": ["0", "0"] if i % 2 else ["0", "1"] for i in range(30)}
    change = lambda table, kind, **d: json.dumps({"table": table, "type": kind, "ts": "100", "data": d})
    lines = []
    for i in range(20):
        lines.append(change("order_detail", "insert", id=f"d{i}", order_id=f"o{i}", sku_id="s", sku_num="1", order_price="2.00", source_type="1", split_total_amount="2.00"))
        lines += [change("order_info", "insert" if k == 0 else "update", id=f"o{i}", user_id="u", order_status=str(1000 + (i * 7 + k * 5) % 9)) for k in range(4)]
    add_lines(f"{root}/db", lines, 0)
    dic = spark.createDataFrame([("1", "one")], "dic_code string, dic_name string")
    changes = trade.order_pre_process_changelog(readers.cdc_records(readers.read_topic(spark, f"{root}/db")), dic)
    want = {f"d{i}": str(1000 + (i * 7 + 15) % 9) for i in range(20)}
    assert {r.id: r.order_status for r in trade.order_pre_process(changes).collect()} == want
    assert {r.id: r.order_status for r in trade.detail_versions_latest(changes).collect()} == want


def test_line_order_over_splits_and_files(spark):
    """A file cut into many splits, between small files, keeps its order."""
    root = folder()
    for n in range(5):
        add_lines(f"{root}/t", [f"{n}:{i:06d}" for i in range(40 if n % 2 else 30_000)], n)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        df = readers.read_topic(spark, f"{root}/t")
        assert df.rdd.getNumPartitions() > 10
        want = sorted(r.value for r in df.collect())
        assert [r.value for r in df.orderBy("seq").collect()] == want
        seen = []
        jobs.start(readers.read_topic(spark, f"{root}/t", stream=True), "r_order", lambda b, i: seen.extend(b.collect())).awaitTermination()
        assert [r.value for r in sorted(seen, key=lambda r: r.seq)] == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_typed_dimension_tables_grow_while_the_job_runs(spark):
    """K6 + S6: a table and a column that the configuration adds, deletes,
    older changes that come later, folds in between; then as a lookup."""
    from tidemart.streaming import dims as typed
    root = folder()
    config = lambda *tables: snapshots.publish(spark.createDataFrame(
        [("r", t, f"dim_{t}", cols, "id", extend, n) for n, (t, cols, extend) in enumerate(tables)], fx.CONFIG_SCHEMA), f"{root}/config")
    change = lambda table, kind, ts, **d: json.dumps({"table": table, "type": kind, "ts": str(ts), "data": d})
    sku = ("sku_info", "id, sku_name", " SALT_BUCKETS = 3")
    config(sku)
    inputs = topics.Inputs(spark, f"{root}/db", stream=True, config=f"{root}/config", dims_root=f"{root}/dims")
    with runtime.settings(fold_every=2):
        (q,) = topics.run(inputs, "dim_tables", f"{root}/dims", every="500ms")

    def step(n, *lines):
        add_lines(f"{root}/db", lines, n)
        q.processAllAvailable()

    read = lambda t, **kw: rows(typed.read_dim(spark, f"{root}/dims", t, **kw))
    step(0, change("sku_info", "insert", 5, id="1", sku_name="a", spu_id="x"), change("sku_info", "insert", 5, id="2", sku_name="b"), "{bad")
    assert read("dim_sku_info") == [("1", "a"), ("2", "b")]
    config(("sku_info", "id,sku_name,spu_id", " SALT_BUCKETS = 3"), ("spu_info", "id,spu_name", None))
    step(1, change("sku_info", "update", 6, id="2", sku_name="b2", spu_id="y"), change("sku_info", "update", 4, id="1", sku_name="old", spu_id="z"))
    assert typed.read_dim(spark, f"{root}/dims", "dim_sku_info").columns == ["id", "sku_name", "spu_id"]
    assert read("dim_sku_info") == [("1", "a", None), ("2", "b2", "y")] and read("dim_spu_info") == []
    for n in range(2, 7):
        step(n, change("sku_info", "insert", 10 + n, id=str(n + 10), sku_name=f"n{n}", spu_id="y"), change("spu_info", "insert", n, id="y", spu_name=f"spu{n}"))
    step(7, change("sku_info", "delete", 30, id="12", sku_name="n2", spu_id="y"))
    runtime.stop([q])
    want = [("1", "a", None), *[(str(n + 10), f"n{n}", "y") for n in range(2, 7)], ("2", "b2", "y")]
    assert read("dim_sku_info") == sorted(want, key=repr) and ("12", "n2", "y") not in read("dim_sku_info", apply_deletes=True)
    assert read("dim_spu_info") == [("y", "spu6")]
    buckets = {f.split("/p=")[1].split("/")[0] for f in parts_of(f"{root}/dims/dim_sku_info")}
    assert buckets <= {"0", "1", "2"} and rows(spark.read.parquet(f"{root}/dims_dirty"), "line") == [("{bad",)]
    for t in topics.DIM_TABLES[2:]:
        spark.createDataFrame([("p", "x")], "id string, name string").write.parquet(f"{root}/dims/{t}.parquet")
    lookup = inputs.dims()
    assert rows(lookup["sku_info"], "id", "spu_id")[0] == ("1", None) and rows(lookup["base_province"]) == [("p", "x")]
