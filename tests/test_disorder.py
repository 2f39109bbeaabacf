"""Streams on shuffled input: late rows, other devices ahead, deletes, older
changes after newer ones, a restart, a configuration that changes."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemart import cli, topics
from tidemart.constants import JOIN_TTL_ORDER_SECONDS, JOIN_TTL_REFUND_SECONDS
from tidemart.operators import dims as dimops
from tidemart.plans import log as logplans
from tidemart.plans import metrics, trade
from tidemart.plans import registry as R
from tidemart.session import checkpoint_root, ship_package
from tidemart.sources import fixtures as fx
from tidemart.sources import sinks
from tidemart.streaming import jobs, state

from conftest import SF_SMALL
from test_streaming import _stream_of

DAY = 86_400_000


def folder():
    return tempfile.mkdtemp(prefix="disorder-")


def feed(spark, path, batches, schema):
    """One file for each batch, in order of time."""
    os.makedirs(path, exist_ok=True)
    n = len(os.listdir(path))
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        for f in os.listdir(path):
            p = os.path.join(path, f)
            if f.endswith(".parquet") and os.path.getmtime(p) > 2_000_000:
                os.utime(p, (1_000_000 + n, 1_000_000 + n))
        n += 1
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def pages(*rows):
    return [(m, m, "v", "c", "a", "1", "home", last, None, None, 1, ts, i) for i, (m, last, ts) in enumerate(rows)]


def test_bounce_survives_another_device_ahead(spark):
    out, src = folder() + "/out", folder()
    batches = [pages(("ahead", None, 1_000_000)), pages(("late", None, 100_000), ("ok", None, 995_000), ("ok", "home", 999_000)),
               pages(("late", None, 200_000), ("late", "home", 201_000)), pages(("ahead", None, 2_000_000))]
    stream = feed(spark, src, batches, jobs.FLAT_PAGE_SCHEMA)
    jobs.user_jump_detail(stream, out, name="d_jump").awaitTermination()
    got = {(r.mid, r.ts) for r in spark.read.parquet(out).collect()}
    # "ahead" bounces (its next entry), "late" at 100 s is past its horizon when it comes; "ok" goes on; what is
    # older than the watermark (0 s behind) when its batch comes is dropped.
    assert ("ahead", 1_000_000) in got and ("late", 100_000) in got
    assert not {("ok", 995_000), ("late", 200_000)} & got


def test_first_per_day_counts_a_late_day(spark):
    out, src = folder() + "/out", folder()
    batches = [pages(("m", None, 5 * DAY + 10)), pages(("m", None, 4 * DAY + 10), ("m", None, 4 * DAY + 20), ("n", None, 5 * DAY)),
               pages(("m", None, 5 * DAY + 5), ("m", None, 9 * DAY)), pages(("m", None, 4 * DAY + 30), ("m", None, 9 * DAY + 1))]
    jobs.unique_visitor_detail(feed(spark, src, batches, jobs.FLAT_PAGE_SCHEMA), out, name="d_uv").awaitTermination()
    got = sorted((r.mid, r.ts // DAY) for r in spark.read.parquet(out).collect())
    assert got == [("m", 4), ("m", 5), ("m", 9), ("n", 5)]


def test_first_per_day_state_is_dropped(spark):
    src = folder()
    batches = [pages(*[(f"m{i}", None, d * DAY + i) for i in range(20)]) for d in (1, 2, 5, 9, 12)]
    firsts = state.first_per_day(feed(spark, src, batches, jobs.FLAT_PAGE_SCHEMA), ["mid"])
    q = jobs.start(firsts, "d_evict", lambda b, i: sinks.write_append(b, src + "-out", "parquet", batch_id=i))
    q.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert spark.read.parquet(src + "-out").count() == 100 and kept[-1] <= 40


@pytest.mark.parametrize("seed", [1, 2])
def test_unique_visitors_on_shuffled_files(spark, seed):
    page = R.page(spark, SF_SMALL).orderBy(F.xxhash64("seq", F.lit(seed))).collect()
    batches = [[tuple(r[c] for c in jobs.FLAT_PAGE_SCHEMA.names) for r in page[k::5]] for k in range(5)]
    out = folder() + "/out"
    stream = feed(spark, folder(), batches, jobs.FLAT_PAGE_SCHEMA)
    jobs.unique_visitor_detail(stream, out, keep_days=4000, name=f"d_shuffled{seed}").awaitTermination()
    rows = lambda df: sorted((r.mid, r.ts // DAY) for r in df.collect())
    assert rows(spark.read.parquet(out)) == rows(logplans.unique_visitor_detail(R.page(spark, SF_SMALL)))


ENV = "table string, type string, data map<string,string>, old map<string,string>, ts string"


def change(kind, ts, table="t", **values):
    return (table, kind, values, None, str(ts))


def config_rows(*rows):
    return [("r", t, f"dim_{t}", cols, "id", None, n) for n, (t, cols) in enumerate(rows)]


def test_dims_deletes_order_and_restart(spark):
    """A delete in a later batch removes the row, an older change that comes
    later loses, and a restart goes on where the job stopped."""
    conf = dimops.fold_config(spark.createDataFrame(config_rows(("t", "id, v")), fx.CONFIG_SCHEMA))
    out, src = folder() + "/out", folder()
    first = [[change("insert", 1, id="1", v="a", w="x"), change("insert", 1, id="2", v="a"), change("insert", 9, id="3", v="NEW")]]
    second = [[change("delete", 5, id="1", v="a")], [change("update", 3, id="3", v="OLD"), change("update", 4, id="2", v="b")]]
    jobs.dim_sink(feed(spark, src, first, ENV), conf, out, "d_dims").awaitTermination()
    jobs.dim_sink(feed(spark, src, second, ENV), conf, out, "d_dims").awaitTermination()
    want = {"2": {"id": "2", "v": "b"}, "3": {"id": "3", "v": "NEW"}}
    assert {r.id: r.data for r in jobs.read_dims(spark, out, apply_deletes=True).collect()} == want
    everything = spark.createDataFrame([r for b in (*first, *second) for r in b], ENV)
    assert {r.id: r.data for r in dimops.dim_rows(everything, conf, apply_deletes=True).collect()} == want
    assert {r.id for r in jobs.read_dims(spark, out).collect()} == {"1", "2", "3"}


def test_dims_config_changes_while_running(spark):
    path, out, src = folder() + "/config", folder() + "/out", folder()
    put = lambda *rows: spark.createDataFrame(config_rows(*rows), fx.CONFIG_SCHEMA).write.mode("overwrite").parquet(path)
    config = lambda: dimops.fold_config(spark.read.parquet(path))
    put(("t", "id"))
    jobs.dim_sink(feed(spark, src, [[change("insert", 1, id="1"), change("insert", 1, "u", id="7")]], ENV), config, out, "d_conf").awaitTermination()
    put(("t", "id"), ("u", "id"))
    jobs.dim_sink(feed(spark, src, [[change("insert", 2, "u", id="8")]], ENV), config, out, "d_conf").awaitTermination()
    assert sorted((r.sink_table, r.id) for r in jobs.read_dims(spark, out).collect()) == [("dim_t", "1"), ("dim_u", "8")]


def test_dim_tables_are_created(spark):
    root = folder()
    conf = dimops.fold_config(spark.createDataFrame(
        [("r", "x", "dim_k6_a", "id, v", "id", " SALT_BUCKETS = 4", 0), ("r", "y", "dim_k6_b", "k,v", "k", None, 0)], fx.CONFIG_SCHEMA))
    assert sorted(dimops.create_tables(spark, conf, root)) == ["dim_k6_a", "dim_k6_b"]
    assert spark.table("dim_k6_a").dtypes == [("id", "string"), ("v", "string")] and spark.table("dim_k6_b").count() == 0
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED dim_k6_a").collect()}
    assert described["Num Buckets"] == "4" and described["Bucket Columns"] == "[`id`]"
    for t in ("dim_k6_a", "dim_k6_b"):
        spark.sql(f"DROP TABLE {t}")


def test_compaction(spark):
    path, schema = folder() + "/table", "k string, ts long, v string"
    for n in range(12):
        sinks.upsert_batch(spark.createDataFrame([("a", 100 - n, f"a{n}"), (f"k{n}", 1, "x")], schema), path, n)
    read = lambda: sorted(tuple(r) for r in sinks.read_upserted(spark, path, ["k"], ["ts"]).collect())
    before = read()
    assert ("a", 100, "a0") in before and len(before) == 13
    many = len(sinks.read_changes(spark, path).inputFiles())
    assert sinks.compact(spark, path, ["k"], ["ts"], drop_folded=True) == 11
    assert read() == before and len(sinks.read_changes(spark, path).inputFiles()) < many
    sinks.upsert_batch(spark.createDataFrame([("a", 200, "new")], schema), path, 12)
    sinks.upsert_batch(spark.createDataFrame([("k3", 1, "x")], schema), path, 11)  # a replay of a folded batch
    after = [r for r in before if r[0] != "a"] + [("a", 200, "new")]
    assert read() == sorted(after)
    assert sinks.compact(spark, path, ["k"], ["ts"]) == 12 and read() == sorted(after)


@pytest.mark.parametrize("name", ["trade_cancel_detail", "trade_pay_detail_suc", "trade_order_refund", "trade_refund_pay_suc"])
def test_join_jobs_equal_batch(spark, name):
    """With a join bound that spans the fixture's delays; inner joins on shuffled files."""
    tables = ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon", "payment_info", "order_refund_info", "refund_payment"]
    env = fx.topic_db(spark, SF_SMALL, tables).select("table", "type", "data", "old", "ts")
    dic, out = fx.base_dic(spark, SF_SMALL), folder() + "/out"
    path = folder() + "/env"
    env.repartition(3).write.parquet(path)
    stream = lambda p: spark.readStream.schema(spark.read.parquet(p).schema).option("maxFilesPerTrigger", 1).parquet(p)
    ttl = 10 * 366 * 86400  # the files are in no order of time
    if name == "trade_cancel_detail":
        _, ordered = _stream_of(spark, env, "ts", "cancel-")  # the outer joins wait for the watermark
        q = jobs.cancel_detail(ordered.drop("_o"), dic, out, 4000, "d_cancel")
    elif name == "trade_pay_detail_suc":
        details = folder() + "/details"
        R.order_detail(spark, SF_SMALL).repartition(2).write.parquet(details)
        q = jobs.pay_detail_suc(stream(details), stream(path), dic, out, ttl, name="d_pay")
    else:
        q = (jobs.order_refund if name == "trade_order_refund" else jobs.refund_pay_suc)(stream(path), dic, out, ttl, name=f"d_{name}")
    q.awaitTermination()
    exp = R.QUERIES[name](spark, SF_SMALL)
    got = jobs.read_payments(spark, out) if name == "trade_pay_detail_suc" else spark.read.parquet(out).drop("batch_id")
    rows = lambda df: sorted((tuple(r) for r in R.finalize(df.select(*exp.columns)).collect()), key=repr)
    if name == "trade_cancel_detail":  # the last lines wait for the outer joins' bound
        assert set(rows(got)) <= set(rows(exp)) and len(rows(got)) > 0.9 * len(rows(exp))
    else:
        assert rows(got) == rows(exp) and len(rows(exp)) > 0


@pytest.mark.parametrize("name", ["trade_order_detail", "trade_cancel_detail", "trade_pay_detail_suc", "trade_order_refund", "trade_refund_pay_suc"])
def test_joins_meet_their_bounds(spark, name):
    """The partner of order n comes ``gap`` seconds from its line: joined up to
    the bound of the reference's state (905 s, 5 s) on both sides, not beyond."""
    order = name in ("trade_order_detail", "trade_cancel_detail", "trade_pay_detail_suc")
    ttl = JOIN_TTL_ORDER_SECONDS if order else JOIN_TTL_REFUND_SECONDS
    gaps = [-ttl - 1, -ttl, -1, 0, 1, ttl, ttl + 1]
    t0, out = 1_000_000, folder() + "/out"

    def changes(n, ts, gap):
        o, line = {"id": f"o{n}", "user_id": "u"}, {"id": f"d{n}", "order_id": f"o{n}", "sku_id": "s", "source_type": "1", "refund_type": "1",
                                                   "refund_reason_type": "1", "payment_type": "1", "create_time": "2024-01-01 00:00:00"}
        detail = ("order_detail", "insert", line | {"sku_num": "1", "order_price": "1.00"}, None, str(ts))
        extras = [("order_detail_activity", "insert", {"order_detail_id": f"d{n}", "activity_id": "7"}, None, str(ts + gap)),
                  ("order_detail_coupon", "insert", {"order_detail_id": f"d{n}", "coupon_id": "8"}, None, str(ts))]
        if name == "trade_order_detail":  # the activity is the partner, an outer one
            return [detail, *extras, ("order_info", "insert", o, None, str(ts))]
        if name == "trade_cancel_detail":
            return [detail, extras[1], extras[0][:4] + (str(ts),), ("order_info", "update", o | {"order_status": "1003"}, {"order_status": "1001"}, str(ts + gap))]
        if name == "trade_pay_detail_suc":
            return [("payment_info", "update", {"order_id": f"o{n}", "payment_type": "1"}, {"payment_status": "1601"}, str(ts + gap))]
        refunded = ("order_info", "update", o | {"order_status": "1005"}, {"order_status": "1001"}, str(ts + gap))
        if name == "trade_order_refund":
            return [("order_refund_info", "insert", line, None, str(ts)), refunded]
        return [("refund_payment", "update", line | {"refund_status": "0702"}, {"refund_status": "0701"}, str(ts)), refunded,
                ("order_refund_info", "insert", line, None, str(ts))]

    plan = [(n, t0, gap) for n, gap in enumerate(gaps)]
    late = [(900 + k, t0 + (k + 1) * 100 * ttl, 0) for k in range(3)]  # later rows take the watermark past the outer joins
    batches = [[r for x in plan for r in changes(*x)], *[changes(*x) for x in late]]
    env = feed(spark, folder(), batches, ENV)
    dic = spark.createDataFrame([("1", "one")], "dic_code string, dic_name string")
    if name == "trade_pay_detail_suc":
        details = ", ".join(f"{c} {'timestamp' if c == 'row_op_ts' else 'long' if c == 'arrival' else 'string'}" for c in topics.ORDER_DETAIL)
        row = lambda n, ts: tuple({"id": f"d{n}", "order_id": f"o{n}", "ts": str(ts)}.get(c) for c in topics.ORDER_DETAIL)
        lines = feed(spark, folder(), [[row(n, ts) for n, ts, _ in plan], *[[row(n, ts)] for n, ts, _ in late]], details)
        q = jobs.pay_detail_suc(lines, env, dic, out, name=f"b_{name}")
    else:
        q = getattr(jobs, name.removeprefix("trade_"))(env, dic, out, name=f"b_{name}")
    q.awaitTermination()
    got = spark.read.parquet(out)
    key = "order_detail_id" if name == "trade_pay_detail_suc" else "id"
    got = {r[key]: r for r in got.collect() if int(r[key][1:]) < 900}
    near = {f"d{n}" for n, gap in enumerate(gaps) if abs(gap) <= ttl}
    if name == "trade_order_detail":  # every line once, with its activity or without
        assert {k: r.activity_id for k, r in got.items()} == {f"d{n}": "7" if f"d{n}" in near else None for n in range(len(gaps))}
        assert {r.coupon_id for r in got.values()} == {"8"}
    else:
        assert set(got) == near


def test_jobs_on_topic_files(spark):
    """Lines in a folder -> log split -> a metric, in batch and as a stream,
    by the command line."""
    root = folder()
    lines = [json.dumps({"common": {"mid": f"m{i % 7}", "is_new": "1", "os": "x"}, "page": {"page_id": ("home", "good_detail")[i % 2],
             "last_page_id": None, "during_time": i, "source_type": "promotion"}, "displays": [{"item": "1"}], "ts": 1_600_000_000_000 + i * 4000}) for i in range(60)]
    spark.createDataFrame([(x,) for x in [*lines, "{broken"]], "value string").coalesce(1).write.text(f"{root}/log")
    assert cli.main(["run-job", "log_split", "--source", f"{root}/log", "--output", f"{root}/split", "--sink", "json"]) == 0
    record = json.loads(spark.read.text(f"{root}/split/page").first().value)
    assert record["common"]["os"] == "x" and record["page"]["source_type"] == "promotion"  # unknown fields travel on
    assert spark.read.text(f"{root}/split/dirty").count() == 1 and spark.read.text(f"{root}/split/display").count() == 60
    args = ["run-job", "dws_home_detail_uv", "--source", f"{root}/split/page"]
    assert cli.main([*args, "--output", f"{root}/batch"]) == 0
    assert cli.main([*args, "--output", f"{root}/stream", "--mode", "stream"]) == 0
    measures = ["home_uv_ct", "good_detail_uv_ct"]
    total = lambda df: tuple(df.agg(*[F.sum(m) for m in measures]).first())
    batch = spark.read.parquet(f"{root}/batch")
    assert total(batch) == total(jobs.read_partial_windows(spark, f"{root}/stream", [], measures)) == (7, 7)


def test_change_records_topic(spark):
    root = folder()
    rows = [{"database": "d", "table": "cart_info", "type": "insert", "ts": "100", "data": {"id": "1", "user_id": "u", "sku_id": "s", "sku_num": 2, "source_type": "1"}},
            {"database": "d", "table": "cart_info", "type": "update", "ts": "200", "data": {"id": "1", "user_id": "u", "sku_num": 5, "source_type": "1"}, "old": {"sku_num": 2}}]
    spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1).write.text(f"{root}/db")
    fx.base_dic(spark, SF_SMALL).write.parquet(f"{root}/dic")
    for mode in ("batch", "stream"):
        out = f"{root}/{mode}"
        assert cli.main(["run-job", "trade_cart_add", "--source", f"{root}/db", "--output", out, "--dictionary", f"{root}/dic", "--mode", mode]) == 0
        assert sorted(r.sku_num for r in spark.read.parquet(out).collect()) == ["2", "3"]
    assert set(topics.JOBS) >= {k for k in R.RAW if k.startswith(("trade_", "dws_")) and not k.endswith(("_1h", "_back3", "_latest", "_success_only"))}


def test_versions_of_one_second_keep_the_later_arrival(spark):
    """Equal times, the topic's order decides."""
    env = [("order_detail", "insert", {"id": "d", "order_id": "o", "sku_id": "s", "sku_num": "1", "order_price": "2.00", "create_time": "2024-01-01 00:00:00",
                                       "source_type": "1", "split_total_amount": "2.00"}, None, "100", 1)]
    env += [("order_info", kind, {"id": "o", "user_id": "u", "order_status": st, "operate_time": None}, None, "100", seq)
            for kind, st, seq in (("insert", "1001", 2), ("update", "1002", 9), ("update", "1003", 5))]
    df = spark.createDataFrame(env, ENV + ", seq long")
    dic = spark.createDataFrame([("1", "one")], "dic_code string, dic_name string")
    changes = trade.order_pre_process_changelog(df, dic)
    assert [r.order_status for r in trade.order_pre_process(changes).collect()] == ["1002"]
    sku = trade.order_detail(changes).withColumn("sku_id", F.lit("s"))
    versions = sku.unionByName(sku.withColumns({"split_total_amount": F.lit("7.00"), "arrival": F.col("arrival") + 1}))
    assert [r.order_amount for r in metrics.trade_sku_order(versions, fx.dim_tables(spark, SF_SMALL)).collect()] == [7.0]


def test_checkpoint_folder_must_be_shared_on_a_cluster(spark):
    class Conf:
        get = staticmethod(lambda k, d=None: None)

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Cluster())
    ship_package(spark)
    assert spark.conf.get("spark.tidemart.shipped") == "true"
