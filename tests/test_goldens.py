"""Hand goldens for the state operators, routing and config handling."""

import json

from pyspark.sql import functions as F

from tidemart.operators import dims, visits
from tidemart.operators.enrich import dic_lookup, lookup
from tidemart.operators.keyed import latest_rows
from tidemart.functions import cdc
from tidemart.functions.tokenize import explode_keywords, register_table_function
from tidemart.plans import log as logplans

DAY = 86_400_000
PAGE_SCHEMA = ("mid string, uid string, vc string, ch string, ar string, is_new string, page_id string, "
               "last_page_id string, item string, item_type string, during_time long, ts long, seq long")


def page_rows(spark, rows):
    full = [(m, m, "v", "c", "a", "1", p, last, None, None, 1, ts, i)
            for i, (m, p, last, ts) in enumerate(rows)]
    return spark.createDataFrame(full, PAGE_SCHEMA)


def test_jump_reference_sample(spark):
    # The four records given in the reference: only mid 101 bounces.
    df = page_rows(spark, [("101", "home", None, 10000), ("102", "home", None, 12000),
                           ("102", "good_list", "home", 15000), ("102", "good_list", "detail", 30000)])
    out = logplans.user_jump_detail(df, 10).select("mid", "ts").collect()
    assert [(r.mid, r.ts) for r in out] == [("101", 10000)]


def test_jump_entry_followed_by_entry_and_gap(spark):
    df = page_rows(spark, [("1", "home", None, 0), ("1", "home", None, 5000),      # entry then entry: bounce
                           ("1", "x", "home", 9000),                               # 5000 not a bounce
                           ("2", "home", None, 0), ("2", "x", "home", 10000),      # gap = W: bounce
                           ("3", "home", None, 3_599_999), ("3", "x", "home", 3_600_001)])  # across buckets
    got = sorted((r.mid, r.ts) for r in logplans.user_jump_detail(df, 10).collect())
    assert got == [("1", 0), ("2", 0)]


def test_jump_bucket_boundary_matches_plain_lead(spark):
    rows = []
    for m in range(5):
        t = 0
        for i in range(40):
            t += (i * 7919 + m * 104729) % 15000
            rows.append((str(m), "p", None if (i + m) % 3 else "home", t))
    df = page_rows(spark, rows)
    fast = sorted((r.mid, r.ts) for r in visits.bounce_entries(df, 10000, bucket_ms=20000).collect())
    # brute force
    exp = []
    for m in range(5):
        seq = [(t, last) for (mm, _, last, t) in rows if mm == str(m)]
        seq.sort()
        for i, (t, last) in enumerate(seq):
            if last is not None:
                continue
            nxt = seq[i + 1] if i + 1 < len(seq) else None
            if nxt is None or nxt[0] - t >= 10000 or nxt[1] is None:
                exp.append((str(m), t))
    assert fast == sorted(exp)


def test_new_visitor_repair(spark):
    s = "mid string, is_new string, ts long, seq long"
    df = spark.createDataFrame([
        ("a", "1", 0, 0), ("a", "1", 1000, 1), ("a", "1", DAY + 5, 2),   # new only on its first day
        ("b", "0", 0, 3), ("b", "1", 1000, 4),                           # first says old: never new
    ], s)
    got = {(r.mid, r.seq): r.is_new for r in visits.repair_new_flag(df).collect()}
    assert got == {("a", 0): "1", ("a", 1): "1", ("a", 2): "0", ("b", 3): "0", ("b", 4): "0"}


def test_login_back_user(spark):
    df = spark.createDataFrame([("u", 0, 0), ("u", 1000, 1), ("u", 8 * DAY, 2), ("u", 9 * DAY, 3)],
                               "uid string, ts long, seq long")
    got = sorted((r.ts, r.uu_ct, r.back_ct) for r in visits.login_flags(df, "uid", 8).collect())
    assert got == [(0, 1, 0), (8 * DAY, 1, 1), (9 * DAY, 1, 0)]


def test_lookup_misses(spark):
    """J6 drops rows whose code is unknown, J8 keeps them with nulls."""
    rows = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "id string, code string")
    dic = spark.createDataFrame([("a", "A")], "dic_code string, dic_name string")
    assert [tuple(r) for r in dic_lookup(rows, dic, "code", "name").select("id", "name").collect()] == [("1", "A")]
    left = lookup(rows, dic, "code", {"dic_name": "name"}, dim_key="dic_code")
    assert sorted((r.id, r.name) for r in left.collect()) == [("1", "A"), ("2", None), ("3", None)]


def test_latest_version_ties_break_on_arrival(spark):
    df = spark.createDataFrame([("x", 1, 1, "old"), ("x", 2, 1, "mid"), ("x", 2, 2, "new"), ("y", 1, 1, "only")],
                               "id string, row_op_ts long, arrival long, v string")
    got = {r.id: r.v for r in latest_rows(df, ["id"], ["row_op_ts", "arrival"]).collect()}
    assert got == {"x": "new", "y": "only"}


def test_cart_increase_only(spark):
    env = spark.createDataFrame([
        ("cart_info", "insert", {"sku_num": "3"}, None),
        ("cart_info", "update", {"sku_num": "5"}, {"sku_num": "2"}),
        ("cart_info", "update", {"sku_num": "1"}, {"sku_num": "4"}),
        ("cart_info", "update", {"sku_num": "9"}, {"user_id": "7"}),
    ], "table string, type string, data map<string,string>, old map<string,string>")
    keep, delta = cdc.increase_delta("sku_num")
    got = sorted(r.d for r in env.filter(keep).select(delta.alias("d")).collect())
    assert got == ["3", "3"]


def test_log_routing_and_dirty(spark):
    lines = [
        json.dumps({"common": {"mid": "m", "is_new": "1"}, "page": {"page_id": "home"},
                    "displays": [{"item": "1"}, {"item": "2"}], "actions": [{"action_id": "a"}], "ts": 1}),
        json.dumps({"common": {"mid": "m"}, "start": {"entry": "icon"}, "err": {"error_code": "1"}, "ts": 2}),
        json.dumps({"common": {"uid": "no-mid"}, "page": {"page_id": "home"}, "ts": 3}),
        '{"common": {"mid": "m"}, "ts": ',
        "",
    ]
    raw = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, seq long")
    r = logplans.log_split(raw)
    counts = {k: v.count() for k, v in r.items()}
    assert counts == {"page": 1, "start": 1, "display": 2, "action": 1, "error": 1, "dirty": 3}
    assert r["action"].columns == ["action", "common", "page"]  # actions lose ts
    assert "err" not in r["page"].columns and "displays" not in r["page"].columns


def test_dim_config_fold_and_exact_whitelist(spark):
    changes = spark.createDataFrame([
        ("r", "t1", "dim_t1", "id,tm_id", None, None, 0),
        ("r", "t2", "dim_t2", "id,name", "id", None, 0),
        ("d", "t2", "dim_t2", "id,name", "id", None, 1),
    ], "op string, source_table string, sink_table string, sink_columns string, sink_pk string, "
       "sink_extend string, ts bigint")
    conf = dims.fold_config(changes)
    assert sorted(r.source_table for r in conf.collect()) == ["t1"]
    env = spark.createDataFrame([
        ("t1", "insert", {"id": "1", "tm_id": "a", "m_i": "x"}, "5"),
        ("t1", "update", {"id": "1", "tm_id": "b", "m_i": "x"}, "6"),
        ("t1", "bootstrap-start", None, "4"),
        ("t2", "insert", {"id": "9", "name": "n"}, "5"),
    ], "table string, type string, data map<string,string>, ts string")
    rows = dims.dim_rows(env, conf).collect()
    assert len(rows) == 1 and rows[0].sink_table == "dim_t1" and rows[0].data == {"id": "1", "tm_id": "b"}
    assert dims.dim_schema("id,tm_id").fieldNames() == ["id", "tm_id"]


def test_tokenizer(spark):
    df = spark.createDataFrame([("Small Ring-2x",), ("苹果手机 abc红",), (None,)], "item string")
    want = ["2x", "abc", "ring", "small", "手机", "果手", "红", "苹果"]
    assert sorted(r.keyword for r in explode_keywords(df, "item").collect()) == want
    register_table_function(spark)
    df.createOrReplaceTempView("tokenizer_in")
    rows = spark.sql("SELECT keyword FROM tokenizer_in, LATERAL ik_analyze(item)").collect()
    assert sorted(r.keyword for r in rows) == want


def test_timestamp_compare_is_native(spark):
    df = spark.createDataFrame([("2022-04-01 10:20:55.04",), ("2022-04-01 10:20:55.039",)], "t string")
    a, b = [r.ts for r in df.select(F.to_timestamp("t").alias("ts")).collect()]
    assert a > b


def test_cdc_dirty_routing(spark):
    from tidemart.sources.readers import cdc_records
    lines = [json.dumps({"database": "shop", "table": "cart_info", "type": "insert",
                         "data": {"id": "1", "sku_num": 2}, "ts": "5"}),
             '{"table": "cart_info", "data": {', "", json.dumps({"type": "insert"})]
    topic = spark.createDataFrame([(v,) for v in lines], "value string")
    rec, dirty = cdc_records(topic, with_dirty=True)
    r = rec.collect()
    assert len(r) == 1 and r[0].data == {"id": "1", "sku_num": "2"} and r[0].table == "cart_info"
    assert dirty.count() == 3
