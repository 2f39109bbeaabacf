"""Packed texts, and the pre-process table whose lines are shuffled packed."""

import random
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemart.functions import compact
from tidemart.plans import trade
from tidemart.plans.registry import QUERIES
from tidemart.sources import fixtures as fx

ODD = [None, "", "0", "007", "-1", "1.50", "2020-01-01 00:00:00", "12", "1E5", "E", "F", "a", "AB", "12 ", " ", "--", "\x01", "ff", "苹果", "١٢"]


def test_packed_texts_come_back_whatever_they_hold(spark):
    r = random.Random(7)
    texts = {"": ["a", "b"], "-: ": ["c"], "-.": ["d"]}
    rows = [(i, *(r.choice(ODD if r.random() < .3 else [None, "", "12", "345"]) for _ in "abcd")) for i in range(2000)]
    df = spark.createDataFrame(rows, "i int, a string, b string, c string, d string")
    # Bytes that are no UTF-8.
    df = df.union(spark.sql("SELECT -1, '1', CAST(x'ff31' AS STRING), CAST(x'c3' AS STRING), '2'"))
    hexed = lambda rows: {r.i: tuple(r) for r in rows.select("i", *[F.hex(c).alias(c) for c in "abcd"]).collect()}
    packed = compact.pack(df, texts)
    assert packed.columns == ["i", compact.PACKED, compact.REST]
    assert 500 < packed.filter(F.col(compact.REST).isNull()).count() < 2000
    assert hexed(compact.unpack(packed, texts)) == hexed(df)
    assert hexed(packed.select("i", *[compact.value(texts, c).alias(c) for c in "abcd"])) == hexed(df)


def test_packed_keys_are_equal_where_the_texts_are(spark):
    texts = sorted({*filter(None, ODD), "", "1", "1E", "12-3", "1-23", "123", "-", "123-"})
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").union(spark.sql("SELECT CAST(x'ff31' AS STRING)"))
    df = df.select("t", compact.pack_key(F.col("t")).alias("k"))
    assert df.filter("(t IS NULL) <> (k IS NULL)").count() == 0
    assert df.select("k").distinct().count() == df.count() == len(texts) + 2
    assert df.filter(~compact.unpack_key(F.col("k")).eqNullSafe(F.col("t"))).count() == 0


def test_the_exchange_by_detail_id_takes_packed_lines(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "4000")
    try:
        plan = QUERIES["trade_order_pre_process"](spark, SF_SMALL)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set(key, before)
    (taken,) = re.findall(r"\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(id#", plan)
    assert {x.strip().split("#")[0] for x in taken.split(",")} == {"id", "sku_name", "source_type_name", "type", "old", "_packed", "_rest"}
    # The orders are read once for both versions.
    assert plan.count("Generate") > 0 and "Union" not in plan


def _env(spark, seq):
    """Ids with letters and signs, nulls, repeated rows, several promotions."""
    def order(n, status, ts, kind="update", user="7"):
        return "order_info", kind, {"id": n, "user_id": user, "province_id": "-3", "order_status": status, "operate_time": None if kind == "insert" else "2020-01-01 10:00:00"}, None, ts

    def line(i, n, ts, price="1.50", source="1"):
        return "order_detail", "insert", {"id": i, "order_id": n, "source_type": source, "sku_num": "2", "order_price": price, "sku_name": "s E\x02", "create_time": "2020-01-01 09:00:00",
                                          "split_total_amount": "-3.00", "split_coupon_amount": ""}, None, ts

    rows = [order("1", "1001", "10", "insert"), order("1", "1003", "30"), order("1", "1005", "20"), order("A-1", "1001", "40", "insert", "abc"),
            order(None, "1001", "1", "insert"), order("4", "x", "50"), order("4", "x", "50"),
            line("a", "1", "25"), line("a", "1", "35", "2.50"), line("1-2", "1", "50"), line("12", "1", "50"), line("FF", "A-1", "9"), line("-7", "A-1", "9"),
            line(None, "A-1", "9"), line("d", None, "9"), line("e", "1", "9", source="7"), line("1-2", "4", "9"), line("", "4", "9"), line("12-", "4", "9"), line("12-", "4", "9"),
            *[("order_detail_activity", "insert", {"order_detail_id": i, "activity_id": "x", "activity_rule_id": "1"}, None, "1") for i in ("1-2", "a", "12-", "12-", None)],
            *[("order_detail_coupon", "insert", {"order_detail_id": i, "coupon_id": "y"}, None, "1") for i in ("FF", "", "12", "A")]]
    if seq:
        return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "table string, type string, data map<string,string>, old map<string,string>, ts string, seq bigint")
    return spark.createDataFrame(rows, "table string, type string, data map<string,string>, old map<string,string>, ts string")


def test_packed_pre_process_equals_the_upserted_changelog(spark):
    dic = spark.createDataFrame([("1", "one"), ("2", "two")], "dic_code string, dic_name string")
    for seq in (False, True):
        env = _env(spark, seq)
        want = trade.order_pre_process(trade.order_pre_process_changelog(env, dic)).drop("arrival")
        got = trade.order_pre_process_table(env, dic)
        assert got.columns == want.columns == trade.PRE_PROCESS_COLS
        rows = lambda df: sorted(str(r.asDict()) for r in df.collect())
        assert rows(got) == rows(want)
        assert sorted(str(r.id) for r in got.collect()) == sorted(["a", "1-2", "12", "FF", "-7", "None", "", "12-"])


def test_versions_read_together_are_those_of_the_branches(spark):
    rows = lambda together: sorted(fx.topic_db(spark, SF_SMALL, ["order_info"], together=together).select(F.to_json(F.struct("*"))).toPandas().iloc[:, 0])
    assert rows(True) == rows(False)
