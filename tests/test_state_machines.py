"""State-machine parity: the per-key operators (T1, T2, T4, T5, T6) as
plain sequential Python over event-ordered rows, compared with the batch
DataFrame forms on seeded random inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import visits
from tidemart.plans import log as logplans
from tidemart.plans import metrics

DAY = 86_400_000


def day(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).date()


def rows_for(seed, n=400, keys=6, days=12):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        ts = rnd.randrange(0, days * DAY)
        if rnd.random() < 0.2 and out:                 # exact timestamp ties
            ts = out[-1][2]
        out.append((f"m{rnd.randrange(keys)}", rnd.choice(["0", "1"]), ts, i,
                    rnd.choice([None, None, "home", "login"]), rnd.choice(["home", "good_detail", "x"])))
    return out


def page_df(spark, rows):
    data = [(m, m, "v", "c", "a", isnew, page, last, None, None, 1, ts, seq)
            for (m, isnew, ts, seq, last, page) in rows]
    return spark.createDataFrame(
        data, "mid string, uid string, vc string, ch string, ar string, is_new string, page_id string, "
              "last_page_id string, item string, item_type string, during_time long, ts long, seq long")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_t1_repair(spark, seed):
    rows = rows_for(seed)
    state, exp = {}, {}
    for m, isnew, ts, seq, _, _ in sorted(rows, key=lambda r: (r[2], r[3])):
        d = day(ts)
        if m not in state:
            state[m] = d if isnew == "1" else d - dt.timedelta(days=1)
        exp[seq] = "1" if isnew == "1" and state[m] == d else "0"
    df = page_df(spark, rows).select("mid", "is_new", "ts", "seq")
    got = {r.seq: r.is_new for r in visits.repair_new_flag(df).collect()}
    assert got == exp


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_t2_unique_visitor(spark, seed):
    rows = rows_for(seed)
    last, exp = {}, set()
    for m, _, ts, seq, lastpage, _ in sorted(rows, key=lambda r: (r[2], r[3])):
        if lastpage is not None:
            continue
        if last.get(m) != day(ts):
            last[m] = day(ts)
            exp.add(seq)
    got = {r.seq for r in logplans.unique_visitor_detail(page_df(spark, rows)).collect()}
    assert got == exp


@pytest.mark.parametrize("seed", [1, 2])
def test_t4_home_detail(spark, seed):
    rows = rows_for(seed)
    last, per_window = {}, {}
    for m, _, ts, seq, _, page in sorted(rows, key=lambda r: (r[2], r[3])):
        if page not in ("home", "good_detail"):
            continue
        if last.get((m, page)) != day(ts):
            last[(m, page)] = day(ts)
            w = ts - ts % 10_000
            h, d = per_window.get(w, (0, 0))
            per_window[w] = (h + (page == "home"), d + (page == "good_detail"))
    got = {r.stt: (r.home_uv_ct, r.good_detail_uv_ct)
           for r in metrics.home_detail_uv(page_df(spark, rows)).collect()}
    fmt = lambda w: dt.datetime.fromtimestamp(w / 1000, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    assert got == {fmt(w): v for w, v in per_window.items()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("back", [3, 8])
def test_t5_login(spark, seed, back):
    rows = rows_for(seed, days=40)
    last, exp = {}, []
    for m, _, ts, seq, lastpage, _ in sorted(rows, key=lambda r: (r[2], r[3])):
        if lastpage not in (None, "login"):
            continue
        d = day(ts)
        if last.get(m) != d:
            b = int(m in last and (d - last[m]).days >= back)
            exp.append((ts, 1, b))
            last[m] = d
    df = page_df(spark, rows).filter("last_page_id IS NULL OR last_page_id = 'login'").select("uid", "ts")
    got = sorted((r.ts, r.uu_ct, r.back_ct) for r in visits.login_flags(df, "uid", back).collect())
    assert got == sorted(exp)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_t6_unique_new(spark, seed):
    rows = rows_for(seed)
    last, exp = {}, {}
    for m, _, ts, seq, _, _ in sorted(rows, key=lambda r: (r[2], r[3])):
        d, w = day(ts), ts - ts % 10_000
        uu, new = exp.get(w, (0, 0))
        exp[w] = (uu + (last.get(m) != d), new + (m not in last))
        last[m] = d
    fmt = lambda w: dt.datetime.fromtimestamp(w / 1000, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    df = page_df(spark, rows).selectExpr("mid AS user_id", "ts", "'x' AS source_type_name")
    df = df.withColumn("ts", (F.col("ts") / 1000).cast("long").cast("string"))
    got = {r.stt: (r.order_unique_user_count, r.order_new_user_count) for r in metrics.trade_order(df).collect()}
    assert got == {fmt(w): v for w, v in exp.items()}
