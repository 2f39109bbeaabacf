"""Keyed state functions for ``groupBy(key).applyInPandasWithState``.

Analytic windows are rejected on streams, so the per-key operators keep a
small state per key (a date, or one pending entry) exactly as the reference
does.  Each function sorts a group's rows by (ts, seq) inside the
micro-batch, so a batch holding several rows of one key is handled in event
order.  Dates use the zone passed in (the session time zone).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _dates(ms: pd.Series, tz: str) -> pd.Series:
    t = pd.to_datetime(ms, unit="ms", utc=True)
    if tz not in ("UTC", "GMT", "Z"):
        t = t.dt.tz_convert(tz)
    return t.dt.strftime("%Y-%m-%d")


def _sorted(pdfs: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return pd.DataFrame()
    return pd.concat(frames, ignore_index=True).sort_values(["ts", "seq"], kind="stable")


# ----------------------------------------------------------- T1 new visitor --
def repair_new_flag(df: DataFrame, tz: str = "UTC") -> DataFrame:
    """T1 stream: input ``mid, dirty, ts, seq, is_new, record``; output
    ``dirty, record, is_new`` with the repaired flag.  State: the device's
    first-visit date.  Groups of dirty lines pass as they are."""

    def fn(key, pdfs, state: GroupState):
        p = _sorted(pdfs)
        if p.empty:
            return
        if p["dirty"].iloc[0]:
            yield p[["dirty", "record", "is_new"]]
            return
        day = _dates(p["ts"], tz)
        if state.exists:
            first = state.get[0]
        else:
            d0 = pd.Timestamp(day.iloc[0])
            first = day.iloc[0] if p["is_new"].iloc[0] == "1" else (d0 - pd.Timedelta(days=1)).strftime("%Y-%m-%d")
            state.update((first,))
        fixed = p["is_new"].mask((p["is_new"] == "1") & (day != first), "0")
        yield pd.DataFrame({"dirty": False, "record": p["record"].values, "is_new": fixed.values})

    return df.groupBy("mid").applyInPandasWithState(
        fn, "dirty boolean, record string, is_new string", "first_dt string", "append", GroupStateTimeout.NoTimeout)


# ---------------------------------------------------------------- T3 bounce --
def bounce_entries(df: DataFrame, within_ms: int) -> DataFrame:
    """T3 stream: input ``mid, ts, seq, is_entry, record`` with a watermark;
    output ``record, ts`` of bounced entries.  State: the pending entry,
    released by the next row or by the event-time timeout.

    Vectorised per group: the pending entry (if any) is put in front of the
    sorted rows; an entry bounces when its next row is an entry or at least
    ``within_ms`` later; the last entry stays pending."""
    import numpy as np

    def fn(key, pdfs, state: GroupState):
        if state.hasTimedOut:
            ts, _, rec = state.get
            state.remove()
            yield pd.DataFrame({"record": [rec], "ts": [ts]})
            return
        p = _sorted(pdfs)
        if state.exists:
            pts, pseq, prec = state.get
            head = pd.DataFrame({"ts": [pts], "seq": [pseq], "is_entry": [True], "record": [prec]})
            p = head if p.empty else pd.concat([head, p[["ts", "seq", "is_entry", "record"]]],
                                               ignore_index=True)
        if p.empty:
            return
        ts = p["ts"].to_numpy(dtype="int64")
        entry = p["is_entry"].to_numpy(dtype=bool)
        nxt_ts = np.append(ts[1:], -1)
        nxt_entry = np.append(entry[1:], False)
        has_next = np.arange(len(ts)) < len(ts) - 1
        bounced = entry & has_next & ((nxt_ts - ts >= within_ms) | nxt_entry)
        due = int(ts[-1]) + within_ms
        if entry[-1] and due <= state.getCurrentWatermarkMs():
            # Its horizon is past (another device is ahead of this one): no
            # timeout could be set, and no row that still counts can follow.
            bounced[-1] = True
        if entry[-1] and not bounced[-1]:
            state.update((int(ts[-1]), int(p["seq"].iloc[-1]), p["record"].iloc[-1]))
            state.setTimeoutTimestamp(due)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"record": p["record"].to_numpy()[bounced], "ts": ts[bounced]})

    return df.groupBy("mid").applyInPandasWithState(
        fn, "record string, ts long", "ts long, seq long, record string", "append",
        GroupStateTimeout.EventTimeTimeout)


# ------------------------------------------------- T2 / T4 / T8 first per day --
def first_per_day(df: DataFrame, keys: list[str], keep_days: int = 2) -> DataFrame:
    """The first row to arrive of every (keys, day): input rows with ``ts``
    (ms), output the same columns.  JVM-side: duplicates are dropped on the
    keys and the day, with the day as watermarked event time, so a late row
    of an earlier day still counts, and a day's state is dropped once days
    ``keep_days`` later have come (rows later than that are too late)."""
    day = F.date_trunc("day", F.timestamp_millis("ts"))
    return (df.withColumn("_day", day).withWatermark("_day", f"{keep_days} days")
            .dropDuplicates([*keys, "_day"]).drop("_day"))


# -------------------------------------------------- T5-T7 days of a user --
Table = dict[int, int]  # day -> time of its first row (ms)


def _epoch_days(ms: pd.Series, tz: str) -> pd.Series:
    return (pd.to_datetime(_dates(ms, tz)) - pd.Timestamp(0)).dt.days


def _by_day(df: DataFrame, key: str, flags: Callable[[int | None, int | None, Table], dict[int, tuple[int, int]]],
            names: tuple[str, str], keep_days: int, tz: str, every_row: bool) -> DataFrame:
    """Flags that depend on a user's days, right in whatever order rows come.

    State: the first time of each recent day, the first time ever and the
    last day that has left.  ``flags`` gives what a user's days contribute
    at which times; a row that comes late changes that, and the difference
    is emitted, taken back where it no longer holds (-1), so the sums per
    window are those of the batch form.  A day leaves the state once the
    watermark, ``keep_days`` behind, is past it: later rows of it are too
    late and dropped.  The first time ever stays.  ``every_row`` also emits
    a row of zeros for each input row."""
    out = f"ts long, {names[0]} long, {names[1]} long"

    def fn(key, pdfs, state: GroupState):
        ever, left, days, times = state.get if state.exists else (None, None, [], [])
        table = dict(zip(days, times))
        zeros = []
        if not state.hasTimedOut:
            before = flags(ever, left, table)
            for p in pdfs:
                if not len(p):
                    continue
                if every_row:
                    zeros.append(p["ts"].astype("int64"))
                for day, ts in p["ts"].groupby(_epoch_days(p["ts"], tz)).min().items():
                    table[int(day)] = min(int(ts), table.get(int(day), int(ts)))
                    ever = int(ts) if ever is None else min(ever, int(ts))
            after = flags(ever, left, table)
            none = (0, 0)
            change = {t: tuple(x - y for x, y in zip(after.get(t, none), before.get(t, none))) for t in after.keys() | before.keys()}
            moved = [(t, *c) for t, c in change.items() if any(c)] + [(int(t), 0, 0) for z in zeros for t in z]
            yield pd.DataFrame(moved, columns=["ts", *names]).astype("int64")
        now = state.getCurrentWatermarkMs()
        if now > 0:
            past = int(_epoch_days(pd.Series([now]), tz)[0])
            gone = [d for d in table if d < past]
            left = max([*gone, *([left] if left is not None else [])], default=None)
            table = {d: t for d, t in table.items() if d >= past}
        state.update((ever, left, sorted(table), [table[d] for d in sorted(table)]))
        if table:  # look again when the watermark has passed its first day
            state.setTimeoutTimestamp(max((min(table) + 2) * 86_400_000, now + 1))

    rows = df.withColumn("row_time", F.timestamp_millis("ts")).withWatermark("row_time", f"{keep_days} days")
    return rows.select(key, "ts", "row_time").groupBy(key).applyInPandasWithState(
        fn, out, "ever long, left int, days array<int>, times array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def login_flags(df: DataFrame, back_days: int = 8, tz: str = "UTC", keep_days: int = 2) -> DataFrame:
    """T5 stream: input ``uid, ts``; output ``ts, uu_ct, back_ct``: the first
    login of a day, returning if the login day before is ``back_days`` or
    more ago (see :func:`_by_day` for rows out of order)."""
    def flags(ever: int | None, left: int | None, table: Table) -> dict[int, tuple[int, int]]:
        found, before = {}, left
        for day in sorted(table):
            found[table[day]] = (1, int(before is not None and day - before >= back_days))
            before = day
        return found

    return _by_day(df, "uid", flags, ("uu_ct", "back_ct"), keep_days, tz, every_row=False)


def unique_new_flags(df: DataFrame, tz: str = "UTC", keep_days: int = 2) -> DataFrame:
    """T6 / T7 stream: input ``user_id, ts``; output ``ts, uu, new``: the
    first row of a day, new if it is the user's first ever, and a row of
    zeros for each input row (see :func:`_by_day`)."""
    def flags(ever: int | None, left: int | None, table: Table) -> dict[int, tuple[int, int]]:
        return {ts: (1, int(ts == ever)) for ts in table.values()}

    return _by_day(df, "user_id", flags, ("uu", "new"), keep_days, tz, every_row=True)
