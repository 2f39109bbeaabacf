"""Event-time tumbling windows (W1-W6) and the window aggregation shape
shared by every metric (A1-A7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import WINDOW_SECONDS
from ..functions.timefmt import ms_to_ts, window_labels


def with_event_time(df: DataFrame, ms_col: str = "ts", out: str = "row_time",
                    shift_seconds: int = 0, watermark_seconds: int | None = None) -> DataFrame:
    """Event time from epoch ms (S4), optionally shifted (W6) and
    watermarked (W3: 0 s monotonous, W4: bounded out-of-orderness, W5:
    allowed lateness folded into the delay)."""
    ms = F.col(ms_col) + F.lit(shift_seconds * 1000) if shift_seconds else F.col(ms_col)
    df = df.withColumn(out, ms_to_ts(ms))
    if watermark_seconds is not None:
        df = df.withWatermark(out, f"{watermark_seconds} seconds")
    return df


def tumbling_agg(df: DataFrame, aggs: dict[str, Column], keys: Sequence[str] = (),
                 time_col: str = "row_time", size_seconds: int = WINDOW_SECONDS) -> DataFrame:
    """``groupBy(window(time, size), keys).agg(...)`` + stt/edt/cur_date.

    Output columns: stt, edt, keys..., cur_date, aggregates.  Partial aggregation runs before
    the shuffle, so a global (unkeyed) window does not funnel raw rows into
    one task."""
    g = (df.groupBy(F.window(F.col(time_col), f"{size_seconds} seconds").alias("window"), *keys)
         .agg(*[c.alias(n) for n, c in aggs.items()]))
    stt, edt, cur = window_labels("window")
    names = list(aggs)
    return g.select(stt, edt, *keys, cur, *names)
