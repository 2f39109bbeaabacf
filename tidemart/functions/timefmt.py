"""Time conversions and window labels (S4, W2, §2.9 scalars)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import FMT_DATE, FMT_DATETIME, FMT_PARTITION


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds (behaviour log ``ts``) to a timestamp."""
    return F.timestamp_millis(_c(ms))


def sec_to_ts(sec) -> Column:
    """Epoch seconds as string/long (CDC ``ts``) to a timestamp."""
    return F.timestamp_seconds(_c(sec).cast("bigint"))


def sec_to_ms(sec) -> Column:
    return _c(sec).cast("bigint") * F.lit(1000)


def ms_to_date(ms) -> Column:
    """``yyyy-MM-dd`` of an epoch-ms value in the session time zone."""
    return F.date_format(ms_to_ts(ms), FMT_DATE)


def second_row_time(ms) -> Column:
    """``TO_TIMESTAMP(FROM_UNIXTIME(ts/1000))``: event time cut to the second."""
    return F.date_trunc("second", ms_to_ts(ms))


def text_date(text) -> Column:
    """``date_format(string, 'yyyy-MM-dd')`` on a datetime string."""
    return F.date_format(F.try_to_timestamp(_c(text)), FMT_DATE)


def window_labels(window_col: str = "window") -> list[Column]:
    """stt / edt / cur_date labels of a tumbling window struct."""
    w = F.col(window_col)
    return [
        F.date_format(w.start, FMT_DATETIME).alias("stt"),
        F.date_format(w.end, FMT_DATETIME).alias("edt"),
        F.date_format(w.start, FMT_PARTITION).alias("cur_date"),
    ]
