"""Visit-level state operators T1-T8, batch forms.

Each reference operator keeps a per-key ``ValueState`` (a date) and decides
per record.  Over a bounded table the same decisions follow from first rows
per (key, day) and, where a previous day is needed, from a window over the
already-reduced daily rows (at most one row per key per day, so bounded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import ms_to_date
from .keyed import first_rows

ORDER = ("ts", "seq")


def repair_new_flag(df: DataFrame, mid: str = "mid", is_new: str = "is_new") -> DataFrame:
    """Repair the new-visitor flag.

    The first record of a device fixes its first-visit date: its own date if
    it claims to be new, else the day before.  A record stays new only if it
    claims so and falls on that date.  ``df`` is flat with ``ts`` (ms) and
    ``seq``; the per-device first record is an aggregate, joined back (AQE
    splits a skewed device across tasks)."""
    d = df.withColumn("_dt", F.to_date(ms_to_date("ts")))
    first = (first_rows(d.select(mid, is_new, "_dt", *ORDER), [mid], ORDER)
             .select(F.col(mid).alias("_fmid"),
                     F.when(F.col(is_new) == "1", F.col("_dt"))
                      .otherwise(F.date_sub(F.col("_dt"), 1)).alias("_first_dt")))
    out = d.join(first, d[mid] == first["_fmid"], "left")
    stale = (F.col(is_new) == "1") & (F.col("_dt") != F.col("_first_dt"))
    fixed = F.when(stale, "0").otherwise(F.col(is_new))  # any other flag stays as it is
    return out.withColumn(is_new, fixed).drop("_dt", "_fmid", "_first_dt")


def first_visit_per_day(df: DataFrame, key: str, extra_keys=()) -> DataFrame:
    """The first row per (key, extra keys, day)."""
    d = df.withColumn("_day", ms_to_date("ts"))
    return first_rows(d, [key, *extra_keys, "_day"], ORDER).drop("_day")


def daily_first_with_history(df: DataFrame, key: str) -> DataFrame:
    """First activity time per (key, day) with ``_day``, ``_prev_day`` (the
    key's previous active day) and ``_is_first_ever``.  Used by T5-T7.

    Only the first time of each day matters, so this is a plain ``min`` (hash
    aggregate with map-side combine); the window then runs over daily rows
    only: at most one row per key per day."""
    d = df.withColumn("_day", F.to_date(ms_to_date("ts")))
    daily = d.groupBy(key, "_day").agg(F.min("ts").alias("ts"))
    w = Window.partitionBy(key).orderBy("_day")
    return (daily.withColumn("_prev_day", F.lag("_day").over(w))
            .withColumn("_is_first_ever", F.col("_prev_day").isNull()))


def first_time_per_day(df: DataFrame, keys) -> DataFrame:
    """T4 / T8 when only the time of the first visit matters: ``min(ts)`` per
    (keys, day)."""
    d = df.withColumn("_day", ms_to_date("ts"))
    return d.groupBy(*keys, "_day").agg(F.min("ts").alias("ts")).drop("_day")


def login_flags(logins: DataFrame, uid: str = "uid", back_days: int = 8) -> DataFrame:
    """T5: one row per (user, day) first login with ``uu_ct`` = 1 and
    ``back_ct`` = 1 when the previous login day is ``back_days`` or more
    before."""
    d = daily_first_with_history(logins, uid)
    back = (F.col("_prev_day").isNotNull()
            & (F.datediff(F.col("_day"), F.col("_prev_day")) >= back_days))
    return (d.withColumn("back_ct", back.cast("bigint"))
            .withColumn("uu_ct", F.lit(1).cast("bigint"))
            .drop("_day", "_prev_day", "_is_first_ever"))


def bounce_entries(df: DataFrame, within_ms: int, key: str = "mid",
                   bucket_ms: int | None = None) -> DataFrame:
    """Entry rows (``last_page_id`` null) not followed, within
    ``within_ms``, by a non-entry row of the same device.

    An entry bounces when the device's next row is missing, is ``within_ms``
    or more later, or is itself an entry.  "Next row" is a lead over
    (device, time bucket), so a hot device is spread over its buckets.  The
    rows in the first ``within_ms`` of a bucket are copied to the bucket
    before as markers: whatever lies later than those is too late to matter,
    so one window (one exchange, no join) decides; markers are dropped.

    Bucket width trades the largest window task against the share of rows
    copied: the default, max(horizon, 1 minute), caps a device that emits a
    third of all rows at one minute of its rows per task."""
    bucket_ms = max(int(bucket_ms or 60_000), int(within_ms))
    own = F.floor(F.col("ts") / bucket_ms)
    marks = F.when(F.col("ts") - own * bucket_ms < within_ms, F.array(own, own - 1)).otherwise(F.array(own))
    w = Window.partitionBy(key, "_b").orderBy(*ORDER)
    d = (df.withColumn("_entry", F.col("last_page_id").isNull()).withColumn("_b", F.explode(marks))
         .withColumn("_nts", F.lead("ts").over(w)).withColumn("_nentry", F.lead("_entry").over(w)))
    bounced = F.col("_nts").isNull() | ((F.col("_nts") - F.col("ts")) >= within_ms) | F.col("_nentry")
    return (d.filter(F.col("_entry") & F.col("_b").eqNullSafe(own) & bounced)
            .drop("_b", "_entry", "_nts", "_nentry"))
