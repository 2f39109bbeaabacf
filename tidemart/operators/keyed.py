"""Skew-safe per-key selection: first / latest row of a group.

A window function partitioned by a key sends the whole group to one task;
with a hot key (a bot device, a giant order) that task holds a third of the
data.  Selecting the first or latest row is an aggregate instead: ``min`` /
``max`` of a struct whose leading fields are the ordering keys.  Spark runs
it as partial (map-side) + final aggregation, so a hot key is pre-reduced
in every map task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(order: Sequence[Column | str]) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}")
                      for i, c in enumerate(order)])


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each ``keys`` group by ascending ``order``
    (``min_by``; the order keys should be unique within a group)."""
    return (df.groupBy(*keys).agg(F.min_by(_row(df), _order(order)).alias("_m"))
            .select("_m.*"))


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each ``keys`` group by ascending ``order``.
    The keys come from the grouping, so the result stays partitioned by them."""
    rest = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in keys])
    return (df.groupBy(*keys).agg(F.max_by(_row(rest), _order(order)).alias("_m"))
            .select(*[F.col(f"`{c}`") if c in keys else F.col(f"_m.`{c}`") for c in df.columns]))
