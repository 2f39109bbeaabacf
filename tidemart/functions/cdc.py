"""Change-record helpers (S2, P2-P6): filters and map projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CDC_BOOTSTRAP_TYPES


def rows_of(envelope: DataFrame, table: str, types: Iterable[str] | None = None) -> DataFrame:
    """``table = T and type in (...)``.  On a parquet envelope partitioned by
    ``table`` this is partition pruning; on a union fixture Catalyst prunes
    the other branches."""
    cond = F.col("table") == F.lit(table)
    if types is not None:
        types = list(types)
        cond = cond & (F.col("type") == F.lit(types[0]) if len(types) == 1
                       else cond & F.col("type").isin(types))
    return envelope.filter(cond)


def data(key: str) -> Column:
    """``data['key']``."""
    return F.col("data").getItem(key)


def old(key: str) -> Column:
    """``old['key']``."""
    return F.col("old").getItem(key)


def changed(key: str) -> Column:
    """Changed-column predicate ``old['key'] is not null``."""
    return old(key).isNotNull()


def transition(key: str, before: str, after: str) -> Column:
    """State-transition predicate."""
    return (data(key) == F.lit(after)) & (old(key) == F.lit(before))


def increase_delta(key: str) -> tuple[Column, Column]:
    """Increase-only predicate and delta (P5): an insert contributes its
    value, an update only when the new value exceeds the old one."""
    new_v = F.expr(f"try_cast(data['{key}'] AS INT)")
    old_v = F.expr(f"try_cast(old['{key}'] AS INT)")
    is_insert = F.col("type") == "insert"
    keep = is_insert | ((F.col("type") == "update") & old(key).isNotNull() & (new_v > old_v))
    delta = F.when(is_insert, data(key)).otherwise((new_v - old_v).cast("string"))
    return keep, delta


def not_bootstrap() -> Column:
    """Drop bootstrap markers."""
    return ~F.col("type").isin(*CDC_BOOTSTRAP_TYPES)


def project(envelope_rows: DataFrame, keys: Iterable[str], extra: Iterable[Column] = ()) -> DataFrame:
    """Project ``data[k] AS k`` for each key, plus extra columns."""
    return envelope_rows.select(*[data(k).alias(k) for k in keys], *extra)
