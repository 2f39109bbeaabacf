"""Configuration-driven dimension tables.

The configuration says which change-record tables are dimensions, their
target table, columns, key and DDL suffix.  Records of configured tables
are whitelisted to the configured columns and folded to the latest row per
key; the upsert store is the result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cdc import not_bootstrap
from .keyed import latest_rows


def fold_config(changes: DataFrame) -> DataFrame:
    """A snapshot-then-changes config table folded to its current state:
    the latest row per source table, removed if that row is a delete."""
    latest = latest_rows(changes, ["source_table"], ["ts"])
    return (latest.filter(F.col("op") != "d")
            .select("source_table", "sink_table", "sink_columns",
                    F.coalesce(F.col("sink_pk"), F.lit("id")).alias("sink_pk"),
                    F.coalesce(F.col("sink_extend"), F.lit("")).alias("sink_extend")))


def dim_changes(envelope: DataFrame, config: DataFrame) -> DataFrame:
    """Whitelisted change rows: ``sink_table, id, data, type, ts``.

    J12 inner-joins records to the config (one row per table); P7 keeps only
    configured columns by exact name."""
    rows = envelope.filter(not_bootstrap())
    joined = rows.join(config, rows["table"] == config["source_table"], "inner")
    cols = F.transform(F.split(F.col("sink_columns"), ","), lambda c: F.trim(c))
    white = F.map_filter(F.col("data"), lambda k, v: F.array_contains(cols, k))
    return joined.select(
        "sink_table", F.element_at(F.col("data"), F.col("sink_pk")).alias("id"),
        white.alias("data"), F.col("type"), F.col("ts").cast("bigint").alias("ts"))


def current_dims(changes: DataFrame, apply_deletes: bool = False, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """The latest change per (sink table, pk) by ``order``.  Deletes are
    upserted with their last image unless ``apply_deletes``, which removes
    the key when its latest change is a delete (so the delete has to be
    stored like any other change)."""
    latest = latest_rows(changes, ["sink_table", "id"], list(order))
    if apply_deletes:
        latest = latest.filter(F.col("type") != "delete")
    return latest.select("sink_table", "id", "data")


def dim_rows(envelope: DataFrame, config: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """Latest whitelisted row per (sink table, pk): ``sink_table, id, data``."""
    return current_dims(dim_changes(envelope, config), apply_deletes)


def dim_schema(sink_columns: str) -> T.StructType:
    """K6: every configured column is a string."""
    return T.StructType([T.StructField(c.strip(), T.StringType()) for c in sink_columns.split(",")])


def typed_dim(rows: DataFrame, sink_table: str, sink_columns: str) -> DataFrame:
    """One dimension table with its configured columns as string columns."""
    sch = dim_schema(sink_columns)
    return (rows.filter(F.col("sink_table") == sink_table)
            .select(*[F.col("data").getItem(f.name).alias(f.name) for f in sch.fields]))


def table_ddl(sink_table: str, sink_columns: str, sink_pk: str = "id", sink_extend: str = "", location: str | None = None) -> str:
    """K6: the statement that creates a configured dimension table: all
    columns text, clustered by the key; ``SALT_BUCKETS = n`` in the
    configured suffix gives the number of buckets."""
    cols = ", ".join(f"`{f.name}` STRING" for f in dim_schema(sink_columns).fields)
    salt = re.search(r"SALT_BUCKETS\s*=\s*(\d+)", sink_extend or "", re.I)
    buckets = f" CLUSTERED BY (`{sink_pk}`) INTO {int(salt.group(1))} BUCKETS" if salt else ""
    where = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS `{sink_table}` ({cols}) USING parquet{buckets}{where} COMMENT 'key {sink_pk}'"


def create_tables(spark: SparkSession, config: DataFrame, root: str | None = None) -> list[str]:
    """K6: create every configured dimension table that doesn't exist.  The
    config is one row per dimension table, so collecting it is bounded."""
    names = []
    for r in config.collect():
        spark.sql(table_ddl(r.sink_table, r.sink_columns, r.sink_pk, r.sink_extend, f"{root}/{r.sink_table}" if root else None))
        names.append(r.sink_table)
    return names
