"""Typed dimension tables that a stream fills.

Every configured dimension is a table of its own: the configured columns as
text, in buckets of its key (``SALT_BUCKETS`` of its suffix gives their
number), folded like any table of a stream.  A column that the configuration
adds while the job runs joins the table; rows from before have null there.  A
column it drops stays, with what it held.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import dims as dimops
from ..sources import sinks
from . import jobs, runtime

#: How a change is ordered and told apart beside the configured columns.
CHANGE = ["_ts", "_type"]


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def definition(spark: SparkSession, path: str) -> dict | None:
    """Key, columns and buckets of a table, or None if there is none."""
    return sinks.newest_json(spark, f"{path}/_columns")


def evolve(spark: SparkSession, path: str, key: str, columns: list[str], extend: str = "") -> dict:
    """The table's definition with ``columns`` in it; created if it isn't
    there (K6), grown by one step if the configuration has new columns."""
    known = definition(spark, path)
    salt = re.search(r"SALT_BUCKETS\s*=\s*(\d+)", extend, re.I)
    new = {"version": 0, "key": key, "columns": [], "buckets": int(salt.group(1)) if salt else 16} if known is None else dict(known)
    more = [c for c in dict.fromkeys([new["key"], *columns]) if c not in new["columns"]]
    if known is None or more:
        new |= {"version": 0 if known is None else known["version"] + 1, "columns": [*new["columns"], *more]}
        sinks.add_json(spark, f"{path}/_columns", new["version"], new)
    return new


def _schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns]
                        + [T.StructField("_ts", T.LongType()), T.StructField("_type", T.StringType()), T.StructField("batch_id", T.LongType())])


def dim_tables(cdc: DataFrame, config: jobs.Lookup, root: str, name: str = "dim_tables") -> StreamingQuery:
    """Change records into the typed tables of the configuration as it is at
    the micro-batch.  The batch is read once; a table is written when the
    batch has rows for it."""
    return jobs.start(cdc, name, writer(config, root))


def writer(config: jobs.Lookup, root: str) -> Callable[[DataFrame, int], None]:
    every = runtime.current().fold_every

    def write(batch: DataFrame, bid: int) -> None:
        spark = batch.sparkSession
        conf = jobs.now(config)
        changes = dimops.dim_changes(batch, conf).persist()
        try:
            there = {r.sink_table for r in changes.select("sink_table").distinct().collect()}  # a row for each dimension at most
            for c in conf.collect():
                path = table_path(root, c.sink_table)
                table = evolve(spark, path, c.sink_pk, [x.strip() for x in c.sink_columns.split(",")], c.sink_extend)
                if c.sink_table in there:
                    own = changes.filter(F.col("sink_table") == c.sink_table).filter(F.col("id").isNotNull())
                    typed = own.select(*[F.col("data").getItem(x).alias(x) if x != table["key"] else F.col("id").alias(x) for x in table["columns"]],
                                       F.col("ts").alias("_ts"), F.col("type").alias("_type"))
                    sinks.write_append(typed, path, "parquet", batch_id=bid)
                if every and (bid + 1) % every == 0:
                    sinks.fold(spark, path, [table["key"]], ["_ts"], buckets=table["buckets"], schema=_schema(table["columns"]))
        finally:
            changes.unpersist()

    return write


def exists(spark: SparkSession, root: str, table: str) -> bool:
    return sinks.exists(spark, f"{table_path(root, table)}/_columns")


def read_dim(spark: SparkSession, root: str, table: str, apply_deletes: bool = False) -> DataFrame:
    """A typed dimension table as it is now: the latest row of every key by
    change time, ties by the later batch; a deleted row with its last image
    unless ``apply_deletes``.  A table without rows has its columns."""
    path = table_path(root, table)
    d = definition(spark, path)
    schema = _schema(d["columns"])
    if not sinks.children(spark, path, "batch_id=") and not sinks.exists(spark, f"{path}/_manifest"):
        rows = spark.createDataFrame([], schema)
    else:
        rows = sinks.merged(sinks.read_changes(spark, path, schema), [d["key"]], ["_ts"])
    if apply_deletes:
        rows = rows.filter(F.col("_type") != "delete")
    return rows.select(*d["columns"])
