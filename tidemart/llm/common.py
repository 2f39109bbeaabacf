"""Helpers the operators share: reading tables, stored tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: The white-space characters of the contracts: space and TAB .. CR.
SPACES = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: later steps read files every executor sees, so a lost
    executor costs a re-read, and row ids made before the write stay fixed."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Arrow batches of ``size`` for the actions inside.  By default a batch
    holds 10,000 whole texts, up to 64 MB, several times over: in the JVM's
    buffers, on its way, and as Python objects, for every core."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored_by_split(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with its split number ``pid`` and row ids ``rid``.

    The table is bucketed by ``pid``, which is constant in each writing task,
    so nothing is shuffled to write it, and a later cogroup by ``pid`` moves
    only the other side: one split's rows meet what was found out about them.
    The table leaves the catalogue at once; its files stay."""
    spark = df.sparkSession
    unique = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (df.select(F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("rid"), "*")
       .write.format("parquet").option("compression", "zstd")
       .option("path", f"{checkpoint_root(spark).rstrip('/')}/llm/{unique}")
       .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "pid").saveAsTable(unique))
    out = spark.table(unique)
    spark.sql(f"DROP TABLE {unique}")
    return out


def without_spaces(c: Column) -> Column:
    """``c`` without any of ``SPACES``."""
    for s in SPACES:
        c = F.replace(c, F.lit(s), F.lit(""))
    return c


def sorted_names(keys: DataFrame, cols: list[str], out: str, label: str) -> DataFrame:
    """Order-preserving integer names, column ``out``, of distinct keys.

    The rows are range-partitioned and sorted by ``cols``, so the running id
    (partition number, then row) grows in key order.  Stored, since the ids
    belong to this one sort.  ``keys`` must hold each key once."""
    return stored(keys.orderBy(*cols).withColumn(out, F.monotonically_increasing_id()), label)


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, component): the smallest node reachable.

    Alternating large-star and small-star rounds: a round points every
    neighbour at the smallest node around it, until nothing changes.  Each
    round is two aggregations and joins on the node, stored in between; a hub
    with very many neighbours is only ever aggregated or joined, never
    gathered.  No edges give no rows; self edges name single nodes."""
    def state(e: DataFrame) -> tuple:
        # The sum wraps nowhere: each hash is cut to 32 bits first.
        return tuple(e.agg(F.count("*"), F.sum(F.shiftrightunsigned(F.xxhash64("a", "b"), 32)).cast("string")).first())

    def toward_minimum(pairs: DataFrame) -> DataFrame:
        """For rows (u, v): the smallest of u and its v's, beside each v."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m0")).select(
            "u", F.least("u", "m0").alias("m"))
        return pairs.join(least, "u")

    own = stored(edges.select("a", "b").distinct(), "edges")
    nodes = own.select(F.col("a").alias("node")).union(own.select("b")).distinct()
    cur, before = own.filter("a <> b"), None
    while (now := state(cur))[0] and now != before:
        before = now
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).union(cur.select("b", "a"))
        large = (toward_minimum(both).filter("v > u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        small = toward_minimum(down)
        cur = stored(small.select(F.col("v").alias("a"), F.col("m").alias("b"))
                     .union(small.select("u", "m")).filter("a <> b").distinct(), "stars")
    root = cur.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return nodes.join(root, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))
