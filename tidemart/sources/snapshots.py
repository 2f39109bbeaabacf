"""Small tables that change while streams read them: dictionary, dimensions,
configuration.

A table's folder holds complete versions side by side; a reader takes the
newest complete one, so replacing the table never takes files away from a
micro-batch that reads it.  A plain Parquet folder is read as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import sinks


def publish(df: DataFrame, path: str, keep: int = 3) -> int:
    """Write the next version of a table; returns its number.  All but the
    newest ``keep`` versions are removed.  One writer at a time."""
    spark, path = df.sparkSession, path.rstrip("/")
    versions = sinks.children(spark, path, "v=")
    n = max(versions, default=-1) + 1
    df.write.parquet(f"{path}/v={n}")
    for old, p in versions.items():
        if old <= n - keep:
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return n


def read(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version, or the plain folder."""
    path = path.rstrip("/")
    done = [n for n, p in sinks.children(spark, path, "v=").items() if sinks.exists(spark, f"{p}/_SUCCESS")]
    return spark.read.parquet(f"{path}/v={max(done)}" if done else path)
