"""Reading the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Session setting: spread the rows of the tables in ``SPREAD`` over so many
#: partitions after the scan.  Unset (the default) the file layout decides.
SCAN_PARTITIONS = "spark.tidemart.scan.partitions"
SPREAD = ("events", "lineitem", "orders")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet``: Catalyst prunes columns and pushes filters into
    the scan.  A fact table stored as one file is read by one task; a run on
    such files sets ``SCAN_PARTITIONS``, at the cost of one exchange."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    spread = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(spread)) if spread and name in SPREAD else df
