"""Session helpers: one place for the engine settings every job relies on."""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution re-plans joins from
# measured sizes (broadcast only when the runtime size is under the
# threshold), splits skewed join partitions and coalesces small shuffles.
# On a large shared cluster also set spark.sql.shuffle.partitions high
# (thousands) and spark.sql.adaptive.coalescePartitions.parallelismFirst=false
# so that AQE coalesces to the advisory partition size.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # A sort-merge join becomes a shuffled hash join (no sort) only when every
    # build-side partition is measured under this size at runtime.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  tz: str = "UTC", app_name: str = "tidemart",
                  extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  ``tz`` sets ``spark.sql.session.timeZone``;
    production runs use ``GMT+8``, tests and the SQL oracle use ``UTC``."""
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.sql.session.timeZone", tz)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers of a cluster, so that state
    functions can be imported there.  Local workers share the driver's path
    only if they start in it, so they get it too.  Sent once per session."""
    if spark.conf.get("spark.tidemart.shipped", None):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tidemart-py-"), "tidemart"), "zip",
                                  os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("spark.tidemart.shipped", "true")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; a
    run without it fails there, since the driver's own disk is no place for
    what executors read.  A local master gets a scratch folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir is not set (master {master}): name a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root
