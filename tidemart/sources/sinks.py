"""Sinks K1-K5 as batch writes and ``foreachBatch`` functions.

Upserts are merge-on-read: every micro-batch is written once into its own
``batch_id=N`` partition with dynamic partition overwrite, so a replayed
batch (after an executor or driver loss) rewrites the same files instead of
duplicating them; readers fold the change files to the latest row per key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyed import latest_rows


def to_json_value(df: DataFrame) -> DataFrame:
    """K1 payload: one JSON object per row in ``value``."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def write_append(df: DataFrame, path: str, fmt: str = "json", options: dict | None = None,
                 batch_id: int | None = None) -> None:
    """K1 (files): append rows; with ``batch_id`` the write is idempotent."""
    if batch_id is None:
        df.write.mode("append").format(fmt).options(**(options or {})).save(path)
        return
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
       .format(fmt).options(**(options or {})).save(path))


def write_kafka(df: DataFrame, topic: str, options: dict) -> None:
    """K1 (Kafka): needs the Kafka connector on the classpath."""
    to_json_value(df).write.format("kafka").option("topic", topic).options(**options).save()


def publish_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """K1 (files) between stream jobs: one micro-batch as JSON lines that
    appear in the topic folder all at once, and once only.

    The lines are written aside and moved by one rename; a replayed batch
    finds its folder there and leaves it, so a job reading the topic never
    sees half a batch or a line twice.  This needs a store whose folder
    rename is one step (HDFS, local and shared file systems); on others use
    Kafka.  Batches without rows leave nothing."""
    spark, path = df.sparkSession, path.rstrip("/")
    final, aside = f"{path}/batch-{batch_id:012d}", f"{path}/_staging/batch-{batch_id:012d}-{uuid.uuid4().hex}"
    if exists(spark, final):
        return
    to_json_value(df).write.text(aside)
    p = spark._jvm.org.apache.hadoop.fs.Path(aside)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getContentSummary(p).getLength() == 0:
        fs.delete(p, True)
    elif not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(final)) and not exists(spark, final):
        raise OSError(f"could not move {aside} to {final}")


def upsert_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """K2 / K4: record one micro-batch of changes for a keyed table."""
    write_append(df, path, fmt="parquet", batch_id=batch_id)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def children(spark: SparkSession, path: str, prefix: str) -> dict[int, object]:
    """Number -> Hadoop path of the folders ``prefix<number>`` in ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in (fs.listStatus(p) if fs.exists(p) else ()):
        name = status.getPath().getName()
        if name.startswith(prefix) and name[len(prefix):].isdigit():
            found[int(name[len(prefix):])] = status.getPath()
    return found


# ------------------------------------------------------- tables of streams --
# A stream's table is what its micro-batches wrote (``batch_id=N`` folders)
# and, for the older ones, folded rows in parts: the date a row belongs to, or
# a bucket of its key.  A manifest names the folder of every part and the last
# batch in it.  A fold reads and writes only the parts that its batches touch
# and then adds the next manifest by one rename, so readers see either all of
# it or nothing.

def newest_json(spark: SparkSession, folder: str) -> dict | None:
    """The newest of the numbered documents that :func:`add_json` wrote."""
    found = children(spark, folder, "n=")
    if not found:
        return None
    return json.loads(spark.read.text(found[max(found)].toString(), wholetext=True).first().value)


def add_json(spark: SparkSession, folder: str, number: int, document: dict) -> None:
    """Add a numbered document, in one step."""
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/n={number}")
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_{uuid.uuid4().hex}")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(aside)
    out.write(bytearray(json.dumps(document).encode()))
    out.close()
    if not fs.rename(aside, final):
        raise OSError(f"could not move {aside} to {final}")


def _batches(spark: SparkSession, path: str, numbers: Sequence[int], schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.option("basePath", path)
    df = (r if schema is None else r.schema(schema)).parquet(*[f"{path}/batch_id={n}" for n in numbers])
    return df.withColumn("batch_id", F.col("batch_id").cast("long"))


def _part_paths(path: str, manifest: dict, parts: Sequence[str]) -> list[str]:
    return [f"{path}/_folded/v={manifest['parts'][p]}/p={p}" for p in parts if p in manifest["parts"]]


def read_changes(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows a reader of a stream's table has to merge: the folded parts
    and the batches after them, with ``batch_id``.  ``schema`` is that of a
    table whose columns have grown; files without a column give null."""
    path = path.rstrip("/")
    m = newest_json(spark, f"{path}/_manifest")
    if m is None:
        r = spark.read if schema is None else spark.read.schema(schema)
        return r.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))
    schema = schema or T.StructType.fromJson(m["schema"])
    base = spark.read.schema(schema).parquet(*_part_paths(path, m, list(m["parts"])))
    later = [n for n in children(spark, path, "batch_id=") if n > m["upto"]]
    return base.unionByName(_batches(spark, path, sorted(later), schema)) if later else base


def merged(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (), measures: Sequence[str] = ()) -> DataFrame:
    """One row per key: the sums of ``measures``, or without them the latest
    row by ``order``, ties and tables without an order by the later batch."""
    if not measures:
        return latest_rows(rows, list(keys), [*order, "batch_id"])
    types = dict(rows.dtypes)
    return rows.groupBy(*keys).agg(*[F.sum(m).cast(types[m]).alias(m) for m in measures], F.max("batch_id").alias("batch_id")).select(*rows.columns)


def read_upserted(spark: SparkSession, path: str, keys: Sequence[str],
                  order: Sequence[str | Column] = ()) -> DataFrame:
    """The current state of a keyed table (the rule the batch form uses)."""
    return merged(read_changes(spark, path), keys, order).drop("batch_id")


def read_sums(spark: SparkSession, path: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """An additive table: the sums per key over all its batches."""
    return merged(read_changes(spark, path), keys, measures=measures).drop("batch_id")


def fold(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str | Column] = (), measures: Sequence[str] = (),
         part: str | None = None, buckets: int = 16, files: int = 4, drop_folded: bool = False,
         schema: T.StructType | None = None) -> int:
    """Fold the batches of a stream's table into its parts; returns the last
    batch in them (-1: there is none).

    ``part`` is the column that tells a row's part, such as the date; without
    it rows are dealt over ``buckets`` by the hash of their key (the first
    fold's number stays).  Only parts that new batches touch are read and
    written, each as ``files`` files at most.  A batch that is replayed
    after it was folded changes nothing.  The folders that the newest two
    manifests don't need are removed, so a reader that began before a fold
    keeps its files until the fold after it; ``drop_folded`` removes all
    folded batches at once, for when no reader works.  ``schema``: see
    :func:`read_changes`.  One writer at a time."""
    path = path.rstrip("/")
    m = newest_json(spark, f"{path}/_manifest")
    later = sorted(n for n in children(spark, path, "batch_id=") if m is None or n > m["upto"])
    if later:
        new = _batches(spark, path, later, schema or (T.StructType.fromJson(m["schema"]) if m else None))
        buckets = m["buckets"] if m else buckets
        at = F.coalesce(F.col(part).cast("string"), F.lit("none")) if part else F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")
        touched = sorted(r.p for r in new.select(at.alias("p")).distinct().collect())  # dates or buckets
        base = _part_paths(path, m, touched) if m else []
        rows = spark.read.schema(new.schema).parquet(*base).unionByName(new) if base else new
        version = m["version"] + 1 if m else 0
        (merged(rows, keys, order, measures).withColumn("p", at).repartition("p", F.pmod(F.xxhash64(*keys), F.lit(files)))
         .write.mode("overwrite").partitionBy("p").parquet(f"{path}/_folded/v={version}"))
        before, m = m, {"version": version, "upto": later[-1], "buckets": buckets, "schema": json.loads(new.schema.json()),
                        "parts": {**(m["parts"] if m else {}), **{p: version for p in touched}}}
        add_json(spark, f"{path}/_manifest", version, m)
        _clean(spark, path, [x for x in (before, m) if x], before["upto"] if before else -1)
    if drop_folded and m:
        _clean(spark, path, [m], m["upto"])
    return m["upto"] if m else -1


def _clean(spark: SparkSession, path: str, manifests: Sequence[dict], upto: int) -> None:
    """Remove what these manifests don't need, and batches up to ``upto``."""
    used = {(v, p) for m in manifests for p, v in m["parts"].items()}
    gone = [p for n, p in children(spark, path, "batch_id=").items() if n <= upto]
    gone += [p for n, p in children(spark, f"{path}/_manifest", "n=").items() if n < min(m["version"] for m in manifests)]
    for v, folder in children(spark, f"{path}/_folded", "v=").items():
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        own = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("p=")]
        unused = [p for p in own if (v, p.getName()[2:]) not in used]
        gone += unused if len(unused) < len(own) else [folder]
    for p in gone:
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def compact(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str | Column] = (),
            drop_folded: bool = False) -> int:
    """Fold a keyed table by the buckets of its keys (see :func:`fold`)."""
    return fold(spark, path, keys, order, drop_folded=drop_folded)


def multi_route(batch: DataFrame, routes: Callable[[DataFrame], dict[str, DataFrame]],
                root: str, batch_id: int, fmt: str = "json") -> None:
    """K3: one pass over the batch, one idempotent write per route.  The
    batch is persisted so the routes share a single parse."""
    batch = batch.persist()
    try:
        for name, out in routes(batch).items():
            write_append(out, f"{root.rstrip('/')}/{name}", fmt=fmt, batch_id=batch_id)
    finally:
        batch.unpersist()


def clustered(df: DataFrame, partition_col: str, files_per_folder: int = 8) -> DataFrame:
    """Few files per folder, and a large folder split over several tasks: rows
    are dealt by the folder column and a salt.  No sampling pass."""
    return df.repartition(partition_col, F.pmod(F.xxhash64(*df.columns), F.lit(files_per_folder)))


def olap_write(df: DataFrame, path: str, columns: Sequence[str], partition_col: str = "cur_date",
               batch_id: int | None = None) -> None:
    """K5: positional sink columns (transient fields dropped), partitioned
    by the date field."""
    out = clustered(df.select(*columns), partition_col)
    if batch_id is None:
        out.write.mode("append").partitionBy(partition_col).parquet(path)
    else:
        (out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col, "batch_id")
            .parquet(path))
