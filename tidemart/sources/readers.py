"""Sources S1-S6 for batch and Structured Streaming.

A topic is a DataFrame of ``value`` strings.  Kafka is a format option
(``format='kafka'`` needs the Kafka connector on the classpath); files
(text / json lines / parquet with a ``value`` column) are the tested
sources.  In a stream, group offsets are the query checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import second_row_time

S = T.StringType()
MAP_SS = T.MapType(S, S)

# The change-record envelope.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("database", S), T.StructField("table", S), T.StructField("type", S),
    T.StructField("data", MAP_SS), T.StructField("old", MAP_SS), T.StructField("ts", S)])

# The page-log record as the metric jobs read it.
PAGE_LOG_SCHEMA = T.StructType([T.StructField("common", MAP_SS), T.StructField("page", MAP_SS),
                                T.StructField("ts", T.LongType())])

# S3: what columns of detail topics are other than text.
DETAIL_TYPES = {"row_op_ts": T.TimestampType(), "arrival": T.LongType(), "old": MAP_SS}

# The flat page rows of the unique-visitor and bounce topics.
FLAT_PAGE_SCHEMA = T.StructType(
    [T.StructField(c, S) for c in
     ("mid", "uid", "vc", "ch", "ar", "is_new", "page_id", "last_page_id", "item", "item_type")]
    + [T.StructField("during_time", T.LongType()), T.StructField("ts", T.LongType()),
       T.StructField("seq", T.LongType())])


def _with_line_order(lines: DataFrame, stream: bool) -> DataFrame:
    """``value`` and ``seq``, the order of text lines: the file's time in ms,
    shifted, plus the line's place in the file, so a file keeps its lines'
    order whatever its size (one of n bytes reaches n / 2^20 ms into the next).

    The place is where the line's split begins plus the number of rows its
    task read before.  A split that isn't its file's last has the full size
    and so stands first in its task, with at most one row a byte: its places
    end before the next split of the file begins.  Streams don't have Spark's
    row numbers, so there the rows of a task are counted in Arrow batches."""
    start = F.shiftleft(F.unix_millis(F.col("_metadata.file_modification_time")), 20) + F.col("_metadata.file_block_start")
    if not stream:
        before = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        return lines.select("value", (start + before).alias("seq"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for b in batches:
            places = b.column("seq").to_numpy() + np.arange(before, before + len(b))
            before += len(b)
            yield pa.RecordBatch.from_arrays([b.column("value"), pa.array(places)], names=["value", "seq"])

    return lines.select("value", start.alias("seq")).mapInArrow(count, "value string, seq long")


def read_topic(spark: SparkSession, source: str, fmt: str = "text", stream: bool = False,
               options: dict | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A raw topic as ``value`` strings (null payloads stay null) with the
    arrival order in ``seq``.

    ``fmt``: ``kafka`` (``source`` = topic, options carry the brokers; ``seq``
    is the offset), ``text`` (one record per line; files by their time, lines
    by their place in the file, see :func:`_with_line_order`; the folders of
    :func:`.sinks.publish_batch` are read too), ``parquet`` / ``json`` (``schema`` given, ``value``
    column; ``seq`` is taken as it is).  ``stream=True`` returns a streaming
    DataFrame."""
    opts = dict(options or {})
    r = spark.readStream if stream else spark.read
    if fmt == "kafka":
        opts.setdefault("subscribe", source)
        opts.setdefault("startingOffsets", "earliest" if not stream else "latest")
        df = r.format("kafka").options(**opts).load()
        return df.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))
    if fmt == "text":
        opts.setdefault("recursiveFileLookup", "true")
        if stream:  # the job that writes the topic may start later
            p = spark._jvm.org.apache.hadoop.fs.Path(source)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
        df = r.options(**opts).text(source)
        return _with_line_order(df, stream)
    reader = r.format(fmt).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source)


def cdc_flagged(topic: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines with the parsed change record ``_r``, the line ``_v`` and whether
    it is ``_bad``: unparsable, or without a table name.  One parse a line."""
    sch = T.StructType(ENVELOPE_SCHEMA.fields + [T.StructField("_corrupt_record", S)])
    j = F.from_json(F.col(value_col), sch,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    order = ["seq"] if "seq" in topic.columns else []
    parsed = topic.select(F.inline(F.array(F.struct(j.alias("_r"), F.col(value_col).alias("_v"), *order))))
    return parsed.withColumn("_bad", F.col("_r").isNull() | F.col("_r._corrupt_record").isNotNull() | F.col("_r.table").isNull())


def cdc_split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``cdc_flagged`` rows to (records, dirty lines)."""
    order = ["seq"] if "seq" in flagged.columns else []
    records = flagged.filter(~F.col("_bad")).select(*[F.col(f"_r.{f.name}").alias(f.name)
                                                      for f in ENVELOPE_SCHEMA.fields], *order)
    return records, flagged.filter(F.col("_bad")).select(F.col("_v").alias("line"))


def cdc_records(topic: DataFrame, value_col: str = "value", with_dirty: bool = False):
    """JSON change records to the envelope (map values arrive as text).

    With ``with_dirty`` returns ``(records, dirty_lines)``: lines that do not
    parse or carry no table name go to their own output (Q11: uniform dirty
    routing instead of failing the job).  A ``seq`` of the topic stays."""
    if with_dirty:
        return cdc_split(cdc_flagged(topic, value_col))
    order = ["seq"] if "seq" in topic.columns else []
    return topic.select(F.from_json(F.col(value_col), ENVELOPE_SCHEMA).alias("r"), *order).select("r.*", *order)


def typed_records(topic: DataFrame, columns: list[str], value_col: str = "value") -> DataFrame:
    """S3: a detail topic with declared columns: text, but for those that
    ``DETAIL_TYPES`` types (orders compare as numbers and times)."""
    sch = T.StructType([T.StructField(c, DETAIL_TYPES.get(c, S)) for c in columns])
    return topic.select(F.from_json(F.col(value_col), sch).alias("r")).select("r.*")


def flat_page_records(topic: DataFrame, value_col: str = "value") -> DataFrame:
    """S3: the flat page rows that the unique-visitor and bounce jobs write."""
    return topic.select(F.from_json(F.col(value_col), FLAT_PAGE_SCHEMA).alias("r")).select("r.*")


def page_log_records(topic: DataFrame, value_col: str = "value",
                     watermark_seconds: int | None = None) -> DataFrame:
    """Page-log records with ``row_time`` (event time cut to the
    second) and an optional watermark.  Records keep the arrival order that
    the log split gave them (``seq``); others take the topic's."""
    order = [F.coalesce("r.seq", "seq").alias("seq")] if "seq" in topic.columns else ["r.seq"]
    sch = T.StructType([*PAGE_LOG_SCHEMA.fields, T.StructField("seq", T.LongType())])
    df = (topic.select(F.from_json(F.col(value_col), sch).alias("r"), *[c for c in topic.columns if c == "seq"])
          .select("r.common", "r.page", "r.ts", *order)
          .withColumn("row_time", second_row_time("ts")))
    if watermark_seconds is not None:
        df = df.withWatermark("row_time", f"{watermark_seconds} seconds")
    return df


def read_dictionary(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
                    options: dict | None = None) -> DataFrame:
    """The ``base_dic`` dictionary, static side of lookup joins.  JDBC
    (``fmt='jdbc'``, options url/dbtable/user/password) or files."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**(options or {})).load()
    return spark.read.format(fmt).options(**(options or {})).load(path)
