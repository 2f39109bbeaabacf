"""Behaviour-log parsing and routing.

One pass parses every line; dirty lines (unparsable, or no device id) go
to their own output.  The clean records are routed by content: error
records, start records, display and action elements (exploded), and page
records without the arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
MAP_SS = T.MapType(S, S)

# ``common`` and ``page`` are maps: every field of the line travels on, known
# or not; values are text.
LOG_SCHEMA = T.StructType([
    T.StructField("common", MAP_SS), T.StructField("page", MAP_SS),
    T.StructField("start", MAP_SS), T.StructField("displays", T.ArrayType(MAP_SS)),
    T.StructField("actions", T.ArrayType(MAP_SS)), T.StructField("err", MAP_SS),
    T.StructField("ts", T.LongType()), T.StructField("_corrupt_record", S),
])


def flagged(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw lines with the parsed record ``_j`` and whether they are ``_dirty``
    (unparsable, or without a device id).  Other columns are kept.

    The parse and the dirty flag are produced by one generator row per line
    (``inline`` of a one-element array): predicates on its output cannot be
    pushed below it, so each line is parsed exactly once instead of once per
    predicate that reads the parsed struct."""
    keep = [c for c in raw.columns if c != value_col]
    j = F.from_json(F.col(value_col), LOG_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = raw.select(F.inline(F.array(F.struct(j.alias("_j"), F.col(value_col).alias(value_col),
                                                  *[F.col(c) for c in keep]))))
    return parsed.withColumn("_dirty", F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull() | F.col("_j.common.mid").isNull())


def parse(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split raw lines into (clean records, dirty lines).  Other columns of
    ``raw`` (e.g. an arrival ``seq``) are kept on clean records."""
    keep = [c for c in raw.columns if c != value_col]
    rows = flagged(raw, value_col)
    clean = (rows.filter(~F.col("_dirty"))
             .select(*[F.col(f"_j.{f.name}").alias(f.name) for f in LOG_SCHEMA.fields
                       if f.name != "_corrupt_record"], *keep))
    dirty = rows.filter(F.col("_dirty")).select(F.col(value_col).alias("line"))
    return clean, dirty


def route(clean: DataFrame) -> dict[str, DataFrame]:
    """Route clean records.  Error records keep everything; the other routes
    see the record without ``err``.  Display rows keep the record ``ts``;
    action rows do not (as in the reference)."""
    error = clean.filter(F.col("err").isNotNull())
    rest = clean.drop("err")
    start = rest.filter(F.col("start").isNotNull()).drop("displays", "actions")
    body = rest.filter(F.col("start").isNull())
    display = body.select(F.explode("displays").alias("display"), "common", "page", "ts")
    action = body.select(F.explode("actions").alias("action"), "common", "page")
    page = body.drop("displays", "actions", "start")
    return {"page": page, "start": start, "display": display, "action": action, "error": error}
