"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored


def word_count(c: Column) -> Column:
    """Number of runs of characters other than space and TAB .. CR."""
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Sources in code-point order, null last, take the ``weights`` in turn and
    share ``share`` times all words; a target stops at ``most`` times its
    source and the excess is shared again by weight.  The sources whose cap
    per weight is smallest fill first, so the level all others reach follows
    from running sums over one row per source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    caps = sizes.withColumn("w", w).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    fill = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(W.unboundedPreceding, W.currentRow)
    every = W.partitionBy()
    ranked = (caps
              .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every))
              # If this source is the last one at its cap, the others get this level per weight.
              .withColumn("rest", F.col("budget") - F.coalesce(F.sum("cap").over(upto.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("rest_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(upto.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("level", F.col("rest") / F.col("rest_w")))
    # The first source that its level does not fill sets the level.
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"),
                         F.struct((F.col("cap") / F.col("w")).alias("at"), "level"))).over(every)["level"]
    filled = F.when(level.isNull(), F.col("cap")).otherwise(F.least(level * F.col("w"), F.col("cap")))
    return ranked.select("source", "source_size", filled.alias("target"))


def draw(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) from the hash of the seed and the id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 12),
                  16, 10).cast("double") / float(1 << 48)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """Decide how often each document enters the mix.

    Words are added up per source (partial sums in the map tasks, so a source
    with a third of all rows is no hot spot), a source's repetition rate is
    target / source_size, and a document is taken floor(rate) times plus once
    more when its hash-seeded draw falls under the fraction.  The draw depends
    on the seed and the id only, so reruns agree; rows with equal ids draw
    alike.

    Returns every input row with columns ``row`` (the input columns as a
    struct), size, source_size, target and copies.  Null texts have size 0;
    sources without words have target 0 and take nothing; null is a source of
    its own, the last; an empty table gives no rows."""
    rows = df.select(F.struct("*").alias("row"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    sizes = (df.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
             .groupBy("source").agg(F.sum("size").alias("source_size")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Stored, so that the planner knows its size and can leave the documents unshuffled.
    wanted = stored(targets(sizes, weights, share, most).withColumn("rate", rate)
                    .withColumnRenamed("source", "s"), "mix-targets")
    extra = (draw(F.col("row")[id_col], seed) < F.col("rate") - F.floor("rate")).cast("int")
    return (rows.join(wanted, F.col("source").eqNullSafe(F.col("s")))
            .select("row", "size", "source_size", "target", (F.floor("rate").cast("int") + extra).alias("copies")))


def emit(mixed: DataFrame) -> DataFrame:
    """The mixed corpus: each input row as often as it is taken."""
    return mixed.filter("copies > 0").select("row", F.explode(F.expr("sequence(1, copies)"))).select("row.*")
