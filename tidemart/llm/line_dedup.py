"""Repeated line runs, from suffix ranks over line-name sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import sorted_names, stored
from .mixing import word_count


def suffix_ranks(names: DataFrame, depth: int) -> DataFrame:
    """Prefix doubling over (rid, seq, name): rows (level, rid, seq, name).

    At level k ``name`` ranks the suffix at (rid, seq) by its first 2**k line
    names, equal ranks for equal prefixes: the suffix array cut at that depth,
    each rank one interval of suffixes whose common prefix is 2**k lines or
    longer.  A level sorts the distinct pairs (rank, rank 2**(k-1) lines on).
    Suffixes alone in their interval leave, so later levels shrink."""
    level = stored(names.select(F.lit(0).alias("level"), "rid", "seq", "name"), "line-level")
    levels, k = level, 0
    while 2 << k <= depth:
        ahead = W.partitionBy("rid").orderBy("seq").rangeBetween(1 << k, 1 << k)
        pairs = stored(level.withColumn("next", F.max("name").over(ahead)).filter("next IS NOT NULL")
                       .select("rid", "seq", "name", "next"), "line-pairs")
        shared = (pairs.groupBy("name", "next").agg(F.count("*").alias("n")).filter("n > 1")
                  .select("name", "next"))
        ranks = sorted_names(shared, ["name", "next"], "rank", "line-ranks")
        k += 1
        level = stored(pairs.join(ranks, ["name", "next"]).select(
            F.lit(k).alias("level"), "rid", "seq", F.col("rank").alias("name")), "line-level")
        levels = levels.union(level)
    return levels


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(rid, seq, words) of repeated lines -> (rid, start, n): for every line
    the shortest run of neighbours with ``min_words`` words that begins with
    it, and the shortest that ends with it."""
    stretch = F.col("seq") - F.row_number().over(W.partitionBy("rid").orderBy("seq"))
    part = W.partitionBy("rid", "stretch").orderBy("seq")
    reach = min_words - 1  # every line has a word

    def n(words):
        sums = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.struct(
            F.aggregate(F.slice(words, F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x).alias("sum"), i.alias("n")))
        return F.get(F.filter(sums, lambda s: s["sum"] >= min_words), F.lit(0))["n"]

    runs = lines.withColumn("stretch", stretch).select(
        "rid", "seq",
        n(F.collect_list("words").over(part.rowsBetween(0, reach))).alias("on"),
        n(F.reverse(F.collect_list("words").over(part.rowsBetween(-reach, 0)))).alias("back"))
    return (runs.select("rid", F.col("seq").alias("start"), F.col("on").alias("n"))
            .union(runs.select("rid", F.col("seq") - F.col("back") + 1, "back"))
            .filter("n IS NOT NULL").distinct())


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10) -> DataFrame:
    """Delete later copies of repeated line runs.

    Texts are sequences of lines (split at \\n); blank lines are passed over.
    Lines become integer names in sorted order of their digests, suffix ranks
    over the name sequences come from distributed prefix doubling, and the
    suffixes that share a run form one interval.  A run counts if it has
    ``min_words`` words or more; the intervals of the shortest such runs
    decide, since their union over all places is the union of all maximal
    repeated runs that long.  The interval's first place in (id, row) order
    stays, each later copy is deleted with the blank lines inside it.  So the
    first copy of every line stays.  No interval is ever gathered: its first
    place is an aggregate, joined back to the places.

    Returns one row per input row: ``row`` (the input columns as a struct),
    text (what is left, null for a null text), n_lines, n_deleted, runs
    (array of first and last deleted line, maximal runs), emptied (it had
    words and has none left).  Null ids come last in the order; identical
    rows count as copies; an empty table gives no rows."""
    docs = stored(df.select(F.monotonically_increasing_id().alias("rid"), F.struct("*").alias("row")), "line-text")
    text = F.col("row")[text_col]
    line = lambda x, i: F.struct(i.alias("idx"), F.unhex(F.md5(x)).alias("key"), word_count(x).alias("words"))
    sequence = F.filter(F.transform(F.split(text, "\n"), line), lambda s: s["words"] > 0)
    slim = stored(docs.select("rid", F.col("row")[id_col].alias("id"), sequence.alias("lines")), "line-docs")
    places = slim.select("rid", F.posexplode("lines").alias("seq", "line")).select("rid", "seq", "line.*")
    twice = places.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    names = sorted_names(twice, ["key"], "name", "line-names")
    level = stored(places.join(names, "key").select("rid", "seq", "idx", "words", "name"), "line-repeated")

    ranks = suffix_ranks(level, min_words)
    # Two overlapping ranks name a run of n lines.
    log = F.floor(F.log2(F.col("n") + F.lit(0.5))).cast("int")
    runs = (shortest_runs(level, min_words).withColumn("level", log)
            .withColumn("second", F.col("start") + F.col("n") - F.expr("shiftleft(1, level)")))
    first = ranks.select("level", "rid", F.col("seq").alias("start"), F.col("name").alias("a"))
    second = ranks.select("level", "rid", F.col("seq").alias("second"), F.col("name").alias("b"))
    runs = stored(runs.join(first, ["level", "rid", "start"]).join(second, ["level", "rid", "second"])
                  .join(slim.select("rid", "id"), "rid").select("rid", "id", "start", "n", "a", "b"), "line-runs")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "rid", "start")
    intervals = stored(runs.groupBy("n", "a", "b").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
                       .filter("copies > 1"), "line-intervals")
    later = (runs.join(intervals, ["n", "a", "b"])
             .filter((F.col("rid") != F.col("first.rid")) | (F.col("start") != F.col("first.start")))
             .select("rid", F.explode(F.expr("sequence(start, start + n - 1)")).alias("seq")).distinct()
             .join(level.select("rid", "seq", "idx"), ["rid", "seq"]))
    island = F.col("seq") - F.row_number().over(W.partitionBy("rid").orderBy("seq"))
    cut = (later.withColumn("island", island).groupBy("rid", "island")
           .agg(F.struct(F.min("idx").alias("first"), F.max("idx").alias("last")).alias("run"), F.count("*").alias("n"))
           .groupBy("rid").agg(F.array_sort(F.collect_list("run")).alias("runs"), F.sum("n").alias("gone")))
    cut = stored(slim.select("rid", F.size("lines").alias("full")).join(cut, "rid"), "line-cuts")
    parts = F.split(text, "\n")
    kept = F.filter(parts, lambda x, i: ~F.exists("runs", lambda r: (i >= r["first"]) & (i <= r["last"])))
    # The list of cuts grows with the texts, so it's never broadcast; as the
    # hashed side it spares the texts a sort.
    return docs.join(cut.hint("shuffle_hash"), "rid", "left").select(
        "row", F.when(F.col("runs").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("runs").isNull(), 0).otherwise(F.size(parts) - F.size(kept)).cast("long").alias("n_deleted"),
        F.coalesce("runs", F.array().cast("array<struct<first:int,last:int>>")).alias("runs"),
        F.coalesce(F.col("gone") == F.col("full"), F.lit(False)).alias("emptied"))
