"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sorted_names, stored, without_spaces


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 2048,
                key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Group texts that are equal after all white space is deleted.

    The normalised UTF-8 bytes are cut into blocks of ``block_bytes``.
    Distinct blocks are sorted into integer names, then adjacent pairs of
    names are named again, level by level, until each document has one name:
    (level, name) is equal exactly when the texts are.

    Blocks sort by ``key`` (a hash) first and by content among equal keys.
    All block contents are compared once: where a key stands for one content
    the key alone finds the name, and only contents that collide on a key
    travel again to be told apart.  Hot blocks are merged in the map tasks
    and joined by an inner join that adaptive execution can split.

    Returns one row per input row: doc_id, keep_id, group_size, kept,
    text_sha256.  Of a group the row with the most code points stays, then
    the smallest doc_id (null ids last), then one of the identical rows.
    Null and empty texts are equal; an empty table gives no rows; further
    columns are ignored."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = without_spaces(text).cast("binary")
    n_blocks = F.greatest(F.lit(1), F.ceil(F.length("bare") / block_bytes)).cast("int")
    block = lambda i: F.substring("bare", i * block_bytes + 1, F.lit(block_bytes))
    cut = (df.select(F.col(id_col).alias("id"), F.length(text).cast("long").alias("n_chars"), bare.alias("bare"))
             .withColumn("blocks", F.transform(F.sequence(F.lit(0), n_blocks - 1), block)))
    contents = cut.select(F.explode("blocks").alias("block")).select(key(F.col("block")).alias("k"), "block")
    per_key = stored(contents.groupBy("k").agg(F.count_distinct("block").alias("contents")), "exact-keys")
    names = sorted_names(per_key.filter("contents = 1").select("k"), ["k"], "name", "exact-names")
    clashing = per_key.filter("contents > 1").select("k")
    clash = not clashing.isEmpty()
    cut = cut.withColumn("rid", F.monotonically_increasing_id())
    if clash:  # the texts are read again, so their row ids have to be fixed
        cut = stored(cut, "exact-texts")
    docs = stored(cut.select("rid", "id", "n_chars", F.sha2("bare", 256).alias("sha"), F.size("blocks").alias("n"),
                             F.transform("blocks", lambda b: key(b)).alias("keys")), "exact-docs")
    level = (docs.select("rid", "n", F.posexplode("keys").alias("pos", "k")).join(names, "k")
             .select("rid", "n", "pos", "name"))
    if clash:
        # Blocks whose key has several contents are named by content, below 0
        # to differ from the rest.
        rows = stored(cut.select("rid", F.size("blocks").alias("n"), F.posexplode("blocks").alias("pos", "block"))
                      .withColumn("k", key(F.col("block"))).join(clashing, "k"), "exact-clash")
        told = sorted_names(rows.select("k", "block").distinct(), ["k", "block"], "name", "exact-told")
        level = level.union(rows.join(told, ["k", "block"]).select("rid", "n", "pos", -1 - F.col("name")))
    longest = docs.agg(F.max("n")).first()[0] or 1
    done, depth = [], 0
    while True:
        level = stored(level, "exact-level")
        done.append(level.filter("n = 1").select("rid", F.lit(depth).alias("depth"), "name"))
        if longest == 1:
            break
        half = F.floor(F.col("pos") / 2).cast("int")
        pairs = (level.filter("n > 1").groupBy("rid", half.alias("pos"))
                 .agg(F.first("n").alias("n"), F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b"))
                 # An odd last name stands alone; no pair has it as second.
                 .select("rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "a",
                         F.coalesce("b", F.lit(-(1 << 62))).alias("b")))
        named = sorted_names(pairs.select("a", "b").distinct(), ["a", "b"], "name", "exact-pairs")
        level = pairs.join(named, ["a", "b"]).select("rid", "n", "pos", "name")
        longest, depth = (longest + 1) // 2, depth + 1
    identity = done[0]
    for d in done[1:]:
        identity = identity.union(d)
    rows = stored(docs.select("rid", "id", "n_chars", "sha").join(identity, "rid"), "exact-ids")
    best = F.min(F.struct((-F.col("n_chars")).alias("len"), F.col("id").isNull().alias("none"), "id", "rid"))
    # Stored, so that the join below can split a group that holds many rows.
    groups = stored(rows.groupBy("depth", "name").agg(best.alias("best"), F.count("*").alias("group_size")), "exact-groups")
    return rows.join(groups, ["depth", "name"]).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"), F.col("sha").alias("text_sha256"))
