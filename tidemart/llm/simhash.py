"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, small_batches, stored

#: Shingles hashed at once, so a very long text needs bounded memory.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash: a bit is set if over half the shingle hashes have it.

    ``text`` is UTF-8.  A-Z are lower-cased, words are runs without ASCII
    white space, shingles are ``shingle`` words joined by a space, repeats
    included; fewer words make one shingle, none give 0."""
    words = text.lower().split()  # on bytes: A-Z, and space or TAB .. CR
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, last, CHUNK):
        end = min(last, at + CHUNK)
        columns = [words[at + k:end + k] for k in range(min(shingle, len(words)))]
        hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in map(b" ".join, zip(*columns))], np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > last).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """``fingerprint`` of a string column as a signed long, in Arrow batches."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return run(F.coalesce(text, F.lit("")).cast("binary"))


def ball(segment: Column, bits: int, radius: int) -> Column:
    """Every value within ``radius`` (0 or 1) differing bits of a segment."""
    own = F.array(segment)
    if radius == 0:
        return own
    flip = [F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(bits)]
    return F.concat(own, F.array(*[segment.bitwiseXOR(x) for x in flip]))


def near_pairs(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """Distinct fingerprints ``fp`` -> all pairs (a, b), a < b, at most
    ``max_bits`` bits apart.

    The 64 bits are cut into segments, few enough that one segment of every
    such pair differs in one bit at most: two segments for three bits.  Each
    fingerprint is filed under its segments; it looks up the Hamming ball of
    radius 1 around each of its own segments, and the complete distance of
    every match is verified."""
    segments = max_bits // 2 + 1
    width = 64 // segments
    cuts = [(i * width, 64 if i == segments - 1 else (i + 1) * width) for i in range(segments)]
    part = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) if hi - lo < 64 else F.col("fp") for lo, hi in cuts]
    table = prints.select(F.col("fp").alias("b"), F.posexplode(F.array(*part)).alias("segment", "value"))
    probes = prints.select(F.col("fp").alias("a"), F.posexplode(F.array(
        *[ball(p, hi - lo, 1 if max_bits >= segments else 0) for p, (lo, hi) in zip(part, cuts)])).alias("segment", "values"))
    probes = probes.select("a", "segment", F.explode("values").alias("value"))
    return (probes.join(table, ["segment", "value"])
            .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
            .select("a", "b"))


def simhash_components(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, ...) rows -> one row per distinct fp: (fp, component), the
    smallest fingerprint reachable over pairs within ``max_bits``."""
    each = stored(prints.select("fp").distinct(), "simhash-prints")
    parts = connected_components(near_pairs(each, max_bits))
    return each.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"))


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Fingerprint every text and join fingerprints that nearly agree.

    Equal fingerprints are merged before any search, so exact copies cost one
    entry however many there are; components are found over distinct
    fingerprints.  Returns one row per input row: doc_id, fp (signed long),
    component_id (smallest doc_id reachable, itself included).  Null and
    empty texts have fingerprint 0 and link like any other; null ids name a
    component only if it has no other; an empty table gives no rows; further
    columns are ignored."""
    with small_batches(df.sparkSession):
        docs = stored(df.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col), shingle).alias("fp")),
                      "simhash-docs")
    firsts = docs.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = stored(simhash_components(docs, max_bits).join(firsts, "fp"), "simhash-named")
    least = stored(named.groupBy("component").agg(F.min("first").alias("component_id")), "simhash-least")
    of_print = stored(named.join(least, "component").select("fp", "component_id"), "simhash-parts")
    return docs.join(of_print, "fp").select("doc_id", "fp", "component_id")


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``df``, one of each SimHash component: the one with the
    smallest id (nulls last; of identical rows any one)."""
    with small_batches(df.sparkSession):
        docs = stored(df.select(F.monotonically_increasing_id().alias("rid"), F.struct("*").alias("row"),
                                fingerprint_column(F.col(text_col), shingle).alias("fp")), "simhash-rows")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "rid")
    firsts = (docs.select("fp", "rid", F.col("row")[id_col].alias("id")).groupBy("fp").agg(F.min(order).alias("first")))
    keep = (simhash_components(docs, max_bits).join(firsts, "fp").groupBy("component")
            .agg(F.min("first")["rid"].alias("rid")).select("rid"))
    # The ids kept grow with the rows, so they're never broadcast.
    return docs.join(stored(keep, "simhash-keep").hint("shuffle_hash"), "rid", "left_semi").select("row.*")
