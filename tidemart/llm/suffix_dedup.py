"""Repeated byte strings: the depth-``width`` intervals of the corpus's
suffixes, found from sampled anchors and refined to single bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, stored_by_split

#: Windows looked at in one numpy step, so a very long text needs bounded memory.
CHUNK = 1 << 16
#: Bits of an ordering key that hold the place inside a chunk.
PLACE = 17
#: Neighbouring window starts whose common part is tested at once.
BLOCK = 16


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for an odd B, i below n."""
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def scrambled(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(text: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of a text: (first, last, place, name) arrays.

    The anchor of the window [s, s + width) is the place in it of the
    ``gram``-byte string with the smallest scrambled hash, the leftmost of
    equals.  It depends on the window's bytes only, so equal windows have
    their anchors at the same offset.  An anchor serves the run of window
    starts first .. last; ``name`` is the hash of its string."""
    out = []
    span = width - gram + 1  # strings in a window
    up, down = powers(CHUNK + width)
    mask = np.uint64((1 << PLACE) - 1)
    for at in range(0, len(text) - width + 1, CHUNK):
        c = text[at:at + CHUNK + width - 1]
        strings, starts = len(c) - gram + 1, len(c) - width + 1
        sums = np.zeros(len(c) + 1, np.uint64)
        np.cumsum(c * up[:len(c)], out=sums[1:])
        h = scrambled((sums[gram:] - sums[:-gram]) * down[:strings])
        key = (h & ~mask) | np.arange(strings, dtype=np.uint64)
        # Sliding minimum: of a window's two blocks, the end of one and the beginning of the next.
        blocks = np.concatenate([key, np.full(-strings % span, ~np.uint64(0))]).reshape(-1, span)
        head = np.minimum.accumulate(blocks, axis=1).ravel()
        tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(tail[:starts], head[span - 1:span - 1 + starts]) & mask).astype(np.int64)
        cut = np.flatnonzero(np.diff(place))
        first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [starts - 1]])
        p = place[first]
        out.append((first + at, last + at, p + at, h[p].view(np.int64)))
    if not out:
        return (np.empty(0, np.int64),) * 4
    first, last, place, name = (np.concatenate(x) for x in zip(*out))
    # A run that goes on in the next chunk is one: two rows of one place would pass for copies of each other.
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return first[new], last[np.append(new[1:], len(place)) - 1], place[new], name[new]


def buffers(texts: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    for t in texts:
        yield t.as_py()


def anchor_names(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """(pid, name, n): anchor names and how often each split has them, summed
    over a batch of rows.  A batch may hold rows of several splits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names: dict[int, list] = {}
            for pid, text in zip(b.column("pid").to_pylist(), buffers(b.column("text"))):
                names.setdefault(pid, []).append(anchors(np.frombuffer(text, np.uint8), width, gram)[3])
            for pid, found in names.items():
                own, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), pid, np.int32)), pa.array(own), pa.array(n)],
                                                 names=["pid", "name", "n"])

    return docs.select("pid", "text").mapInArrow(run, "pid int, name long, n long")


def beside(docs: DataFrame, found: DataFrame, run, schema: str) -> DataFrame:
    """Run over each split's texts together with the rows found for it."""
    return docs.groupBy("pid").cogroup(found.groupBy("pid")).applyInArrow(run, schema)


def candidate_anchors(docs: DataFrame, repeated: DataFrame, width: int, gram: int) -> DataFrame:
    """The anchors whose names are repeated, with a second hash ``hull`` of
    all bytes that their windows cover; (name, hull) are 128 bits."""
    def run(texts: pa.Table, names: pa.Table) -> pa.Table:
        wanted = np.sort(names.column("name").to_numpy())
        cols: list[list] = [[] for _ in range(7)]
        if len(wanted):
            for pid, rid, text in zip(texts.column("pid").to_pylist(), texts.column("rid").to_pylist(), buffers(texts.column("text"))):
                first, last, place, name = anchors(np.frombuffer(text, np.uint8), width, gram)
                hit = wanted[np.searchsorted(wanted, name).clip(max=len(wanted) - 1)] == name
                if not hit.any():
                    continue
                first, last, place, name = first[hit], last[hit], place[hit], name[hit]
                hull = np.array([xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(first.tolist(), (last + width).tolist())], np.uint64)
                for c, x in zip(cols, (np.full(len(name), pid), np.full(len(name), rid), name, hull.view(np.int64), first, last, place)):
                    c.append(x)
        kinds = (np.int32, np.int64, np.int64, np.int64, np.int32, np.int32, np.int32)
        arrays = [pa.array(np.concatenate(c).astype(k) if c else np.empty(0, k)) for c, k in zip(cols, kinds)]
        return pa.table(arrays, names=["pid", "rid", "name", "hull", "first", "last", "place"])

    return beside(docs.select("pid", "rid", "text"), repeated, run,
                  "pid int, rid long, name long, hull long, first int, last int, place int")


def with_contexts(docs: DataFrame, chosen: DataFrame, left: int, width: int) -> DataFrame:
    """``chosen`` anchors with the bytes around them: ``context`` begins
    ``before`` bytes (``left`` at most) before the anchor and ends ``width``
    bytes after it, or where the text does."""
    def run(texts: pa.Table, rows: pa.Table) -> pa.Table:
        of = dict(zip(texts.column("rid").to_pylist(), range(texts.num_rows)))
        text = texts.column("text")
        contexts, before, held = [], [], (-1, b"")
        rows = rows.sort_by("rid")
        for rid, p in zip(rows.column("rid").to_pylist(), rows.column("place").to_pylist()):
            if held[0] != rid:
                held = rid, text[of[rid]].as_py()
            before.append(min(p, left))
            contexts.append(held[1][p - before[-1]:p + width])
        return rows.append_column("context", pa.array(contexts, pa.binary())).append_column("before", pa.array(before, pa.int32()))

    kinds = ", ".join(f"{c} {t}" for c, t in chosen.dtypes)
    return beside(docs.select("pid", "rid", "text"), chosen, run, f"{kinds}, context binary, before int")


def named(*parts: Column) -> Column:
    """A 128-bit name of some bytes."""
    return F.unhex(F.md5(F.concat(*parts)))


def refined(edges: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Repeated window starts of anchors whose hulls are single: ranges
    (pid, rid, first, last) from whole blocks and from single windows.

    Offsets of a window start before its anchor are cut into blocks.  All
    windows of a block hold its core.  Rows of one core (an interval of the
    suffixes at that depth) either agree on the whole block, and all its
    windows are repeated; or they branch, and their windows are named one by
    one.  A core of its own has no repeated window."""
    at = lambda o: F.col("before") - o + 1  # noqa: E731  substring counts from 1
    low, high = F.col("place") - F.col("last"), F.col("place") - F.col("first")
    blocks = (edges.withColumn("low", low).withColumn("high", high)
              .withColumn("block", F.explode(F.sequence(F.floor(F.col("low") / BLOCK).cast("int"), F.floor(F.col("high") / BLOCK).cast("int"))))
              .withColumn("o", F.col("block") * BLOCK))
    start = F.greatest(at(F.col("o") + BLOCK - 1), F.lit(1))
    side = F.encode(F.concat_ws(":", F.col("name"), F.col("block")), "utf-8")
    core = named(side, F.substring("context", at(F.col("o")), F.lit(width - BLOCK + 1)))
    hull = named(F.encode((at(F.col("o")) - start).cast("string"), "utf-8"), F.substring("context", start, at(F.col("o")) + width - start))
    blocks = stored(blocks.select("eid", "pid", "rid", "place", "block", F.greatest("low", "o").alias("low"),
                                  F.least("high", F.col("o") + BLOCK - 1).alias("high"), core.alias("core"), F.xxhash64(hull).alias("hull")), "suffix-blocks")
    groups = stored(blocks.groupBy("core").agg(F.count("*").alias("n"), (F.min("hull") == F.max("hull")).alias("agree"))
                    .filter("n > 1").select("core", "agree"), "suffix-cores")
    met = stored(blocks.join(groups, "core").select("eid", "pid", "rid", "place", "low", "high", "agree"), "suffix-met")
    whole = met.filter("agree").select("pid", "rid", (F.col("place") - F.col("high")).alias("first"), (F.col("place") - F.col("low")).alias("last"))
    branching = met.filter("NOT agree").groupBy("eid").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    single = (edges.select("eid", "pid", "rid", "place", "context", "before").join(branching, "eid")
              .withColumn("range", F.explode("ranges")).withColumn("o", F.explode(F.expr("sequence(range.low, range.high)")))
              .select("pid", "rid", (F.col("place") - F.col("o")).alias("first"),
                      named(F.substring("context", at(F.col("o")), F.lit(width))).alias("window")))
    single = stored(single, "suffix-windows")
    twice = stored(single.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window"), "suffix-twice")
    return whole, single.join(twice, "window").select("pid", "rid", "first", F.col("first").alias("last"))


def repeated_starts(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """(pid, rid, first, last): ranges of starts whose ``width`` bytes occur
    at another start too."""
    names = stored(anchor_names(docs, width, gram), "suffix-names")
    twice = stored(names.groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1").select("name"), "suffix-repeated")
    repeated = stored(names.join(twice, "name").select("pid", "name").distinct(), "suffix-wanted")
    found = stored(candidate_anchors(docs, repeated, width, gram), "suffix-anchors")
    # Any row of a (name, hull) group stands for it: their bytes agree.
    hulls = stored(found.groupBy("name", "hull").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("pid", "rid", "first", "last", "place")]), "suffix-hulls")
    whole = found.join(hulls.filter("n > 1").select("name", "hull"), ["name", "hull"]).select("pid", "rid", "first", "last")
    alone = hulls.filter("n = 1")
    shown = hulls.filter("n > 1").join(alone.select("name").distinct(), "name", "left_semi")
    chosen = stored(alone.union(shown.select(alone.columns)).select(
        F.monotonically_increasing_id().alias("eid"), "pid", "rid", "name", "first", "last", "place"), "suffix-chosen")
    left = (width - gram) // BLOCK * BLOCK + BLOCK - 1
    blocks, single = refined(stored(with_contexts(docs, chosen, left, width), "suffix-edges"), width)
    return stored(whole.union(blocks).union(single), "suffix-starts")


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 200, gram: int = 48) -> DataFrame:
    """Remove every byte that lies in a ``width``-byte string occurring at
    another start too, in the same text or another; strings are judged on the
    input, overlaps count, matches don't cross texts.

    Suffixes that share ``width`` bytes form the intervals wanted of the
    corpus's suffix array.  No task could hold that array, or even the
    interval of a passage found in a third of all texts, so intervals are
    named by content and counted: sampled anchors that every window has, then
    the whole hull of an anchor's windows, and, where hulls branch, blocks
    and single windows.  A string that only one place has is dropped at the
    first of these that shows it.  Hashes are 128 bits from the hulls on.

    Returns one row per input row: doc_id, n_bytes, spans (array of start
    and end of the maximal removed runs), kept (the remaining bytes).  Null
    and empty texts have no bytes; texts shorter than ``width`` keep all;
    identical rows are copies of each other; an empty table gives no rows;
    further columns are ignored."""
    docs = stored_by_split(df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")), "suffix-docs")
    starts = repeated_starts(docs, width, gram)

    def run(texts: pa.Table, rows: pa.Table) -> pa.Table:
        rid = rows.column("rid").to_numpy()
        order = np.lexsort((rows.column("first").to_numpy(), rid))
        rid, first, end = rid[order], rows.column("first").to_numpy()[order], rows.column("last").to_numpy()[order] + width
        ids = texts.column("rid").to_numpy()
        lows, highs = np.searchsorted(rid, ids), np.searchsorted(rid, ids, "right")
        spans, kept = [], []
        for text, lo, hi in zip(buffers(texts.column("text")), lows, highs):
            if lo == hi:
                spans.append([])
                kept.append(text)
                continue
            reach = np.maximum.accumulate(end[lo:hi])
            new = np.concatenate([[True], first[lo + 1:hi] > reach[:-1]])  # touching runs are one
            begins = first[lo:hi][new].tolist()
            ends = reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [hi - lo - 1]])].tolist()
            spans.append([{"start": a, "end": b} for a, b in zip(begins, ends)])
            kept.append(b"".join(text[a:b] for a, b in zip([0, *ends], [*begins, len(text)])))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table([texts.column("doc_id"), pa.array([len(t) for t in buffers(texts.column("text"))], pa.int64()), pa.array(spans, kind),
                         pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return beside(docs.select("pid", "rid", "doc_id", "text"), starts, run,
                  f"doc_id {kind}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
