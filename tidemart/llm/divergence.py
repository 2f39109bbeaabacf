"""Source divergence audit over a minimal acyclic transducer vocabulary."""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Terms are runs of ASCII letters and characters beyond ASCII; in UTF-8 every
#: byte of the latter is over 0x7F.
_TERM_BYTES = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_IS_TERM = np.array([chr(b).isalpha() and b < 128 or b > 127 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


# ---------------------------------------------------------------- transducer --
class Transducer:
    """A minimal acyclic transducer: bytes of a term in, its ordinal out.

    State s has arcs for the bytes from ``low[s]`` on, ``width[s]`` of them,
    at ``first[s]`` of ``target`` (-1: no such arc) and ``output``.  The
    ordinal of an accepted term, its place in sorted order, is the sum of the
    outputs on its way."""

    def __init__(self, low, width, first, final, target, output, root: int, terms: int):
        self.low, self.width, self.first, self.final = low, width, first, final
        self.target, self.output, self.root, self.terms = target, output, root, terms

    @classmethod
    def build(cls, terms: Sequence[bytes]) -> Transducer:
        """From distinct terms in byte order, in one pass: the states behind
        the last term's way that the next term leaves can't change any more,
        so each is replaced by an equal state that is there already."""
        known: dict[tuple, int] = {}
        arcs: list[tuple] = []  # of every final state: ((byte, state), ...)
        finals: list[bool] = []
        accepted: list[int] = []  # how many terms end at or after a state

        def freeze(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in known:
                known[key] = len(arcs)
                arcs.append(key[1])
                finals.append(key[0])
                accepted.append(key[0] + sum(accepted[s] for _, s in key[1]))
            return known[key]

        path = [[False, []]]  # the last term's states: accepting, arcs but the last
        last = b""
        for term in [*terms, None]:
            same = 0
            if term is not None:
                if path[0][0] or len(path) > 1:
                    assert term > last, "terms must be sorted and distinct"
                while same < min(len(term), len(last)) and term[same] == last[same]:
                    same += 1
            while len(path) > same + 1:
                state = freeze(path.pop())
                path[-1][1].append((last[len(path) - 1], state))
            if term is not None:
                path += [[False, []] for _ in range(len(term) - same)]
                path[-1][0] = True
                last = term
        root = freeze(path[0])
        low = np.array([a[0][0] if a else 0 for a in arcs], np.int32)
        width = np.array([a[-1][0] - a[0][0] + 1 if a else 0 for a in arcs], np.int32)
        first = np.concatenate([[0], np.cumsum(width)[:-1]]).astype(np.int64)
        target, output = np.full(int(width.sum()), -1, np.int32), np.zeros(int(width.sum()), np.int64)
        for s, own in enumerate(arcs):
            before = int(finals[s])
            for byte, t in own:
                target[first[s] + byte - low[s]], output[first[s] + byte - low[s]] = t, before
                before += accepted[t]
        return cls(low, width, first, np.array(finals, bool), target, output, root, accepted[root])

    def ordinals(self, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ordinals of the terms text[start : start + length], -1 for
        those not held; all terms step together."""
        out = np.full(len(starts), -1, np.int64)
        at, left, index = starts, lengths, np.arange(len(starts))
        state, total = np.full(len(starts), self.root, np.int64), np.zeros(len(starts), np.int64)
        while len(index):
            ended = left == 0
            if ended.any():
                hit = ended & self.final[state]
                out[index[hit]] = total[hit]
                go = ~ended
                at, left, index, state, total = at[go], left[go], index[go], state[go], total[go]
                if not len(index):
                    break
            place = text[at].astype(np.int32) - self.low[state]
            go = (place >= 0) & (place < self.width[state])
            slot = self.first[state[go]] + place[go]
            to = self.target[slot]
            alive = to >= 0
            at, left, index = at[go][alive] + 1, left[go][alive] - 1, index[go][alive]
            state, total = to[alive].astype(np.int64), total[go][alive] + self.output[slot[alive]]
        return out

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal: at each state the last arc whose output
        doesn't pass what is left."""
        state, out = self.root, bytearray()
        while not (self.final[state] and ordinal == 0):
            a, n = self.first[state], self.width[state]
            fits = np.flatnonzero((self.target[a:a + n] >= 0) & (self.output[a:a + n] <= ordinal))[-1]
            out.append(int(self.low[state] + fits))
            ordinal -= int(self.output[a + fits])
            state = self.target[a + fits]
        return bytes(out)

    def to_bytes(self) -> bytes:
        return pickle.dumps(self.__dict__, protocol=5)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Transducer:
        return cls(**pickle.loads(blob))


def term_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lengths of the terms in UTF-8 bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _IS_TERM[text], [False]]).view(np.int8)))
    return edge[::2], edge[1::2] - edge[::2]


# ---------------------------------------------------------------- vocabulary --
def kept_terms(docs: DataFrame, min_docs: int, hold: int = 1 << 20) -> DataFrame:
    """(lang, term) of the terms in ``min_docs`` rows of a language or more.

    A task counts each row's distinct terms on their UTF-8 bytes, where lower
    case touches A-Z alone, and hands its counts on when it holds ``hold``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, own in counts.items():
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(own), pa.string()), "term": pa.array(list(own), pa.binary()),
                                                  "docs": pa.array(list(own.values()), pa.int64())})
            counts.clear()

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                counts.setdefault(lang, Counter()).update(set(_TERM_BYTES.findall(text.as_buffer().to_pybytes().lower())))
                if sum(map(len, counts.values())) > hold:
                    yield from flushed()
        yield from flushed()

    partial = docs.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(run, "lang string, term binary, docs long")
    return (partial.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= min_docs).select("lang", "term"))


def transducers(terms: DataFrame, shard_bytes: int) -> DataFrame:
    """(lang, shard, base, terms, machine): the vocabulary of each language in
    term order, cut into shards of about ``shard_bytes`` of terms; ``base`` is
    the ordinal of a shard's first term in its language.

    Where a shard ends follows from prefix sums over the sorted partitions'
    totals, so it doesn't depend on how the rows are partitioned."""
    def build(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        t = Transducer.build(sorted(bytes(x) for x in own["term"]))
        return pd.DataFrame({"lang": [key[0]], "shard": [key[1]], "terms": [t.terms], "machine": [t.to_bytes()]})

    ordered = stored(terms.repartitionByRange("lang", "term")
                     .sortWithinPartitions("lang", "term").withColumn("pid", F.spark_partition_id()), "divergence-terms")
    size = F.sum(F.octet_length("term"))
    parts = ordered.groupBy("lang", "pid").agg(size.alias("bytes"))
    before = W.partitionBy("lang").orderBy("pid").rowsBetween(W.unboundedPreceding, -1)  # a row for each partition
    parts = parts.select("lang", "pid", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("before"))
    within = W.partitionBy("lang", "pid").orderBy("term").rowsBetween(W.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(size.over(within), F.lit(0))
    cut = ordered.join(parts, ["lang", "pid"]).select("lang", "term", F.floor(at / shard_bytes).cast("int").alias("shard"))
    built = stored(cut.groupBy("lang", "shard").applyInPandas(build, "lang string, shard int, terms long, machine binary"), "divergence-built")
    order = W.partitionBy("lang").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # a row for each shard, without its machine
    placed = built.select("lang", "shard", F.coalesce(F.sum("terms").over(order), F.lit(0)).alias("base"))
    return stored(built.join(placed, ["lang", "shard"]).select("lang", "shard", "base", "terms", "machine"), "divergence-machines")


# ------------------------------------------------------------------- recount --
def _rounds(shards: DataFrame, most_bytes: int) -> list[list[tuple[str, int]]]:
    """The shards (lang, shard) in rounds whose machines fit ``most_bytes``."""
    rounds, size = [], most_bytes + 1
    for r in shards.select("lang", "shard", F.length("machine").alias("n")).orderBy("shard", "lang").toLocalIterator():
        if size + r.n > most_bytes:
            rounds.append([])
            size = 0
        rounds[-1].append((r.lang, r.shard))
        size += r.n
    return rounds


def _count_round(docs: DataFrame, shards: DataFrame, names: list[tuple[str, int]], chunk: int, hold: int) -> DataFrame:
    """Stream all texts through some shards: (lang, source, shard, ordinal, n),
    partial counts."""
    spark = docs.sparkSession
    wanted = spark.createDataFrame(names, "lang string, shard int")
    rows = shards.join(F.broadcast(wanted), ["lang", "shard"]).collect()  # at most the round's bytes
    machines: dict[str, list[tuple[int, int, bytes]]] = {}
    for r in rows:
        machines.setdefault(r.lang, []).append((r.shard, r.base, bytes(r.machine)))
    bound = spark.sparkContext.broadcast(machines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = {lang: [(s, base, Transducer.from_bytes(m)) for s, base, m in own] for lang, own in bound.value.items()}
        counts: dict[tuple, list[np.ndarray]] = {}

        def merged() -> int:
            for key, parts in counts.items():
                both = np.concatenate(parts, axis=1)
                ordinals, place = np.unique(both[0], return_inverse=True)
                counts[key] = [np.stack([ordinals, np.bincount(place, both[1], len(ordinals)).astype(np.int64)])]
            return sum(p[0].shape[1] for p in counts.values())

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source, shard), parts in counts.items():
                ordinals, n = parts[0]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(n), pa.string()), "source": pa.array([source] * len(n), pa.string()),
                    "shard": pa.array([shard] * len(n), pa.int32()), "ordinal": ordinals, "n": n})
            counts.clear()

        pending = 0
        for b in batches:
            langs, sources, texts = b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text")
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(langs, sources)):
                groups.setdefault(key, []).append(i)
            for (lang, source), own in groups.items():
                if lang not in loaded:
                    continue
                for text in _joined(texts, own, chunk):
                    lower = _LOWER[text]
                    starts, lengths = term_spans(text)
                    for shard, base, machine in loaded[lang]:
                        found = machine.ordinals(lower, starts, lengths)
                        ordinals, n = np.unique(found[found >= 0], return_counts=True)
                        if len(n) == 0:
                            continue
                        counts.setdefault((lang, source, shard), []).append(np.stack([ordinals + base, n]).astype(np.int64))
                        pending += len(n)
                    if pending > hold:
                        pending = merged()
                        if pending > hold // 2:
                            yield from flushed()
                            pending = 0
        merged()
        yield from flushed()

    return docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "lang string, source string, shard int, ordinal long, n long")


def _joined(texts: pa.Array, rows: list[int], chunk: int) -> Iterator[np.ndarray]:
    """The texts of some rows as byte arrays of about ``chunk``, a blank
    between texts; a longer text is cut between terms only."""
    parts, size = [], 0
    for i in rows:
        t = np.frombuffer(texts[i].as_buffer(), np.uint8)
        while len(t) > chunk:
            gaps = np.flatnonzero(~_IS_TERM[t[chunk:]])  # the term that lies on the cut stays whole
            end = chunk + int(gaps[0]) if len(gaps) else len(t)
            yield t[:end]
            t = t[end:]
        parts += [t, np.array([32], np.uint8)]
        size += len(t)
        if size > chunk:
            yield np.concatenate(parts)
            parts, size = [], 0
    if parts:
        yield np.concatenate(parts)


def recount(docs: DataFrame, shards: DataFrame, most_bytes: int, chunk: int = 1 << 20, hold: int = 1 << 20) -> DataFrame:
    """(lang, source, shard, ordinal, n): occurrences of every kept term."""
    parts = None
    for names in _rounds(shards, most_bytes):
        part = stored(_count_round(docs, shards, names, chunk, hold).groupBy("lang", "source", "shard", "ordinal")
                      .agg(F.sum("n").alias("n")), "divergence-counts")
        parts = part if parts is None else parts.union(part)
    if parts is None:
        return docs.sparkSession.createDataFrame([], "lang string, source string, shard int, ordinal long, n long")
    return parts


# ---------------------------------------------------------------- divergence --
def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)), exactly: the remainder is
    taken off before the division."""
    top = (n + 5).cast("decimal(19,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    under = (total + 5 * terms).cast("decimal(19,0)")
    return F.lit(1).cast("long") + ((top - top % under) / under).cast("long")


def pair_distances(groups: DataFrame, shares: DataFrame, block: int, side: int) -> DataFrame:
    """(lang, source, item, value): the distance of every two sources of a
    language, summed over all its terms.

    The matrix of a language, sources by terms, is cut into tiles of ``block``
    terms and two sets of about ``side`` sources; a tile is one small group,
    whatever the language holds.  A source enters a tile with the share of a
    term it doesn't have, so absent terms cost nothing."""
    sides = F.ceil(F.count("*").over(W.partitionBy("lang")) / side).cast("int")
    placed = stored(groups.withColumn("sides", sides).withColumn("own", F.expr("cast(pmod(xxhash64(source), sides) AS int)")), "divergence-sides")
    blocks = F.greatest(F.lit(0).cast("long"), F.floor((F.col("terms") - 1) / block))
    none = placed.select("lang", "source", "own", "sides", F.explode(F.sequence(F.lit(0).cast("long"), blocks)).alias("block"), "terms",
                         F.lit(-1).cast("long").alias("ordinal"), F.col("absent").alias("p"))
    some = shares.join(placed.select("lang", "source", "own", "sides", "terms"), ["lang", "source"]).select(
        "lang", "source", "own", "sides", F.floor(F.col("ordinal") / block).alias("block"), "terms", "ordinal", "p")
    tiles = (none.union(some).withColumn("other", F.explode(F.expr("sequence(0, sides - 1)")))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "sides"))

    def run(key: tuple, tile: pd.DataFrame) -> pd.DataFrame:
        lang, number, i, j = key
        width = int(max(0, min(block, tile["terms"].iloc[0] - number * block)))
        base = tile[tile["ordinal"] < 0].sort_values("source", kind="stable")
        names = base["source"].tolist()
        matrix = np.repeat(base["p"].to_numpy(np.int64)[:, None], width, axis=1)
        there = tile[tile["ordinal"] >= 0]
        row = {s: k for k, s in enumerate(names)}
        matrix[there["source"].map(row).to_numpy(np.int64), there["ordinal"].to_numpy(np.int64) - number * block] = there["p"].to_numpy(np.int64)
        own = base["own"].to_numpy()
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        out = []
        for x in a:  # each pair once, in its tile of the two sides
            other = b if i != j else b[b > x]
            for y, value in zip(other, np.abs(matrix[other] - matrix[x]).sum(axis=1)):
                out.append((lang, names[x], names[y], int(value)))
        return pd.DataFrame(out, columns=["lang", "source", "item", "value"]).astype({"value": "int64"})

    half = (tiles.groupBy("lang", "block", "i", "j").applyInPandas(run, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    half = stored(half, "divergence-pairs")
    return half.union(half.select("lang", "item", "source", "value"))


def spelled(tops: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, shard, ordinal) -> and item: the machines run backwards."""
    def run(key: tuple, asked: pd.DataFrame, machine: pd.DataFrame) -> pd.DataFrame:
        t, base = Transducer.from_bytes(bytes(machine["machine"].iloc[0])), int(machine["base"].iloc[0])
        return asked.assign(item=[t.term(int(o) - base).decode() for o in asked["ordinal"]])

    asked = tops.select("lang", "shard", "ordinal").distinct()
    need = shards.join(asked.select("lang", "shard").distinct(), ["lang", "shard"], "left_semi")
    return asked.groupBy("lang", "shard").cogroup(need.groupBy("lang", "shard")).applyInPandas(
        run, "lang string, shard int, ordinal long, item string")


def divergence(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 30,
               top: int = 50, shard_bytes: int = 4 << 20, most_bytes: int = 64 << 20, block: int = 1024, side: int = 64) -> DataFrame:
    """How far the sources of each language are apart, and by which terms.

    The terms in ``min_docs`` or more documents (rows) of a language are
    sorted and built into minimal acyclic transducers that give each its
    lexicographic ordinal.  All texts are streamed through them again; only
    ordinals and counts travel from there.  A group (language, source) gives
    every kept term the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)).

    The machines are cut into shards of ``shard_bytes`` of terms; tasks get at
    most ``most_bytes`` of machines at once, and a larger vocabulary takes
    further passes over the texts.  The shares' distances are summed tile by
    tile (see ``pair_distances``); its rows, every other source of a source,
    are the result asked for.  The best terms of a group are picked by a
    ranking that keeps ``top`` rows in each map task.  All numbers are exact.

    Returns lang, source, part, item, value, rank: ``pair`` rows with every
    other source of the language and the sum of |p - q|, and ``term`` rows
    with the ``top`` terms the group has more of than its language.  Ties go
    by the item's UTF-8 order: for terms that is the ordinal's.  Null text,
    lang and source are ''; a group without terms has its pairs, and a
    language without kept terms pairs of value 0; repeated rows count as often
    as they stand; an empty table gives no rows; further columns are ignored."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = df.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), blank(text_col).alias("text"))
    shards = transducers(stored(kept_terms(docs, min_docs), "divergence-kept"), shard_bytes)
    counts = recount(docs, shards, most_bytes)
    sizes = shards.groupBy("lang").agg(F.sum("terms").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
              .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms"))
              .withColumn("absent", F.when(F.col("terms") > 0, _share(zero, F.col("total"), F.col("terms"))).otherwise(zero)))
    groups = stored(groups, "divergence-groups")
    n, total, terms = F.col("n"), F.col("total"), F.col("terms")
    shares = stored(counts.join(groups, ["lang", "source"]).select("lang", "source", "shard", "ordinal", "terms", _share(n, total, terms).alias("p")),
                    "divergence-shares")

    by_size = [F.col("value").desc(), F.col("item")]
    pairs = pair_distances(groups, shares.select("lang", "source", "ordinal", "p"), block, side)
    pairs = pairs.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(*by_size)))

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(
        groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms")), "lang")
    whole = whole.select("lang", "ordinal", _share(n, total, terms).alias("q"))
    ranked = shares.join(whole, ["lang", "ordinal"]).filter("p > q").select("lang", "source", "shard", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    best = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ordinal")
    tops = stored(ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top), "divergence-tops")
    named = tops.join(spelled(tops, shards), ["lang", "shard", "ordinal"])
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).union(named.withColumn("part", F.lit("term")).select(columns))
