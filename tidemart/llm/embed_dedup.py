"""Near-duplicate vectors by a pivot-permutation index."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, stored

#: Bound on the pivots of one vector length (8 MB at 64 components).
MAX_PIVOTS = 1 << 14


def choose_pivots(sample: np.ndarray, count: int, seed: int = 11) -> np.ndarray:
    """Reference points: unit vectors of the sample, each as far as possible
    from those before, so that a dense group doesn't hold most of them; if the
    sample has fewer distinct points, random directions follow."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    pivots, near = [], np.full(len(sample), -np.inf)
    while len(pivots) < count and len(sample) and (near < 1 - 1e-9).any():
        k = int(near.argmin())
        pivots.append(sample[k])
        near = np.maximum(near, sample @ sample[k])
    more = rng.normal(size=(count - len(pivots), dim))
    more /= np.linalg.norm(more, axis=1, keepdims=True)
    return np.vstack([np.array(pivots).reshape(-1, dim), more])


def nearest_pivots(units: np.ndarray, pivots: np.ndarray, top: int) -> np.ndarray:
    """The ordered prefix of each vector's pivot permutation: indexes of its
    nearest pivots, nearest first.  A few thousand distances at a time."""
    step = max(1, (1 << 22) // len(pivots))
    found = []
    for at in range(0, len(units), step):
        far = -(units[at:at + step] @ pivots.T)
        near = np.sort(np.argpartition(far, top - 1, axis=1)[:, :top], axis=1)
        order = np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable")
        found.append(np.take_along_axis(near, order, axis=1))
    return np.concatenate(found)


def units_of(vectors: pa.ListArray) -> np.ndarray:
    """Equally long float arrays as unit rows in double precision.  Powers of
    two are taken out first, so no square over- or underflows."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def whole(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def describe(reps: DataFrame, pivots: dict[int, np.ndarray], top: int) -> DataFrame:
    """The index: each vector's ``top`` nearest pivots, nearest first."""
    bound = reps.sparkSession.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS vectors of each length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = b.filter(pa.array(dims == dim))
                near = nearest_pivots(units_of(own.column("embedding")), bound.value[int(dim)], top).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [own.column("label"), own.column("dim"), own.column("rep"),
                     pa.ListArray.from_arrays(np.arange(len(near) + 1, dtype=np.int32) * top, near.ravel())],
                    names=["label", "dim", "rep", "pivots"])

    label = reps.schema["label"].dataType.simpleString()
    return reps.select("label", "dim", "rep", "embedding").mapInArrow(run, f"label {label}, dim int, rep long, pivots array<int>")


def postings(index: DataFrame, base: int, top: int, shared: int) -> DataFrame:
    """Inverted lists: a row for each ``shared`` of the ``top`` nearest pivots
    of a vector; ``list`` numbers the set, its pivots in ascending order."""
    def number(some: tuple) -> Column:
        return reduce(lambda n, k: n * base + F.get("pivots", F.lit(k)), some, F.lit(0).cast("long"))

    index = index.withColumn("pivots", F.array_sort("pivots"))
    return index.withColumn("list", F.explode(F.array(*[number(c) for c in combinations(range(top), shared)])))


def first_shared(a: np.ndarray, b: np.ndarray, base: int, shared: int) -> np.ndarray:
    """The list that owns each pair: the number of the first ``shared`` pivots
    that both (ascending) rows hold, -1 if they share fewer."""
    common = (a[:, :, None] == b[:, None, :]).any(axis=2)
    nth = np.cumsum(common, axis=1)
    number = np.zeros(len(a), np.int64)
    for k in range(1, shared + 1):
        number = number * base + a[np.arange(len(a)), (common & (nth == k)).argmax(axis=1)]
    return np.where(nth[:, -1] >= shared, number, -1)


def verify(rows: pa.Table, base: int, shared: int, min_cos: float) -> pa.RecordBatch:
    """Links within whole groups (lid, i, j), sorted by these and ``own``:
    between blocks i and j of a list, or inside a block if they're equal.  A
    pair counts in the list that owns it only.  Rows (rep, links, root): links
    counts copies, root is the smallest rep of the local component."""
    lid, i, j, own, number, rep, copies = (rows[c].to_numpy() for c in ("lid", "i", "j", "own", "list", "rep", "copies"))
    units = units_of(whole(rows["embedding"]))
    pivots = whole(rows["pivots"]).flatten().to_numpy().reshape(len(rep), -1).astype(np.int64)
    cuts = np.flatnonzero((lid[1:] != lid[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    pairs = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for s, e in zip([0, *cuts], [*cuts, len(rep)]):
        m = s if i[s] == j[s] else s + int(np.count_nonzero(own[s:e] == i[s]))
        r, c = np.nonzero(units[s:e if m == s else m] @ units[m:e].T >= min_cos)
        if m == s:
            r, c = r[r < c], c[r < c]
        for at in range(0, len(r), 1 << 16):
            x, y = r[at:at + (1 << 16)] + s, c[at:at + (1 << 16)] + m
            mine = first_shared(pivots[x], pivots[y], base, shared) == number[s]
            pairs.append((x[mine], y[mine]))
    r, c = (np.concatenate(side) for side in zip(*pairs))
    links = np.bincount(r, copies[c], len(rep)) + np.bincount(c, copies[r], len(rep))
    root = rep.copy()
    while True:  # smallest rep over the links, until nothing moves
        before = root.copy()
        np.minimum.at(root, r, root[c])
        np.minimum.at(root, c, root[r])
        if (root == before).all():
            break
    some = links > 0
    return pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(links[some].astype(np.int64)), pa.array(root[some])],
                                      names=["rep", "links", "root"])


def embedding_links(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    min_cos: float = 0.98, top: int = 6, shared: int = 3, pivot_sample: int = 2048,
                    block: int = 500) -> DataFrame:
    """Link vectors of equal label whose cosine is ``min_cos`` or more.

    Exact copies are merged first.  A vector is described by its ``top``
    nearest pivots in order; inverted lists for every ``shared`` of them hold
    the vectors that have those pivots in common, so meeting in a list means a
    shared-pivot count of ``shared`` or more.  Lists with one vector are
    dropped before any vector travels; long ones are cut into blocks of about
    ``block``, and every pair of blocks is one bounded group whose cosines are
    verified in double precision: no list is too long, and none is cut short.
    The number of pivots grows with the square root of the vectors (64 to
    MAX_PIVOTS, which 268 million distinct vectors of a length reach), so that
    lists stay short.  They are fitted on about ``pivot_sample`` vectors, or
    four a pivot if that is more.  All vectors are indexed.

    Returns one row per input row: vec_id, n_links, component_id (smallest
    vec_id reachable, itself included), kept.  Vectors that are null, empty,
    zero or hold null or non-finite components, and rows with a null label,
    link with nothing; vectors of different length don't link; copies in
    identical rows count as other vectors; an empty table gives no rows;
    further columns are ignored."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = ~F.exists(x, lambda v: v != 0)
    rows = stored(df.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("vec_id"),
                            F.col(label_col).alias("label"), F.transform(F.col(vector_col).cast("array<double>"), lambda v: v + F.lit(0.0)).alias("embedding"))
                  .withColumn("hash", F.xxhash64("embedding"))
                  .withColumn("valid", F.coalesce(F.col("label").isNotNull() & x.isNotNull() & ~bad & ~zero, F.lit(False))),
                  "embed-rows")
    valid = rows.filter("valid")
    # Adding zero has made every zero positive, so equal vectors hash alike.
    merged = valid.groupBy("label", "hash", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"), F.min("rid").alias("rep"))
    reps = stored(merged.withColumn("dim", F.size("embedding")), "embed-reps")
    pivots = {}
    for dim, n in [tuple(r) for r in reps.groupBy("dim").count().collect()]:  # a row for each vector length
        count = int(min(MAX_PIVOTS, max(64, 2 ** np.ceil(np.log2(n ** 0.5)))))
        size = max(pivot_sample, 4 * count)
        picked = (reps.filter((F.col("dim") == dim) & (F.shiftrightunsigned(F.xxhash64("embedding"), 33) / float(1 << 31) < min(1.0, size / n)))
                  .select("embedding").limit(2 * size).toArrow())
        sample = units_of(whole(picked["embedding"])) if picked.num_rows else np.empty((0, dim))
        pivots[dim] = choose_pivots(sample[np.lexsort(sample.T[::-1])], max(count, top))
    base = max(map(len, pivots.values()), default=1)

    keys = ["label", "dim", "list"]
    filed = postings(stored(describe(reps, pivots, top), "embed-index"), base, top, shared)
    lists = stored(filed.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
                   .select(*keys, F.monotonically_increasing_id().alias("lid"), F.ceil(F.col("n") / block).cast("int").alias("blocks")), "embed-lists")
    # A member of block i goes to the pairs (i, j) of all blocks j.
    member = (filed.join(lists, keys).withColumn("own", F.expr("cast(pmod(xxhash64(rep), blocks) AS int)"))
              .select("dim", "lid", "list", "rep", "pivots", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
              .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")
              .join(reps.select("rep", "copies", "embedding"), "rep"))
    groups = ["dim", "lid", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for dim in pc.unique(rows["dim"]):
                yield verify(rows.filter(pc.equal(rows["dim"], dim)), base, shared, min_cos)

        rest = None  # rows of a group may lie in two batches
        for b in batches:
            new = pa.Table.from_batches([b])
            rest = new if rest is None else pa.concat_tables([rest, new])
            key = np.column_stack([rest[c].to_numpy() for c in groups])
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if len(cuts):
                yield from finish(rest.slice(0, cuts[-1]))
                rest = rest.slice(cuts[-1])
        if rest is not None:
            yield from finish(rest)

    found = stored(member.repartition(*groups).sortWithinPartitions(*groups, "own")
                   .mapInArrow(run, "rep long, links long, root long"), "embed-found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    each = stored(reps.select("rep", "label", "hash", "copies", "first").join(links, "rep", "left")
                  .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
                  .withColumn("component", F.coalesce("component", "rep")), "embed-each")
    least = each.groupBy("component").agg(F.min("first").alias("component_id"))
    each = stored(each.join(least, "component").select(
        "rep", "label", "hash", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "embed-result")
    # The hash finds a row's merged vector; should one hash stand for two
    # vectors of a label, the contents decide.
    key = ["label", "hash"]
    if not each.groupBy(*key).count().filter("count > 1").isEmpty():
        each, key = each.join(reps.select("rep", "embedding"), "rep"), [*key, "embedding"]
    linked = valid.join(each, key).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT valid").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
