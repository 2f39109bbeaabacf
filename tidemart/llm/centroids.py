"""Centroid clustering over persisted exact dot products."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Components beyond this make squared distances that no long holds.
MOST = 1 << 26


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel(), kind))


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """The rows that can be clustered, as vec_id and v = floor(scale * x)."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = df.filter((F.size(x) == dim) & ~bad).select(F.col(id_col).alias("vec_id"), x.alias("x"))
    big = F.exists("x", lambda c: F.abs(c * scale) > MOST)
    whole = F.transform("x", lambda c: F.floor(c * scale).cast("int"))
    return fine.select("vec_id", F.when(big, F.raise_error(F.lit(f"a component is over {MOST / scale:g}: its distances fit no long")))
                       .otherwise(whole).alias("v"))


def first_centroids(vectors: DataFrame, count: int, seed: str) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``<seed>:<vec_id>``, by hash;
    equal ids by their components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return [list(r.v) for r in vectors.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(count).collect()]


def assign(state: DataFrame, before: Sequence[Sequence[int]], after: Sequence[Sequence[int]]) -> DataFrame:
    """Carry the dot products from the centroids ``before`` to ``after`` and
    name each vector's nearest one.

    A product changes by the vector's components times the change of the
    centroid, so only components that a centroid moved in are touched; the
    squared distance is |v|^2 - 2 v.c + |c|^2, all in exact integers.  Ties
    take the smaller number.  ``state`` without ``dots`` begins at zero."""
    new = np.array(after, np.int64)
    delta = new - np.array(before, np.int64)
    moved = [np.flatnonzero(d) for d in delta]
    norms, dim = (new * new).sum(axis=1), new.shape[1]
    fresh = "dots" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column("v"), dim).astype(np.int64)
            dots = np.zeros((len(v), len(new)), np.int64) if fresh else _matrix(b.column("dots"), len(new)).copy()
            for c, places in enumerate(moved):
                if len(places):
                    dots[:, c] += v[:, places] @ delta[c, places]
            distance = (v * v).sum(axis=1)[:, None] - 2 * dots + norms
            nearest = distance.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), _lists(dots, pa.int64()), pa.array(nearest, pa.int32()),
                 pa.array(distance[np.arange(len(v)), nearest], pa.int64())],
                names=["vec_id", "v", "dots", "cluster", "distance"])

    kind = state.schema["vec_id"].dataType.simpleString()
    columns = ["vec_id", "v"] if fresh else ["vec_id", "v", "dots"]
    return state.select(*columns).mapInArrow(run, f"vec_id {kind}, v array<int>, dots array<long>, cluster int, distance long")


def moved_centroids(state: DataFrame, centroids: Sequence[Sequence[int]]) -> list[list[int]]:
    """Each centroid as the floor of its vectors' mean; empty ones stay.  The
    sums are combined in the map tasks, so a cluster with most of the rows is
    no hot spot; one row for each cluster reaches the driver."""
    out = [list(c) for c in centroids]
    sums = [F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(len(out[0]))]
    for r in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        out[r["cluster"]] = [s // r["n"] for s in r[2:]]
    return out


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, count: int = 16,
            rounds: int = 3, scale: int = 64, seed: str = "1") -> tuple[DataFrame, list[list[int]]]:
    """Cluster vectors around ``count`` integer centroids.

    Every vector keeps its integer components and its exact dot product with
    each centroid in a stored table.  A round updates the products by what the
    centroids moved, takes the smallest distance and replaces each centroid by
    the floor of its vectors' mean; after the last round the vectors are
    assigned once more.  A round is one pass without a shuffle; what the tasks
    get and the driver collects is ``count`` times ``dim`` integers.

    Returns one row for each clustered vector (vec_id, v, dots, cluster,
    distance) and the final centroids.  Vectors that are null, of another
    length or hold null or non-finite components have no row; a component
    over ``MOST / scale`` raises an error, as its distances fit no long.  Rows
    with equal ids are vectors of their own, a null id hashes as an empty one;
    with fewer vectors than ``count`` there are fewer centroids; an empty
    table gives no rows; further columns are ignored."""
    state = stored(integer_vectors(df, id_col, vector_col, dim, scale), "centroid-vectors")
    centroids = first_centroids(state, count, seed)
    if not centroids:
        kind = state.schema["vec_id"].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"vec_id {kind}, v array<int>, dots array<long>, cluster int, distance long"), []
    before = [[0] * dim for _ in centroids]
    for _ in range(rounds):
        state = stored(assign(state, before, centroids), "centroid-state")
        before, centroids = centroids, moved_centroids(state, centroids)
    return stored(assign(state, before, centroids), "centroid-state"), centroids
