"""Vectors grouped around centroids, the nearest one found by the threshold algorithm.

Components become whole numbers, so sums, means and distances are exact and no result depends on the order of
rows. For every dimension the centroids stand in a list sorted by that component. From a vector's value each list
is walked outward, the nearer end first; a centroid met for the first time has its distance worked out in full.
A centroid not yet met lies in every dimension at least as far off as that list's frontier: once the sum of the
squared frontier distances strictly exceeds the best distance, no centroid left can win, nor tie.

A round is one pass over the vectors: each task adds up its vectors by centroid and sends one row per centroid
and dimension; the centroids alone (k times dims numbers, both parameters) reach the driver and travel with the
next pass.

Meaning of odd input: vectors of another length, null, or with a null or non-finite component are left out; a
null id counts as an empty text where first centroids are drawn and stays null in the result; repeated rows count
each for itself, and among rows of one id the smaller components come first; with fewer vectors than centroids
each is one; components beyond 2**56 stand at 2**56; a sum or distance that no long holds is null; no vectors give
no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.llm.graph import stored
from transitloom.llm.rows import small_batches

#: Whole numbers per unit of a component.
SCALE = 64
#: The largest component; above SMALL a task calculates with unbounded integers.
LARGEST, SMALL = 1 << 56, 1 << 24


def usable(vector: str, dims: int) -> Column:
    """Whether a vector has the given length and only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def whole_components(vectors: DataFrame, dims: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(_id, x): usable vectors in whole numbers."""
    def whole(x: Column) -> Column:
        return F.least(F.greatest(F.floor(x.cast("double") * SCALE), F.lit(-LARGEST)), F.lit(LARGEST))

    return vectors.select(F.col(vec_id).alias("_id"), F.col(vector).alias("v")).filter(usable("v", dims)).select(
        "_id", F.transform("v", whole).alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose ids hash to the smallest values."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    return [r[0] for r in rows.select("x", F.sha2(name, 256).alias("h")).orderBy("h", "x").limit(k).select("x").collect()]


class Lists:
    """The centroids sorted by each component, and the walk along them."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.exact = max((abs(v) for c in centroids for v in c), default=0) >= SMALL
        self.centroids = np.array(centroids, dtype=object if self.exact else np.int64).reshape(len(centroids), -1)
        self.order = np.argsort(self.centroids, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row and its squared distance; of equally near ones the smallest number."""
        if len(x) and (self.exact or np.abs(x).max() >= SMALL):
            x, centroids, values, none = x.astype(object), self.centroids.astype(object), self.sorted.astype(object), 1 << 62
        else:
            centroids, values, none = self.centroids, self.sorted, 1 << 30
        k, dims = centroids.shape
        left = np.stack([np.searchsorted(values[:, d], x[:, d]) for d in range(dims)], axis=1) - 1
        right = left + 1
        column = np.arange(dims)
        seen = np.zeros((len(x), k), dtype=bool)
        number = np.zeros(len(x), dtype=np.int64)
        best = np.full(len(x), -1, dtype=x.dtype)  # none met yet
        open_ = np.arange(len(x))
        for _ in range(k):
            if not len(open_):
                break
            at, l, r = x[open_], left[open_], right[open_]
            below = np.where(l >= 0, at - values[np.maximum(l, 0), column], none)
            above = np.where(r < k, values[np.minimum(r, k - 1), column] - at, none)
            go_left = below <= above
            met = self.order[np.where(go_left, l, np.minimum(r, k - 1)), column]
            left[open_], right[open_] = l - go_left, r + ~go_left
            new = np.zeros((len(open_), k), dtype=bool)
            new[np.arange(len(open_))[:, None], met] = True
            new &= ~seen[open_]
            seen[open_] |= new
            row, which = np.nonzero(new)
            away = ((at[row] - centroids[which]) ** 2).sum(axis=1)
            for c in range(k):  # ascending, so that the smaller number keeps a tie
                mine = which == c
                rows, d = open_[row[mine]], away[mine]
                better = (best[rows] < 0) | (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
                best[rows[better]], number[rows[better]] = d[better], c
            frontier = (np.where(go_left, below, above) ** 2).sum(axis=1)
            open_ = open_[(frontier <= best[open_]).astype(bool)]
        return number, best


def _rows(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, dim, total, n): componentwise sums of the vectors nearest to each centroid."""
    k, dims = len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        total, n = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = _rows(batch, dims)
            number, _ = lists.nearest(x)
            for c in np.unique(number):
                mine = x[number == c]
                total[c] += mine.sum(axis=0, dtype=object if np.abs(mine).max() >= SMALL else np.int64).astype(object)
                n[c] += len(mine)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(used, dims), pa.int32()), pa.array(np.tile(np.arange(dims), len(used)), pa.int32()),
            pa.array([int(v) for v in total[used].ravel()], pa.decimal128(38, 0)), pa.array(np.repeat(n[used], dims)),
        ], ["cluster", "dim", "total", "n"])

    parts = rows.select("x").mapInArrow(run, "cluster int, dim int, total decimal(38,0), n long")
    return parts.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: every centroid at the floor of its vectors' mean; one without vectors stays."""
    out = [list(c) for c in centroids]
    for r in _sums(rows, centroids).collect():  # k * dims numbers
        out[r["cluster"]][r["dim"]] = int(r["total"]) // r["n"]
    return out


def assigned(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(_id, cluster, distance): the nearest centroid of every vector."""
    dims = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for batch in batches:
            number, distance = lists.nearest(_rows(batch, dims))
            yield pa.RecordBatch.from_arrays([
                batch.column("_id"), pa.array(number, pa.int32()), pa.array([int(d) for d in distance], pa.decimal128(38, 0)),
            ], ["_id", "cluster", "distance"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, cluster int, distance decimal(38,0)")


def cluster(vectors: DataFrame, dims: int = 64, k: int = 16, rounds: int = 3, seed: int = 1,
            vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every usable vector after some rounds.

    ``distance`` is squared; the inertias are its sums over the cluster and over all vectors.
    """
    if min(dims, k) < 1 or rounds < 0:
        raise ValueError("dims and k must be positive, rounds not negative")
    spark = vectors.sparkSession
    small_batches(spark, rows=2000)
    rows = whole_components(vectors, dims, vec_id, vector)
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(rows, centroids)
    found = stored(assigned(rows, centroids or [[0] * dims]), "clusters")
    sums = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(F.try_sum("distance").alias("total")).collect()}  # k rows
    whole = None if None in sums.values() else sum(sums.values())
    around = spark.createDataFrame(
        [(c, _long(sums[c]), _long(whole), centroids[c]) for c in sorted(sums)],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return found.join(F.broadcast(around), "cluster").select(  # at most k rows
        F.col("_id").alias(vec_id), "cluster", F.expr("try_cast(distance as bigint)").alias("distance"),
        "cluster_inertia", "inertia", "centroid")


def _long(value) -> int | None:
    return int(value) if value is not None and value < 1 << 63 else None
