"""Centroid clustering with the threshold algorithm.

Each vector looks for its nearest centroid as in a search over sorted lists: per dimension the centroids lie in the order
of their values, and the list is walked outward from the vector's own value, nearest entry first. A centroid met for the
first time is measured exactly. The squared gaps at the frontiers of all lists add up to the least squared distance that
any centroid not yet met can have; the walk ends once that sum is strictly more than the best exact distance, so that
centroids at the same distance are all met and the smaller number wins.

A round is one job: tasks assign their vectors and return, per centroid, a count and sums of components; these are added
up in Spark. Only centroids (``k`` vectors) reach the driver. All arithmetic is in whole numbers.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import Scratch

#: largest magnitude of a scaled component: squared distances of 64 such components still fit a long
LARGEST = 1 << 27
ROWS = 4096  # vectors looked at together


class SortedLists:
    """Per dimension the centroids' values in ascending order, and whose they are."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.owner = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.owner, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance, centroids measured) of each vector."""
        k, width = self.centroids.shape
        rows = len(vectors)
        best = np.full(rows, np.iinfo(np.int64).max)
        number = np.zeros(rows, np.int64)
        seen = np.zeros((rows, k), bool)
        # entries of each list that lie just below and just above the vector's value
        above = np.stack([np.searchsorted(self.values[:, d], vectors[:, d]) for d in range(width)], axis=1) if width else np.zeros((rows, 0), np.int64)
        below = above - 1
        active = np.arange(rows)
        lists = np.arange(width)[None, :]
        far = np.int64(LARGEST) * 4
        for _ in range(max(k, 1)):
            x, lo, hi = vectors[active], below[active], above[active]
            down = np.where(lo >= 0, x - self.values[np.maximum(lo, 0), lists], far)
            up = np.where(hi < k, self.values[np.minimum(hi, k - 1), lists] - x, far)
            take_down = down <= up
            met = self.owner[np.where(take_down, lo, np.minimum(hi, k - 1)), lists]
            fresh = np.zeros((len(active), k), bool)
            fresh[np.arange(len(active))[:, None], met] = True
            if not width:  # vectors without components are at distance 0 from all
                fresh[:] = True
            fresh &= ~seen[active]
            seen[active] |= fresh
            at, of = np.nonzero(fresh)
            exact = np.full((len(active), k), np.iinfo(np.int64).max)
            exact[at, of] = ((x[at] - self.centroids[of]) ** 2).sum(axis=1)
            first = exact.argmin(axis=1)  # of equal ones the smaller number
            least = exact[np.arange(len(active)), first]
            better = (least < best[active]) | ((least == best[active]) & (first < number[active]))
            best[active[better]], number[active[better]] = least[better], first[better]
            below[active] = lo - take_down
            above[active] = hi + ~take_down
            frontier = (np.where(take_down, down, up) ** 2).sum(axis=1)
            active = active[(frontier <= best[active]) & ~seen[active].all(axis=1)]
            if not len(active):
                break
        return number, best, seen.sum(axis=1)


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _blocks(batch: pa.RecordBatch, at: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for first in range(0, batch.num_rows, ROWS):
        yield first, _vectors(batch.column(at).slice(first, ROWS), width)


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, width: int, scale: int) -> DataFrame:
    """(id, v): vectors of ``width`` finite components, each as floor(scale * x)."""
    x = F.col(vector_column)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) <= LARGEST))
    kept = vectors.where(x.isNotNull() & (F.size(x) == width)).where(F.coalesce(sound, F.lit(False)))
    return kept.select(F.col(id_column).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``<seed>:<id>``; rows without an id come last, equal ids by components."""
    digest: Column = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    drawn = rows.select(digest.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([row.v for row in drawn], np.int64)


def updated(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floor of the mean of its vectors; one without vectors stays."""
    k, width = centroids.shape

    def add_up(batches):
        lists = SortedLists(centroids)
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        pending = 0
        for batch in batches:
            for _, some in _blocks(batch, 0, width):
                number, _, _ = lists.nearest(some)
                order = np.argsort(number, kind="stable")
                filled, begins = np.unique(number[order], return_index=True)
                sums[filled] += np.add.reduceat(some[order], begins, axis=0)
                counts += np.bincount(number, minlength=k)
                pending += len(some)
                if pending >= 1 << 33:  # long before a sum could leave 64 bits
                    yield _partial(sums, counts)
                    sums, counts, pending = np.zeros_like(sums), np.zeros_like(counts), 0
        if pending:
            yield _partial(sums, counts)

    partial = rows.select("v").mapInArrow(add_up, "cluster int, n long, s array<long>")
    by_place = partial.select("cluster", "n", F.posexplode("s").alias("place", "x")).groupBy("cluster", "place")
    whole = by_place.agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = centroids.copy()
    for cluster, place, n, total in whole.collect():  # k times width numbers
        out[cluster, place] = int(total) // n
    return out


def _partial(sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    filled = np.flatnonzero(counts)
    return pa.record_batch([pa.array(filled.astype(np.int32)), pa.array(counts[filled]), pa.array(sums[filled].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "s"])


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance, measured) of each vector; measured: how many centroids the walk had to measure."""
    width = centroids.shape[1]

    def assign(batches):
        lists = SortedLists(centroids)
        for batch in batches:
            for first, some in _blocks(batch, 1, width):
                number, best, measured = lists.nearest(some)
                yield pa.record_batch(
                    [batch.column(0).slice(first, len(some)), pa.array(number.astype(np.int32)), pa.array(best), pa.array(measured.astype(np.int32))],
                    ["id", "cluster", "distance", "measured"],
                )

    return rows.select("id", "v").mapInArrow(assign, "id long, cluster int, distance long, measured int")


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    width: int = 64,
    scale: int = 64,
    seed: int = 1,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance, measured) of every vector taken, centroids) after ``rounds`` rounds and a last assignment.

    Vectors that are null, have another number of components than ``width``, or hold null, non-finite or (beyond
    ``LARGEST`` after scaling) immense components take no part. Components become floor(scale * x), x as double. The
    first centroids are the vectors with the smallest sha256 of ``<seed>:<id>`` (rows without an id last, rows of one id
    by their components); with fewer than ``k`` vectors there are as many centroids. Of centroids at equal distance that
    with the smaller number is taken. Repeated rows count one by one and rows without an id as any other. An empty table
    gives an empty result and no centroids. Only the two named columns are read.
    """
    scratch = Scratch(vectors.sparkSession, "centroids")
    rows = scratch.settle(whole_vectors(vectors, id_column, vector_column, width, scale), "vectors")
    centroids = first_centroids(rows, k, seed).reshape(-1, width)
    if not len(centroids):
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).alias("measured")).limit(0), centroids
    for _ in range(rounds):
        centroids = updated(rows, centroids)
    return scratch.settle(assigned(rows, centroids), "assigned"), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray, id_column: str = "vec_id") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) from the result of ``cluster_vectors``.

    The digest is that of the centroid's components in decimal, joined by commas. Inertias add up squared distances.
    """
    spark = found.sparkSession
    own = {row.cluster: int(row.own) for row in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()}
    total = sum(own.values())
    facts = [(n, own[n], total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for n, c in enumerate(centroids.tolist()) if n in own]
    names = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    rows = found.join(F.broadcast(names), "cluster")  # a row for each centroid
    return rows.select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
