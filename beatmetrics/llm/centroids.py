"""Centroid clustering of integer vectors by a tournament of bisectors.

A vector x is nearer to centroid b than to a when it lies beyond the plane
halfway between them: 2 (b - a) x > |b|^2 - |a|^2.  The normals 2 (b - a) and
the thresholds of all pairs are computed once per round, in integers.  For each
vector the first centroid meets the second, the winner the third, and so on:
k - 1 linear sign tests leave one, and a side of zero favours the smaller
number.  Only the distance to that one is computed, exactly.

Every round is one job over a written table.  A task adds up its own vectors
per cluster, so that k rows per component leave it however many vectors a
cluster has; the driver sees k sums and counts per component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatmetrics.llm.common import ship, written

# Normals of all pairs stay under this size in every worker.
NORMALS_MAX_BYTES = 256 << 20
# Sums of products below this bound are exact in 64 bits.
EXACT = 1 << 62
ROWS_AT_ONCE = 4096
LONG_MAX = (1 << 63) - 1


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: as int64, or as Python's integers if they are large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * float(scale))
    if not scaled.size or np.abs(scaled).max() < 2.0**52:
        return scaled.astype(np.int64)
    exact = [math.floor(Fraction(v) * scale) for v in vectors.ravel().tolist()]
    return np.array(exact, object).reshape(vectors.shape)


def _largest(x: np.ndarray) -> int:
    return int(max(x.max(), -x.min())) if x.size else 0


class Bisectors:
    """Integer normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, object)
        self.largest = _largest(self.centroids)
        if self.largest < 1 << 31:
            self.centroids = self.centroids.astype(np.int64)
        self.k = len(centroids)
        first, second = np.triu_indices(self.k, 1)
        self.normals = 2 * (self.centroids[second] - self.centroids[first])
        squares = (self.centroids.astype(object) ** 2).sum(axis=1)
        thresholds = squares[second] - squares[first]
        small = not len(thresholds) or _largest(thresholds) < EXACT
        self.thresholds = thresholds.astype(np.int64) if small else thresholds

    def pair(self, smaller: np.ndarray, larger: int) -> np.ndarray:
        return smaller * (2 * self.k - smaller - 1) // 2 + larger - smaller - 1

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid and the squared distance to it."""
        width = x.shape[1] if x.ndim == 2 else 0
        if 4 * width * max(_largest(x), self.largest) ** 2 >= EXACT:
            x = x.astype(object)
        winner = np.zeros(len(x), np.int64)
        for rival in range(1, self.k):
            pair = self.pair(winner, rival)
            side = (self.normals[pair] * x).sum(axis=1) - self.thresholds[pair]
            winner = np.where((side > 0).astype(bool), rival, winner)
        apart = x - self.centroids[winner]
        return winner, (apart * apart).sum(axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, scale: int):
    """(ids, integer vectors) of a bounded number of rows each."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0), integers(flat.reshape(-1, dims), scale)


def _sums(kept: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> DataFrame:
    """Rows (cluster, dim, total, n): one per cluster and component, of all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        totals = np.full((len(centroids), dims), 0, object)
        counts = [0] * len(centroids)
        for _, x in _blocks(batches, dims, scale):
            winner, _ = bisectors.nearest(x)
            for c in np.unique(winner).tolist():
                own = x[winner == c]
                totals[c] += own.sum(axis=0).astype(object)
                counts[c] += len(own)
        full = [c for c, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([c for c in full for _ in range(dims)], pa.int32()),
                pa.array([d for _ in full for d in range(dims)], pa.int32()),
                pa.array(
                    [Decimal(int(totals[c][d])) for c in full for d in range(dims)],
                    pa.decimal128(38, 0),
                ),
                pa.array([counts[c] for c in full for _ in range(dims)], pa.int64()),
            ],
            names=["cluster", "dim", "total", "n"],
        )

    parts = kept.mapInArrow(run, "cluster int, dim int, total decimal(38,0), n long")
    return parts.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def _assigned(kept: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        for ids, x in _blocks(batches, dims, scale):
            winner, distance = bisectors.nearest(x)
            if _largest(distance) > LONG_MAX:
                raise ValueError("a squared distance is beyond the range of a long")
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(winner.astype(np.int32)), pa.array(distance.tolist(), pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return kept.mapInArrow(run, "vec_id long, cluster int, distance long")


def start_centroids(kept: DataFrame, k: int, dims: int, scale: int, seed: int) -> list[list[int]]:
    """The k vectors whose sha256 of ``seed:id`` is smallest; equal ids go by components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.where("vec_id IS NOT NULL").orderBy(digest, "vector").limit(k).collect()
    return [[int(v) for v in integers(np.array([r.vector]), scale)[0]] for r in rows]


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    dims: int = 64,
    seed: int = 3,
) -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Vectors become integers floor(scale * x).  The centroids start as the k
    vectors with the smallest hashes and are replaced ``rounds`` times by the
    componentwise floor of their vectors' mean; an empty one stays.  Equal
    distances go to the smaller number.

    A vector that is null, of another length than ``dims``, or holds a null or
    non-finite component is left out; other columns are ignored, whatever their
    names.  Repeated rows each count.  A row without an id is clustered but
    starts no centroid.  With fewer than k vectors there are as many centroids
    as vectors; an empty table gives an empty one.  All sums are exact; a
    squared distance beyond a long is an error, and so are more centroids than
    ``NORMALS_MAX_BYTES`` holds normals for.  The sum of the distances is null
    where it is beyond a long.
    """
    if k * (k - 1) // 2 * dims * 8 > NORMALS_MAX_BYTES:
        raise ValueError(f"the normals of {k} centroids are beyond {NORMALS_MAX_BYTES} bytes")
    spark = df.sparkSession
    ship(spark)
    vector = F.col("vector")
    infinite = float("inf")
    kept = written(
        df.select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        ).where(
            (F.size(vector) == dims)
            & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
        ),
        "integer-vectors",
    )
    centroids = start_centroids(kept, k, dims, scale, seed)
    for _ in range(rounds if centroids else 0):
        moved = [list(c) for c in centroids]
        for row in _sums(kept, centroids, dims, scale).collect():
            moved[row.cluster][row.dim] = int(row.total) // row.n
        if moved == centroids:
            break
        centroids = moved
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        empty = spark.createDataFrame([], schema)
        return (
            kept.where(F.lit(False))
            .select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
            .join(empty, "cluster")
            .select("vec_id", "cluster", "distance", *empty.columns[1:])
        )
    assigned = written(_assigned(kept, centroids, dims, scale), "clusters")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    inertia = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(exact).collect()}

    def as_long(total: int) -> int | None:
        return total if total <= LONG_MAX else None

    named = [
        (
            c,
            as_long(total),
            as_long(sum(inertia.values())),
            hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(),
        )
        for c, total in sorted(inertia.items())
    ]
    # At most k rows.
    return assigned.join(F.broadcast(spark.createDataFrame(named, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
