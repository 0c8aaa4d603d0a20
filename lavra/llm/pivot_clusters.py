"""Centroid clustering of integer vectors with a table of distances to fixed pivots.

Distances to a few pivots are computed once and stored beside every vector. In each round the
pivots' differences bound the distance to a centroid from below: |d(v, p) - d(c, p)| <= d(v, c).
Centroids are tried in the order of their bounds, and those whose bound is above the best
distance found so far are skipped; the others get exact integer distances. A task hands on the
sums of its vectors per centroid, so a round moves a few hundred numbers per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import bound_batches
from lavra.runtime import materialize

SCALE = 1024
DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
# Fixed pivots, chosen among so many vectors of smallest hash.
PIVOTS = 16
SAMPLE_ROWS = 1024

_LARGEST_LONG = (1 << 63) - 1
# Relative error allowed for in roots and squares of doubles; theirs is some 1e-16.
_SLACK = 1e-12
_HASH_DIGITS = 15


def component_bound(dims: int) -> int:
    """Integer components are below this, so that squared distances fit a long."""
    return 1 << ((62 - (dims - 1).bit_length()) // 2 - 1)


def integer_vectors(vectors: DataFrame, id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """`id` and `ints` (array<int>, floor(scale * x) with x as double) of the vectors that count.

    A vector counts if it has exactly `dims` components, none null, NaN or infinite, and all
    integers are below `component_bound` (2^27 for 64 of them, components of 131,072 at the
    scale 1,024), beyond which squared distances leave a long. Null vectors do not count.
    """
    whole = F.transform(vectors[vector], lambda x: F.lit(scale) * x.cast("double"))
    bound = float(component_bound(dims))
    fits = F.forall("ints", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < bound))
    return (
        vectors.select(vectors[id].alias("id"), whole.alias("ints"))
        .where((F.size("ints") == dims) & fits)
        .select("id", F.transform("ints", lambda x: F.floor(x).cast("int")).alias("ints"))
    )


def id_hash(id: Column, seed: int) -> Column:
    """Lowercase hexadecimal SHA-256 of `seed:id`; null for a null id."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), id.cast("string")), 256)


def first_by_hash(rows: DataFrame, total: int, most: int, seed: int) -> list[tuple[list, int]]:
    """The (`ints`, number of alike rows) of smallest hash, then of smallest `ints`: those of
    the `most` first distinct pairs of both. Rows without an id have no hash.

    Only rows below a threshold of the hash are sorted. It is raised until enough are below,
    so the result is that of sorting all rows, but no task gets `most` rows of every other.
    """
    hashed = rows.select(id_hash(F.col("id"), seed).alias("hash"), "ints")
    leading = F.conv(F.substring("hash", 1, _HASH_DIGITS), 16, 10).cast("bigint")
    every = 16**_HASH_DIGITS
    below = min(every, every * 4 * most // max(total, 1))
    while True:
        alike = hashed.where(leading < below).groupBy("hash", "ints").count()
        found = alike.orderBy("hash", "ints").limit(most).collect()
        if len(found) == most or below == every:
            return [(row["ints"], row["count"]) for row in found]
        below = min(every, below * 16)


def spread_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` distinct rows; each next one has the largest sum of distances to those
    before it, the earliest of equals."""
    chosen = [0]
    sums = np.zeros(len(sample))
    while len(chosen) < min(most, len(sample)):
        step = _roots(sample, sample[chosen[-1:]])[:, 0]
        sums += step
        sums[(sample == sample[chosen[-1]]).all(axis=1)] = -np.inf
        if sums.max() == -np.inf:
            break
        chosen.append(int(sums.argmax()))
    return sample[chosen]


def _squares(rows: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to the row of `other` (or to its only one)."""
    difference = rows - other
    return np.einsum("ij,ij->i", difference, difference)


def _roots(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distances of all rows to all others."""
    squares = [_squares(rows, one) for one in others]
    return np.sqrt(np.array(squares, np.float64).reshape(len(others), len(rows)).T)


def nearest(
    rows: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (the smaller number of equals), the exact squared distance,
    and how many exact distances were needed."""
    of_centroids = _roots(centroids, pivots)
    bounds = np.zeros((len(rows), len(centroids)))
    for p in range(len(pivots)):
        mine, theirs = to_pivots[:, p, None], of_centroids[None, :, p]
        gap = np.abs(mine - theirs) - _SLACK * (mine + theirs)
        np.maximum(bounds, gap, out=bounds)
    squares = bounds * bounds * (1 - _SLACK)
    order = np.argsort(squares, axis=1, kind="stable")
    best = np.full(len(rows), len(centroids), np.int64)
    distance = np.full(len(rows), _LARGEST_LONG, np.int64)
    left = np.arange(len(rows))
    exact = 0
    for place in range(len(centroids)):
        # Bounds ascend along `order`: a row that is done now stays done.
        left = left[squares[left, order[left, place]] <= distance[left]]
        if not len(left):
            break
        tried = order[left, place]
        found = _squares(rows[left], centroids[tried])
        exact += len(left)
        better = (found < distance[left]) | ((found == distance[left]) & (tried < best[left]))
        best[left[better]], distance[left[better]] = tried[better], found[better]
    return best, distance, exact


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind).reshape(len(column), width)


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """`rows` plus `to_pivots` (array<double>), the distances to all pivots."""
    fixed = rows.sparkSession.sparkContext.broadcast(pivots)

    @F.arrow_udf("array<double>")
    def distances(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = fixed.value
        for batch in batches:
            found = _roots(_matrix(batch, np.int64, own.shape[1]), own)
            offsets = np.arange(len(batch) + 1, dtype=np.int32) * len(own)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))

    return rows.withColumn("to_pivots", distances("ints"))


def _assignments(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray):
    """Per batch: the batch, its vectors, their clusters and squared distances."""
    for batch in batches:
        rows = _matrix(batch.column("ints"), np.int64, pivots.shape[1])
        to_pivots = _matrix(batch.column("to_pivots"), np.float64, len(pivots))
        best, distance, _ = nearest(rows, to_pivots, centroids, pivots)
        yield batch, rows, best, distance


def next_centroids(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of every centroid's vectors; one without any stays."""
    fixed = table.sparkSession.sparkContext.broadcast((centroids, pivots))
    dims = centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, reference = fixed.value
        total = np.zeros((len(own), dims + 1), np.int64)
        for _, rows, best, _ in _assignments(batches, own, reference):
            for cluster in np.unique(best):
                mine = rows[best == cluster]
                total[cluster, :dims] += mine.sum(axis=0)
                total[cluster, dims] += len(mine)
        cluster, part = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cluster, pa.int32()),
                pa.array(part, pa.int32()),
                pa.array(total[cluster, part], pa.int64()),
            ],
            names=["cluster", "part", "total"],
        )

    added = (
        table.select("ints", "to_pivots")
        .mapInArrow(sums, "cluster int, part int, total bigint")
        .groupBy("cluster", "part")
        .agg(F.sum("total").alias("total"))
    )
    total = np.zeros((len(centroids), dims + 1), np.int64)
    # At most one number per centroid and component.
    for row in added.collect():
        total[row["cluster"], row["part"]] = row["total"]
    counts = total[:, dims:]
    return np.where(counts > 0, total[:, :dims] // np.maximum(counts, 1), centroids)


def _assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    fixed = table.sparkSession.sparkContext.broadcast((centroids, pivots))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, best, distance in _assignments(batches, *fixed.value):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(best, pa.int32()), pa.array(distance, pa.int64())],
                names=["id", "cluster", "distance"],
            )

    kind = table.schema["id"].dataType.simpleString()
    return table.mapInArrow(assign, f"id {kind}, cluster int, distance bigint")


def cluster(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    dims: int = DIMS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """A row per vector that counts: `id`, `cluster`, `distance` (squared), `cluster_inertia`,
    `inertia` and `centroid_sha256` (of the final centroid's integers, joined by commas).

    Vectors become integers, see `integer_vectors`; others have no row. The first centroids are
    the vectors of smallest `id_hash`. Every round assigns all vectors to the nearest centroid
    (the smaller number of equals) and replaces each centroid that has vectors by the floor of
    their mean; a last assignment follows. All of this is exact integer arithmetic.

    Rows with one id tie in the hash and are ordered by their integers; each row counts, equal
    ones too. Rows without an id are clustered like others but are no first centroid. With
    fewer vectors than `clusters` there are that many centroids; with none, or with none that
    has an id, `cluster` and what depends on it are null. Sums beyond a long are null. No other
    column of `vectors` is read.
    """
    bound_batches(vectors.sparkSession)
    rows = integer_vectors(vectors, id, vector, dims, scale)
    sample = first_by_hash(rows, vectors.count(), max(SAMPLE_ROWS, clusters, pivots), seed)
    if not sample:
        nothing = {"cluster": "int", "distance": "bigint", "cluster_inertia": "bigint"}
        nothing |= {"inertia": "bigint", "centroid_sha256": "string"}
        empty = [F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()]
        return rows.select(F.col("id").alias(id), *empty)
    first = [ints for ints, alike in sample for _ in range(min(alike, clusters))][:clusters]
    fixed = spread_pivots(np.array([ints for ints, _ in sample], np.int64), pivots)
    table = materialize(pivot_table(rows, fixed), "pivot-table")
    centroids = np.array(first, np.int64)
    for _ in range(rounds):
        moved = next_centroids(table, centroids, fixed)
        # Centroids that stay where they are stay there in all later rounds.
        if (moved == centroids).all():
            break
        centroids = moved
    assigned = materialize(_assigned(table, centroids, fixed), "clusters")
    return _with_sums(assigned, centroids).withColumnRenamed("id", id)


def _with_sums(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Inertias and centroids' digests, a handful of literals, beside every vector."""
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {row["cluster"]: int(row["total"]) for row in
            assigned.groupBy("cluster").agg(exact.alias("total")).collect()}

    def long(value: int | None) -> Column:
        fits = value is not None and value <= _LARGEST_LONG
        return F.lit(value if fits else None).cast("bigint")

    digests = [
        hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()
    ]
    own = F.array(*[long(sums.get(number)) for number in range(len(centroids))])
    return assigned.select(
        "id",
        "cluster",
        "distance",
        F.get(own, F.col("cluster")).alias("cluster_inertia"),
        long(sum(sums.values())).alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"),
    )
