"""Clustering against plain exact arithmetic."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from lavra.llm import pivot_clusters

SCHEMA = "vec_id bigint, embedding array<float>, cluster string"


def plain(rows, clusters=8, rounds=10, seed=3):
    """The same rounds over all pairs, in Python's integers."""
    kept = [
        (key, [math.floor(1024 * x) for x in vector])
        for key, vector in rows
        if vector is not None
        and len(vector) == 64
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    hashed = [(hashlib.sha256(f"{seed}:{k}".encode()).hexdigest(), z) for k, z in kept if k is not None]
    centroids = [z for _, z in sorted(hashed)[:clusters]]

    def assign():
        return [
            min((sum((a - b) ** 2 for a, b in zip(z, c, strict=True)), i) for i, c in enumerate(centroids))
            for _, z in kept
        ]

    for _ in range(rounds):
        found = assign()
        for i in range(len(centroids)):
            mine = [z for (_, z), (_, at) in zip(kept, found, strict=True) if at == i]
            if mine:
                centroids[i] = [sum(part) // len(mine) for part in zip(*mine, strict=True)]
    found = assign()
    sums = [sum(d for d, at in found if at == i) for i in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = sum(sums) if sum(sums) < 2**63 else None
    return sorted(
        ((k, at, d, sums[at], inertia, digests[at]) for (k, _), (d, at) in zip(kept, found, strict=True)),
        key=str,
    )


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def as_float(vector):
    return [None if x is None else float(np.float32(x)) for x in vector]


@pytest.fixture
def vectors(table):
    def make(rows):
        return table(SCHEMA, *[(key, vector, "clash") for key, vector in rows])

    return make


@pytest.mark.parametrize("spread, seed", [(0.05, 1), (1.0, 2), (0.0, 3)])
def test_equals_plain_rounds(vectors, spread, seed):
    """Clustered, unstructured and equal vectors, with a hot group of copies."""
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [
        (i, as_float([x + draw.gauss(0, spread) for x in draw.choice(centres)])) for i in range(120)
    ]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    assert found(pivot_clusters.cluster(vectors(rows))) == plain(rows)


def test_rows_that_do_not_count_and_repeated_ids(vectors):
    draw = random.Random(4)

    def vector(n=64):
        return as_float([draw.gauss(0, 1) for _ in range(n)])

    rows = [(i // 3, vector()) for i in range(30)]
    rows += [rows[0]] * 3 + [(None, vector()), (None, vector())]
    bad = [(50, None), (51, []), (52, vector(63)), (53, vector(65)), (54, [None, *vector(63)])]
    bad += [(55, [float("nan"), *vector(63)]), (56, [float("-inf"), *vector(63)])]
    large = [(57, [131072.0, *vector(63)])]
    assert found(pivot_clusters.cluster(vectors(rows + bad + large))) == plain(rows + bad)


def test_largest_components(vectors):
    edge = 131071.0
    rows = [(i, [edge if (i >> (j % 5)) & 1 else -edge for j in range(64)]) for i in range(32)]
    assert found(pivot_clusters.cluster(vectors(rows))) == plain(rows)


def test_few_vectors_and_none(vectors):
    rows = [(i, [float(i == j) for j in range(64)]) for i in range(3)]
    assert found(pivot_clusters.cluster(vectors(rows))) == plain(rows)
    assert found(pivot_clusters.cluster(vectors([]))) == []
    nameless = [(None, rows[0][1])]
    assert found(pivot_clusters.cluster(vectors(nameless))) == [(None,) * 6]


def test_bounds_skip_centroids():
    """On clustered vectors most exact distances are not needed; ties go to the smaller number."""
    draw = np.random.default_rng(5)
    centroids = draw.integers(-1000, 1000, (8, 64))
    rows = (centroids[draw.integers(0, 8, 500)] + draw.integers(-20, 20, (500, 64))).astype(np.int64)
    pivots = pivot_clusters.spread_pivots(rows, 16)
    to_pivots = pivot_clusters._roots(rows, pivots)
    best, distance, exact = pivot_clusters.nearest(rows, to_pivots, centroids, pivots)
    every = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert exact < 2 * len(rows)
    twice = np.concatenate([centroids, centroids])
    assert pivot_clusters.nearest(rows, to_pivots, twice, pivots)[0].max() < 8


def test_first_by_hash_raises_its_threshold(vectors, monkeypatch):
    rows = [(i, [float(i)] * 64) for i in range(40)]
    kept = pivot_clusters.integer_vectors(vectors(rows), "vec_id", "embedding", 64, 1024)
    ordered = sorted(rows, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())
    first = pivot_clusters.first_by_hash(kept, 10**9, 5, 3)
    assert [ints[0] for ints, _ in first] == [1024 * r[0] for r in ordered[:5]]
