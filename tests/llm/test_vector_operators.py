"""Centroid clustering and exact top-k search against brute force in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from beatmetrics.llm import topk
from beatmetrics.llm.centroids import Bisectors, cluster, integers
from beatmetrics.llm.topk import Shard, top_k

SCHEMA = "vec_id long, embedding array<double>, cluster int, vector string, row long"


def odd_rows(width, n, seed=5, large=1.0):
    """Vectors in groups, copies, ties, repeated and absent ids, and rows that take no part."""
    chance = random.Random(seed)
    centres = [[chance.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(n):
        centre = chance.choice(centres)
        rows.append((i, [large * (c + chance.gauss(0, 0.2)) for c in centre]))
    rows += [(i, rows[3][1]) for i in (3, 1000, 1050, 1100)] + [(None, rows[4][1]), (1150, rows[5][1])]
    rows += [(1200, [0.0] * width), (1250, None), (1300, [None] + [0.5] * (width - 1))]
    rows += [(1350, [math.nan] * width), (1400, [math.inf] * width), (1450, [1.0]), (1500, [])]
    return [(i, v, 7, "own", None) for i, v in rows]


def floors(vector, scale):
    return [math.floor(scale * x) for x in vector]


def usable(vector, width):
    return (
        vector is not None
        and len(vector) == width
        and all(x is not None and math.isfinite(x) for x in vector)
    )


def brute_clusters(rows, k, rounds, scale, width, seed):
    kept = [(i, v, floors(v, scale)) for i, v, *_ in rows if usable(v, width)]
    hashed = sorted(
        (hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v, x) for i, v, x in kept if i is not None
    )
    centroids = [x for _, _, x in hashed[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, _, x in kept:
            own[nearest(x)[1]].append(x)
        centroids = [
            [sum(c) // len(xs) for c in zip(*xs)] if xs else old for xs, old in zip(own, centroids)
        ]
    found = [(i, *nearest(x)) for i, _, x in kept]
    inertia = [sum(d for _, d, c in found if c == n) for n in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        [(i, c, d, inertia[c], sum(inertia), digests[c]) for i, d, c in found], key=str
    )


@pytest.mark.parametrize("width,n,k,large", [(6, 200, 8, 1.0), (6, 12, 30, 1.0), (4, 60, 3, 100_000.0)])
def test_clusters_equal_brute_force(spark, width, n, k, large):
    rows = odd_rows(width, n, large=large)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = cluster(df, k=k, rounds=6, dims=width)
    assert found.columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    ]
    assert sorted(map(tuple, found.collect()), key=str) == brute_clusters(rows, k, 6, 1024, width, 3)


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cluster(df).collect() == []
    assert cluster(df).columns[-1] == "centroid_sha256"
    none = spark.createDataFrame([(1, [0.5] * 3, 1, "", 1), (2, None, 1, "", 1)], SCHEMA)
    assert cluster(none).collect() == []
    with pytest.raises(ValueError):
        cluster(df, k=100_000)


def test_tournament_keeps_the_smaller_number_on_a_tie():
    found, distance = Bisectors([[4, 0], [0, 0], [4, 0], [0, 4]]).nearest(
        np.array([[2, 0], [0, 2], [4, 0], [9, 9], [2, 2]])
    )
    assert found.tolist() == [0, 1, 0, 0, 0] and distance.tolist() == [4, 4, 0, 106, 8]
    huge = np.array([[10**30, -(10**30)], [0, 1]], object)
    found, distance = Bisectors([[10**30, 0], [0, 0]]).nearest(huge)
    assert found.tolist() == [0, 1] and distance.tolist() == [10**60, 1]


def test_integers_are_exact():
    x = np.array([[0.1, -0.1, 1e17], [2.0**60 + 2048, -1e300, 0.0]])
    assert integers(x, 1024).tolist() == [[math.floor(v * 1024) if abs(v) < 1 else int(v) * 1024 for v in r] for r in x.tolist()]


def brute_top(rows, k, every, scale):
    kept = [(n, i, floors(v, scale)) for n, (i, v, *_) in enumerate(rows) if v is not None and usable(v, len(v))]
    out = []
    for n, i, q in kept:
        if i is None or i % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, x)), j is None, j or 0)
            for m, j, x in kept
            if m != n and len(x) == len(q)
        )
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scored[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("limits,large", [(None, 1.0), ((4, 7, 20), 1.0), ((4, 3, 50), 1e6), ((8, 5, 40), 3e9)])
def test_top_k_equals_brute_force(spark, monkeypatch, limits, large):
    """In one shard and in many, in each of the types that scores are computed in."""
    if limits:
        monkeypatch.setattr(topk, "BLOCK", limits[0])
        monkeypatch.setattr(topk, "TILE", limits[1])
        monkeypatch.setattr(topk, "SHARD_ROWS", (limits[2], limits[2]))
    width = 6 if large < 1e9 else 1
    rows = odd_rows(width, 260, seed=8, large=large / 1000 if large > 1e8 else large)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = top_k(df, every=10)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_top(rows, 5, 10, 256)


def test_top_k_of_few_rows(spark):
    assert top_k(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(50, [1.0, 2.0], 1, "", 1)], SCHEMA)
    assert top_k(one).collect() == []
    two = spark.createDataFrame([(50, [1.0, 2.0], 1, "", 1), (7, [1.0, -2.0], 1, "", 1)], SCHEMA)
    assert list(map(tuple, top_k(two).collect())) == [(50, 1, 7, 65536 - 262144)]


def test_blocks_below_the_kth_score_are_not_scored():
    """Rows in tight groups: the search of a query touches few blocks."""
    chance = np.random.default_rng(2)
    centres = chance.normal(0, 100, (64, 16))
    x = np.floor(np.repeat(centres, topk.BLOCK, axis=0) + chance.normal(0, 1, (64 * topk.BLOCK, 16)))
    ids = np.arange(len(x))
    shard = Shard(ids, ids, x)
    scored = []
    real = np.matmul

    def counted(a, b, **options):
        scored.append(len(a))
        return real(a, b, **options)

    topk.np.matmul, own = counted, topk.np.matmul
    try:
        best, found, _ = shard.search(ids[::97], x[::97], [None] * len(ids[::97]), 5)
    finally:
        topk.np.matmul = own
    assert sum(scored) < 3 * len(ids[::97])
    for q, scores in zip(ids[::97], best):
        every = np.delete(x @ x[q], q)
        assert sorted(every)[-5:][::-1] == scores.tolist()
