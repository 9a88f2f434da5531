"""Centroid clustering against plain loops over whole numbers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from riskloom.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>, label int, cluster int, _id string, distance string"


def rows_of(spark, pairs):
    return spark.createDataFrame([(i, v, 1, 5, "x", None) for i, v in pairs], SCHEMA)


def plain(pairs, k=8, rounds=10, dimension=64, scale=1024):
    """(vec_id, cluster, distance), and the centroids, from Python integers alone."""
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in pairs
            if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v)]
    order = sorted(good, key=lambda p: (hashlib.sha256(f"3:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1]))
    centres = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = {}
        for _, v in good:
            own.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(c) // len(own[j]) for c in zip(*own[j])] if j in own else old for j, old in enumerate(centres)]
    return [(i, *nearest(v)[::-1]) for i, v in good], centres


def check(spark, pairs, **settings):
    got = centroids.centroid_clusters(rows_of(spark, pairs), **settings).collect()
    want, centres = plain(pairs, **settings)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in got], key=key) == sorted(want, key=key)
    for r in got:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()
    return got


def test_against_plain_loops(spark):
    rng = np.random.default_rng(2)
    pairs = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 64)) * 0.2)]
    assert len({r.cluster for r in check(spark, pairs)}) == 8


def test_ties_repeats_and_rows_left_out(spark):
    rng = np.random.default_rng(4)
    pairs = [(i, (rng.integers(0, 2, 64) / 1024).tolist()) for i in range(120)]
    pairs += [(7, pairs[7][1])] * 30 + [(None, pairs[8][1]), (None, pairs[9][1])] + [(500 + i, [0.0] * 64) for i in range(40)]
    bad = [None, [], [0.1] * 63, [0.1] * 65, [None] + [0.1] * 63, [math.nan] * 64, [math.inf] + [0.0] * 63, [1e306] * 64]
    check(spark, pairs + [(900 + i, v) for i, v in enumerate(bad)])


@pytest.mark.parametrize("size", [2.0**15, 1e5, 1e7, 1e60])
def test_large_components(spark, size):
    """Through doubles, longs and Python integers; sums and distances beyond a long are null."""
    rng = np.random.default_rng(5)
    pairs = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 4)) * size)]
    settings = dict(k=5, rounds=4, dimension=4)
    if size < 1e6:
        check(spark, pairs, **settings)
        return
    got = {r.vec_id: (r.cluster, r.distance, r.inertia) for r in centroids.centroid_clusters(rows_of(spark, pairs), **settings).collect()}
    want, _ = plain(pairs, **settings)
    assert got == {i: (c, d if d < 2**63 else None, None) for i, c, d in want}


def test_few_vectors_and_none(spark):
    assert len(check(spark, [(1, [0.5] * 64), (2, [0.25] * 64), (2, [0.25] * 64)])) == 3
    for pairs in ([], [(1, None)]):
        empty = centroids.centroid_clusters(rows_of(spark, pairs))
        assert empty.collect() == [] and empty.columns == [
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("spread,leaf", [(3, 1), (3, 4), (1000, 2), (2**30, 1), (2**70, 2)])
def test_tree_finds_the_smallest_number_at_the_smallest_distance(spread, leaf):
    rng = np.random.default_rng(6)
    whole = lambda n: np.floor(rng.random((n, 3)) * spread)
    centres = [[int(v) for v in c] for c in whole(40)]
    points = whole(300)
    number, squared = centroids.VantageTree(centres, leaf).nearest(points)
    for p, c, d in zip(points, number, squared):
        assert (d, c) == min((sum((int(a) - b) ** 2 for a, b in zip(p, centre)), j) for j, centre in enumerate(centres))


def test_tree_opens_few_nodes(monkeypatch):
    """Bounds leave most of a spread-out tree unopened."""
    rng = np.random.default_rng(7)
    centres = [[int(v) for v in c] for c in rng.integers(0, 100_000, (500, 2))]
    tree = centroids.VantageTree(centres)
    seen = []
    root = np.unique

    def counted(values, *a, **b):
        seen.append(len(values))
        return root(values, *a, **b)

    monkeypatch.setattr(centroids.np, "unique", counted)
    tree.nearest(np.floor(rng.random((200, 2)) * 100_000))
    assert sum(seen) < 0.2 * 200 * len(tree.nodes)


def test_all_equal_vectors(spark):
    got = check(spark, [(i, [0.125] * 64) for i in range(50)])
    assert {(r.cluster, r.distance) for r in got} == {(0, 0)}
