import hashlib
import random

import numpy as np

from payguard.llm import centroids

from .helpers import SMOKE


def brute(rows, clusters=16, rounds=3):
    """Assignments by measuring every centroid, in Python integers."""
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    cents = [list(c) for _, c in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for k in set(at):
            own = [v for (_, v), a in zip(kept, at) if a == k]
            cents[k] = [sum(col) // len(own) for col in zip(*own)]
    got = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in got)
    by = {k: sum(d for _, d, kk in got if kk == k) for _, _, k in got}
    return sorted(((i, k, d, by[k], total, hashlib.sha256(",".join(map(str, cents[k])).encode()).hexdigest()) for i, d, k in got), key=str)


def test_given_vectors_as_brute_force(spark):
    df = spark.read.parquet(f"{SMOKE}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()])
    assert sorted((tuple(r) for r in centroids.cluster(df).collect()), key=str) == want


def test_awkward_vectors(spark):
    rng = random.Random(3)
    v = lambda: [rng.choice((-1.0, -0.5, 0.0, 0.25, 1.0)) for _ in range(64)]
    same = v()
    rows = [(i, v()) for i in range(60)] + [(100 + i, same) for i in range(40)] + [(7, v()), (7, same), (None, v()), (None, None), (200, None), (201, []),
            (202, v()[:63]), (203, [None] + v()[1:]), (204, [float("nan")] + v()[1:]), (205, [float("inf")] + v()[1:]), (206, [-0.001] * 64)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "'x' AS cluster", "1 AS c", "2 AS distance")
    got = sorted((tuple(r) for r in centroids.cluster(df.repartition(5)).collect()), key=str)
    assert got == brute(rows)
    assert len({r[1] for r in got if 100 <= (r[0] or 0) < 140}) == 1


def test_few_and_none(spark):
    df = spark.createDataFrame([(1, [0.5] * 64), (2, [0.25] * 64), (3, None)], "vec_id int, embedding array<float>")
    assert sorted((r["vec_id"], r["distance"]) for r in centroids.cluster(df).collect()) == [(1, 0), (2, 0)]
    got = centroids.cluster(df.filter("vec_id > 2"))
    assert got.count() == 0 and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_search_measures_fewer_than_all():
    rng = np.random.default_rng(1)
    c = rng.integers(-1000, 1000, (64, 8))
    x = np.repeat(c, 50, axis=0) + rng.integers(-20, 20, (3200, 8))
    best, dist, measured = centroids.orchard(x, c, *centroids.lists(c))
    every = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (dist == every.min(1)).all() and measured < 0.7 * every.size


def test_ties_go_to_the_smaller_number():
    c = np.array([[4, 0], [0, 0], [2, 2], [2, -2]])
    best, dist, _ = centroids.orchard(np.array([[2, 0]]), c, *centroids.lists(c))
    assert (best[0], dist[0]) == (0, 4)
