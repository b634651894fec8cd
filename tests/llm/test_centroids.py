import hashlib
import math

import numpy as np
import pytest
from navloom.llm import centroids, queries

TYPE = "vec_id long, embedding array<float>, label int, cluster int, v string"


def vectors(n, seed=3):
    rng = np.random.default_rng(seed)
    return [[float(np.float32(x)) for x in rng.normal(0, 0.2, 64)] for _ in range(n)]


def brute(rows, clusters=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if e and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in order[:clusters]]
    for step in range(rounds + 1):
        nearest = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centers)) for _, v in kept]
        if step == rounds:
            break
        for j in range(len(centers)):
            of = [v for (_, v), (_, k) in zip(kept, nearest, strict=True) if k == j]
            if of:
                centers[j] = [sum(column) // len(of) for column in zip(*of, strict=True)]
    inertia = sum(d for d, _ in nearest)
    return sorted(
        (i is not None, i or 0, j, d, sum(e for e, k in nearest if k == j), inertia, hashlib.sha256(",".join(map(str, centers[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(kept, nearest, strict=True)
    )


def result(spark, rows):
    table = spark.createDataFrame([(i, e, 1, 2, "clash") for i, e in rows], TYPE)
    found = queries.clusters_digest(*centroids.cluster(table))
    assert found.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"),
                            ("inertia", "bigint"), ("centroid_sha256", "string")]
    return sorted((r[0] is not None, r[0] or 0, *r[1:]) for r in found.collect())


def test_clusters_are_those_of_brute_force(spark):
    many = vectors(160)
    odd = [None, [], [0.0] * 63, [0.0] * 65, [None] + [0.0] * 63, [float("nan")] + [0.0] * 63, [float("-inf")] + [0.0] * 63, [0.0] * 64]
    rows = [*enumerate(many), *((200 + i, e) for i, e in enumerate(odd)), (None, many[3]), (5, many[9]), (5, many[5])]
    rows += [(1000 + i, many[7]) for i in range(300)]
    got = result(spark, rows)
    assert got == brute(rows)
    assert len({r[2] for r in got}) > 10


def test_few_vectors_are_their_own_centroids(spark):
    rows = list(enumerate(vectors(7)))
    got = result(spark, rows)
    assert got == brute(rows) and {r[3] for r in got} == {0}
    assert result(spark, []) == []


def test_products_moved_are_products_computed(spark):
    table = spark.createDataFrame([(i, e, 1, 2, "") for i, e in enumerate(vectors(120))], TYPE)
    last, final = centroids.cluster(table)
    for row in last.collect():
        assert row.dots == (final @ np.array(row.v)).tolist()


def test_components_too_large_for_exact_distances_raise(spark):
    table = spark.createDataFrame([(0, [1e30] * 64, 1, 1, "")], TYPE)
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(table)
