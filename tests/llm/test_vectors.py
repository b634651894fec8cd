import numpy as np
import pyarrow as pa
import pytest
from navloom.llm import collision_search, embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, node string, weight string, id string"


def clusters(seed, groups=40, members=12, size=24, noise=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, size))
    vectors = np.repeat(centres, members, axis=0) + noise * rng.standard_normal((groups * members, size)) * rng.uniform(0, 4, (groups * members, 1))
    return vectors.astype(np.float32)


def table(spark, vectors, labels):
    rows = [(i, v if v is None else [None if x is None else float(x) for x in v], l, "n", "w", "i") for i, (v, l) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame(rows, SCHEMA)


def good(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(vectors, labels, threshold=0.93):
    n = len(vectors)
    links, names = [0] * n, list(range(n))
    for a in range(n):
        for b in range(a):
            if labels[a] is None or labels[a] != labels[b] or not good(vectors[a]) or not good(vectors[b]) or len(vectors[a]) != len(vectors[b]):
                continue
            x, y = (np.array(vectors[i], np.float64) for i in (a, b))
            if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                links[a] += 1
                links[b] += 1
                low, high = sorted((names[a], names[b]))
                names = [low if m == high else m for m in names]
    return {i: (links[i], names[i], names[i] == i) for i in range(n)}


def odd(vectors):
    nan, inf = float("nan"), float("inf")
    return [*vectors, None, [], [0.0] * 24, [nan] * 24, [inf] + [1.0] * 23, [None] + [1.0] * 23, [1.0] * 23, [1.0] * 23, vectors[0], vectors[0]]


@pytest.mark.parametrize("most", [768, 40])
def test_dedup_against_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(embedding_dedup, "LEAF_MOST", most)
    vectors = odd(list(clusters(1)))
    labels = [i // 12 % 3 for i in range(480)] + [0, 0, 0, 0, 0, 0, 1, 1, 0, None]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(table(spark, vectors, labels)).collect()}
    expected = brute(vectors, labels)
    assert sum(v[0] for v in found.values()) >= 0.98 * sum(v[0] for v in expected.values())
    assert all(found[i][0] <= expected[i][0] for i in expected)
    assert sum(found[i] != expected[i] for i in expected) <= (0 if most == 768 else 0.02 * len(expected))


def test_dense_group_is_compared_part_by_part(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEAF_MOST", 30)
    vectors = list(clusters(2, groups=2, members=150, noise=0.005))
    found = embedding_dedup.near_duplicates(table(spark, vectors, [1] * 300)).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in found} == {(i, n, c) for i, (n, c, _) in brute(vectors, [1] * 300).items()}


def leaves_of(vectors, tree, module=embedding_dedup):
    """The leaves of one tree, grown without Spark (a worker would not see patched parameters)."""
    column = pa.array(list(vectors.astype(np.float64)), pa.list_(pa.float64()))
    waiting, done = [(1, np.arange(len(vectors)))], []
    while waiting:
        leaf, inside = waiting.pop()
        if len(inside) <= module.LEAF_MOST:
            done.append(inside)
            continue
        some = inside[: module.SAMPLE]
        given = {"tree": pa.array([tree] * len(some), pa.int32()), "leaf": [leaf] * len(some), "count": [len(inside)] * len(some)}
        cuts = module._cuts(pa.table(given | {"embedding": column.take(pa.array(some))}), len(vectors))
        rows = {"tree": pa.array([tree] * len(inside), pa.int32()), "leaf": [leaf] * len(inside), "node": inside, "embedding": column.take(pa.array(inside))}
        rows |= {c: pa.array(cuts[c].to_pylist() * len(inside), cuts[c].type) for c in cuts.column_names if c in ("cuts", "spills")}
        for batch in module._descend(iter(pa.table(rows).combine_chunks().to_batches())):
            below, node, settled = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "node", "settled"))
            for name in np.unique(below):
                own = node[below == name]
                done.append(own) if settled[below == name].all() else waiting.append((int(name), own))
    return done


def share_of_links_that_meet(vectors, module=embedding_dedup):
    some = np.arange(0, len(vectors), max(1, len(vectors) // 200))
    unit = module.unit(vectors.astype(np.float64))
    linked = unit[some] @ unit.T >= 0.93
    linked[np.arange(len(some)), some] = False
    met = np.zeros_like(linked)
    for tree in range(module.TREES):
        for leaf in leaves_of(vectors, tree, module):
            own = np.flatnonzero(np.isin(some, leaf))
            met[np.ix_(own, leaf)] = True
    return (linked & met).sum() / linked.sum()


def loose(members, cosine):
    rng = np.random.default_rng(5)
    return rng.standard_normal(64) + (1 / cosine - 1) ** 0.5 * rng.standard_normal((members, 64))


@pytest.mark.parametrize(("members", "cosine"), [(20_000, 0.935), (20_000, 0.95), (20_000, 0.9)])
def test_links_of_a_loose_group_meet(members, cosine):
    assert share_of_links_that_meet(loose(members, cosine)) >= 0.97


def test_repeated_and_null_ids(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (2, [0.99, 0.01], 1)]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted(map(str, ((r.vec_id, r.n_links, r.component_id) for r in found))) == sorted(
        map(str, [(5, 3, 2), (5, 3, 2), (None, 3, 2), (None, 0, None), (2, 3, 2)])
    )


@pytest.mark.parametrize(("block", "queries"), [(8192, 1024), (100, 7)])
def test_search_against_all_distances(spark, monkeypatch, block, queries):
    monkeypatch.setattr(collision_search, "BLOCK", block)
    monkeypatch.setattr(collision_search, "QUERIES", queries)
    monkeypatch.setattr(collision_search, "MERGED_AT_ONCE", 2)
    vectors = odd(list(clusters(3)))
    given = table(spark, vectors, [0] * len(vectors))
    rows = collision_search.search(given.where("vec_id % 10 = 0"), given).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = total = 0
    usable = [i for i, v in enumerate(vectors) if good(v)]
    for q in (i for i in usable if i % 10 == 0):
        near = sorted((float(np.sqrt(((np.array(vectors[q], float) - np.array(vectors[i], float)) ** 2).sum())), i) for i in usable if i != q and len(vectors[i]) == len(vectors[q]))
        exact = dict((i, d) for d, i in near)
        assert len(found[q]) == min(10, len(near)) and found[q] == sorted(found[q], key=lambda p: (p[1], p[0]))
        assert all(abs(exact[i] - d) < 1e-9 for i, d in found[q])
        hits += len({i for i, _ in found[q]} & {i for _, i in near[:10]})
        total += len(found[q])
    assert hits >= 0.98 * total
    assert [r.rank for r in sorted(rows, key=lambda r: (r.query_id, r.rank)) if r.query_id == 0] == list(range(1, 11))


def test_ties_few_candidates_and_empty(spark):
    given = table(spark, [[0.0, 1.0], [0.0, 1.0], [0.0, 1.0], [3.0, 1.0]], [0] * 4)
    rows = sorted(tuple(r) for r in collision_search.search(given.where("vec_id = 0"), given).collect())
    assert rows == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 3.0)]
    assert collision_search.search(given.where("vec_id = 0"), given.where("vec_id = 0")).count() == 0
    assert collision_search.search(given, given.where("false")).count() == 0
    assert embedding_dedup.near_duplicates(given.where("false")).count() == 0


def test_repeated_query_ids_have_whole_answers(spark, monkeypatch):
    monkeypatch.setattr(collision_search, "BLOCK", 40)
    monkeypatch.setattr(collision_search, "QUERIES", 2)
    rng = np.random.default_rng(6)
    vectors = [[float(x) for x in rng.standard_normal(8)] for _ in range(120)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(0, vectors[0]), (0, vectors[50])]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in collision_search.search(given.where("vec_id = 0"), given).collect()]
    want = []
    for own in (vectors[0], vectors[50]):
        near = sorted((float(np.linalg.norm(np.subtract(own, v))), i) for i, v in rows if i)[:10]
        want += [(0, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    assert [r[:3] for r in sorted(found)] == [r[:3] for r in sorted(want)]
    assert np.allclose([r[3] for r in sorted(found)], [r[3] for r in sorted(want)])
