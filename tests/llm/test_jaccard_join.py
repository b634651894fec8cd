import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from navloom.llm import jaccard_join
from navloom.llm.components import components
from navloom.llm.jaccard_join import linked
from navloom.llm.shared import give_back
from pyspark.sql import functions as F

from .data import documents, odd_texts, words


def brute(rows):
    """doc_id -> (set size, component) for unique ids."""
    sets = {}
    for i, text in rows:
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    names = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((names[a], names[b]))
                names = {i: low if n == high else n for i, n in names.items()}
    return {i: (len(sets[i]), names[i]) for i in ids}


def edited(seed, n, edits):
    """A family: texts near a base, some of them near the border of 3/4."""
    rng = random.Random(seed)
    base = words(n, seed).split(" ")
    out = []
    for k in range(edits):
        copy = list(base)
        for _ in range(rng.randrange(0, max(2, n // 30))):
            copy[rng.randrange(n)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy[: rng.randrange(int(n * 0.8), n + 1)]))
    return out


def check(docs):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(docs).collect()}
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_against_all_pairs(spark):
    passage = words(60, 99)
    shared = [f"{words(40, 500 + k)} {passage} {words(30, 600 + k)}" for k in range(25)]
    families = [t for s in range(200, 208) for t in edited(s, 40 + 30 * (s % 5), 9)]
    docs = documents(spark, [*odd_texts(), *families, *shared], ", node string, h string, n string", ("a", "b", "c"))
    check(docs.repartition(5))


def test_frequent_shingles_only_steer(spark, monkeypatch):
    texts = [t for s in range(300, 304) for t in edited(s, 90, 12)]
    docs = documents(spark, texts)
    frequent = np.sort(np.concatenate([jaccard_join.shingle_sets(__import__("pyarrow").array(texts[:20]))[0]]))
    monkeypatch.setattr(jaccard_join, "frequent_shingles", lambda _: np.unique(frequent))
    check(docs)


def test_large_groups_are_joined_part_by_part(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TREE_MOST", 6)
    monkeypatch.setattr(jaccard_join, "pivots", lambda nodes: nodes.where("false").select(F.col("node").alias("a"), F.col("node").alias("b")))
    check(documents(spark, [t for s in range(400, 403) for t in edited(s, 60, 20)]))


def test_trees_lose_no_pair():
    rng = np.random.default_rng(1)
    base = rng.poisson(2, (40, 64))
    points = np.repeat(base, 8, axis=0) + rng.binomial(1, 0.05, (320, 64))
    sizes = points.sum(axis=1)
    x, y = jaccard_join.RTree(points, sizes).partners()
    bound = np.minimum(points[:, None], points[None]).sum(axis=2)
    good = np.triu(7 * bound >= 3 * (sizes[:, None] + sizes[None]), 1)
    good &= 4 * np.minimum(sizes[:, None], sizes[None]) >= 3 * np.maximum(sizes[:, None], sizes[None])
    assert {(min(a, b), max(a, b)) for a, b in zip(x.tolist(), y.tolist())} >= set(zip(*(i.tolist() for i in np.nonzero(good))))


def test_repeated_and_null_ids(spark):
    base = words(50, 3)
    rows = [(1, base), (1, base), (None, base), (4, base + " end"), (None, ""), (7, None), (7, None), (8, words(50, 4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or -1, r.component_id or -1) for r in jaccard_join.join(docs).collect())
    assert found == [(-1, -1), (-1, 1), (1, 1), (1, 1), (4, 1), (7, 7), (7, 7), (8, 8)]
    kept = jaccard_join.representatives(docs).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == sorted([(1, base), (-1, ""), (7, ""), (7, ""), (8, words(50, 4))])


def test_representatives_keep_all_columns(spark):
    docs = documents(spark, odd_texts(), ", record string, set_id string", ("r", "s"))
    kept = jaccard_join.representatives(docs)
    assert kept.columns == docs.columns
    firsts = {c for _, c in brute([(r.doc_id, r.text) for r in docs.collect()]).values()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(firsts)


def test_empty_table(spark):
    docs = documents(spark, ["x"]).where("false")
    assert jaccard_join.join(docs).count() == 0 and jaccard_join.representatives(docs).count() == 0


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 20)] + [(30, 31), (31, 31)], []])
def test_components(spark, edges):
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    names = {n: n for e in edges for n in e}
    for a, b in edges * len(edges):
        names[a] = names[b] = min(names[a], names[b])
    expected = {n: c for n, c in names.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert found == expected


def test_links_found_unite_what_all_links_unite():
    rng = random.Random(2)
    for size in (2, 3, 20, 90):
        base = [rng.sample(range(10_000), 60) for _ in range(max(1, size // 15))]
        sets = []
        for _ in range(size):
            members = list(rng.choice(base))
            for _ in range(rng.choice((0, 3, 6, 9, 12))):
                members[rng.randrange(len(members))] = rng.randrange(10_000)
            sets.append(np.array(sorted(set(members)), np.uint64))
        known = np.array([rng.randrange(size) for _ in range(size)])
        found = linked(sets, known)

        def united(pairs):
            label = known.tolist()
            for a, b in pairs:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
            return {tuple(i for i in range(size) if label[i] == x) for x in label}

        shared = {(a, b): len(np.intersect1d(sets[a], sets[b])) for a in range(size) for b in range(a)}
        links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
        assert united(found) == united(links)
        assert len(found) < len(set(known.tolist())) and all((max(p), min(p)) in links for p in found)


@pytest.mark.parametrize("cut", [jaccard_join._described, jaccard_join._prefixes(np.zeros(0, np.uint64))])
def test_work_arrays_do_not_grow_with_the_batch(cut):
    texts = [words(800, i, 5000) for i in range(700)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(700)), pa.array(texts)], names=["doc_id", "text"])
    give_back()
    tracemalloc.start()
    for _ in cut(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000_000 < 10 * sum(map(len, texts))
