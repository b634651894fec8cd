"""Embedding near-dedup with a forest of random-projection trees.

Every tree splits recursively along random directions near the median; vectors close to a cut go to
both sides (spill), so near pairs stay together. Vectors are compared within leaves, and a pair counts
if its cosine, in double precision, is at least the threshold. A pair that meets in several leaves
counts in the smallest of them that both share, so links are counted without gathering pairs: a leaf
only gives each vector's number of links and a spanning forest, whose union gives the components.

Equal vectors of a label are one node with a weight. Trees grow by rounds: every leaf above
`LEAF_MOST` is split up to `DEPTH` times by cuts learned on at most about `SAMPLE` of its nodes. A leaf
is compared part by part instead of being split if no direction spreads it, if many of its pairs are
links, or if keeping linked pairs together would take so wide a spill that splitting made more copies
of its rows than comparing all of it. The spill of a cut follows from the depth the forest needs: a
pair exactly at the threshold may miss every tree with a chance of about `MISSED`, whatever the size.
No leaf is ever cut short, and of leaves with the same nodes only one is compared.

Defined results: a vector that is null, zero or holds null or non-finite components, or without a
label, has no links and is its own component; vectors of different lengths are not compared; equal
rows are different vectors linked with each other; a null id takes part, its component is named by
the smallest id that is not null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.components import components
from navloom.llm.shared import keep, mix64, whole_groups

COSINE = 0.93
TREES = 6
LEAF_MOST = 768
DEPTH = 5
SAMPLE = 4096
#: Least half-width of the spill at a cut, and the least spread of a node worth splitting, for unit
#: vectors, both times the square root of the dimension.
SPILL = 0.12
SPREAD = 0.6
#: Chance that a pair at the threshold meets in no tree; share of linked pairs from which a node is not split.
MISSED = 0.02
DENSE = 0.25


def usable(embedding: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows, in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def direction(tree: int, leaf: int, node: int, size: int) -> np.ndarray:
    drawn = np.random.default_rng([tree, leaf % (1 << 63), node]).standard_normal(size)
    return drawn / np.sqrt(drawn @ drawn)


def _beyond(gap: float, deviation: float) -> float:
    """The mean of what a normal value of that deviation exceeds `gap` by, in size."""
    z = gap / deviation
    return 2 * (deviation * math.exp(-z * z / 2) / math.sqrt(2 * math.pi) - gap * math.erfc(z / math.sqrt(2)) / 2)


def spill_at(along: np.ndarray, middle: float, scale: float, largest: int) -> float | None:
    """Half-width of the spill at a cut, so that linked pairs stay together often enough over the depth
    that a group of `largest` nodes needs; None if splitting would copy more than comparing all."""
    apart = math.sqrt(2 - 2 * COSINE)
    density = np.mean(np.abs(along - middle) <= apart * scale) / (2 * apart)
    allowed = -math.log(1 - MISSED ** (1 / TREES)) / math.log(max(largest / LEAF_MOST, 2))
    spill = SPILL
    while True:
        part = max(np.mean(along <= middle + spill * scale), np.mean(along > middle - spill * scale))
        if part > math.sqrt(0.5):
            return None
        if _beyond(2 * spill, apart) * density <= allowed * -math.log(part):
            return spill * scale
        spill *= 1.1


def dense(vectors: np.ndarray) -> bool:
    some = vectors[:512]
    linked = np.count_nonzero(some @ some.T >= COSINE) - len(some)
    return linked >= DENSE * len(some) * (len(some) - 1)


def _cuts(table: pa.Table, largest: int) -> pa.Table:
    """Cuts of a leaf's subtree in heap order and their spills, learned on its sample; NaN where a node is not split."""
    tree, leaf, count = (table[c][0].as_py() for c in ("tree", "leaf", "count"))
    vectors = unit(matrix(table["embedding"].combine_chunks()))
    scale = vectors.shape[1] ** -0.5
    cuts = np.full((1 << DEPTH) - 1, np.nan)
    spills = cuts.copy()
    waiting = [(0, np.arange(len(vectors)))]
    while waiting:
        node, inside = waiting.pop()
        if node >= len(cuts) or len(inside) * count / len(vectors) <= LEAF_MOST or len(inside) < 8:
            continue
        along = vectors[inside] @ direction(tree, leaf, node, vectors.shape[1])
        low, middle, high = np.quantile(along, [0.05, 0.5, 0.95])
        if high - low < SPREAD * scale or dense(vectors[inside]):
            continue
        spill = spill_at(along, middle, scale, largest)
        if spill is None:
            continue
        cuts[node], spills[node] = middle, spill
        waiting += [(2 * node + 1, inside[along <= middle]), (2 * node + 2, inside[along > middle])]
    floats = pa.list_(pa.float64())
    schema = pa.schema([("tree", pa.int32()), ("leaf", pa.int64()), ("cuts", floats), ("spills", floats)])
    return pa.table({"tree": [tree], "leaf": [leaf], "cuts": [cuts], "spills": [spills]}, schema=schema)


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of leaves with cuts, once for each leaf below that they reach; a leaf without real cuts is settled."""
    for batch in whole_groups(batches, ["tree", "leaf"]):
        tree, leaf = (batch.column(c).to_numpy() for c in ("tree", "leaf"))
        borders = np.flatnonzero(np.concatenate([[True], (tree[1:] != tree[:-1]) | (leaf[1:] != leaf[:-1])]))
        rows, leaves, settled = [], [], []
        for a, b in zip(borders.tolist(), [*borders[1:].tolist(), len(tree)], strict=True):
            cuts, spills = (np.array(batch.column(c)[a].as_py(), np.float64) for c in ("cuts", "spills"))
            if np.isnan(cuts[0]):
                rows.append(np.arange(a, b))
                leaves.append(leaf[a:b])
                settled.append(np.ones(b - a, bool))
                continue
            vectors = unit(matrix(batch.column("embedding").slice(a, b - a)))
            waiting = [(0, np.arange(b - a))]
            while waiting:
                node, inside = waiting.pop()
                if node >= len(cuts) or np.isnan(cuts[node]):
                    place = (int(leaf[a]) + node * 0x51_7C_C1_B7_27_22_0A) & (1 << 64) - 1
                    name = mix64(np.array([place], np.uint64)).view(np.int64)[0]
                    rows.append(inside + a)
                    leaves.append(np.full(len(inside), name))
                    settled.append(np.zeros(len(inside), bool))
                    continue
                along = vectors[inside] @ direction(int(tree[a]), int(leaf[a]), node, vectors.shape[1])
                spill = spills[node]
                waiting += [(2 * node + 1, inside[along <= cuts[node] + spill]), (2 * node + 2, inside[along > cuts[node] - spill])]
        at = pa.array(np.concatenate(rows))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("tree").take(at),
                pa.array(np.concatenate(leaves)),
                batch.column("node").take(at),
                batch.column("embedding").take(at),
                pa.array(np.concatenate(settled)),
            ],
            names=["tree", "leaf", "node", "embedding", "settled"],
        )


def forest(nodes: DataFrame) -> DataFrame:
    """tree, leaf, node: the leaves of every tree that each node (node, label, embedding) lies in."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    leaf = F.xxhash64("label", F.size("embedding")).alias("leaf")
    growing = nodes.select(trees, leaf, "node", "embedding", F.lit(False).alias("settled"))
    done, largest = [], None
    schema = f"tree int, leaf long, node long, embedding {nodes.schema['embedding'].dataType.simpleString()}, settled boolean"
    while True:
        sizes = keep(growing.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("count")), "sizes")
        big = sizes.where(F.col("count") > LEAF_MOST)
        names = growing.select("tree", "leaf", "node")
        done.append(names.join(sizes.where(F.col("count") <= LEAF_MOST), ["tree", "leaf"], "left_semi"))
        if big.isEmpty():
            break
        largest = largest or sizes.agg(F.max("count")).first()[0]

        def cuts_of(table: pa.Table) -> pa.Table:
            return _cuts(table, largest)

        large = growing.join(big, ["tree", "leaf"])
        part = F.pmod(F.xxhash64(F.lit(7), "tree", "node"), F.lit(1 << 30)) * F.col("count") < F.lit(SAMPLE * (1 << 30))
        cuts = keep(
            large.where(part | (F.col("count") <= SAMPLE))
            .select("tree", "leaf", "count", "embedding")
            .groupBy("tree", "leaf")
            .applyInArrow(cuts_of, "tree int, leaf long, cuts array<double>, spills array<double>"),
            "cuts",
        )
        below = large.drop("count", "settled").join(cuts, ["tree", "leaf"]).sortWithinPartitions("tree", "leaf", "node")
        split = keep(below.mapInArrow(_descend, schema), "leaves")
        done.append(split.where("settled").select("tree", "leaf", "node"))
        growing = split.where("NOT settled")
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def _distinct(leaves: DataFrame) -> DataFrame:
    """The same rows without leaves that hold the same nodes as another one."""
    sums = [F.sum(F.shiftright(F.xxhash64(F.lit(seed), "node"), 24)).alias(f"sum{seed}") for seed in (1, 2)]
    contents = leaves.groupBy("code").agg(F.count(F.lit(1)).alias("count"), *sums)
    first = contents.groupBy("count", "sum1", "sum2").agg(F.min("code").alias("code"))
    return leaves.join(first.select("code"), "code", "left_semi")


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows grouped by (leaf, i, j): each node's linked weight and the smallest node it is tied to here."""
    for batch in whole_groups(batches, ["code", "i", "j"]):
        code, i, j, part, node, weight = (batch.column(c).to_numpy() for c in ("code", "i", "j", "part", "node", "weight"))
        change = (code[1:] != code[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        borders = np.flatnonzero(np.concatenate([[True], change]))
        counts, root = np.zeros(len(code), np.int64), np.arange(len(code))
        for a, b in zip(borders.tolist(), [*borders[1:].tolist(), len(code)], strict=True):
            vectors = unit(matrix(batch.column("embedding").slice(a, b - a)))
            x, y = np.nonzero(np.triu(vectors @ vectors.T >= COSINE, 1))
            if i[a] != j[a]:
                apart = part[a + x] != part[a + y]
                x, y = x[apart], y[apart]
            if not len(x):
                continue
            lists = batch.column("codes").slice(a, b - a)
            ends = lists.offsets.to_numpy().astype(np.int64)
            width = int(np.diff(ends).max())
            flat = lists.flatten().to_numpy()
            known = np.full((b - a, width), np.iinfo(np.int64).min)
            owner = np.repeat(np.arange(b - a), np.diff(ends))
            known[owner, np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], np.diff(ends))] = flat
            lists, of = np.unique(known, axis=0, return_inverse=True)
            if len(lists) ** 2 <= len(x):  # nodes that lie in the same leaves have the same answer
                table = np.array([_owned(np.broadcast_to(one, lists.shape), lists, code[a]) for one in lists])
                own = table[of[x], of[y]]
            else:
                own = np.concatenate([_owned(known[x[s : s + 4096]], known[y[s : s + 4096]], code[a]) for s in range(0, len(x), 4096)])
            x, y = x[own] + a, y[own] + a
            np.add.at(counts, x, weight[y])
            np.add.at(counts, y, weight[x])
            _tie(root, x, y)
        linked = counts > 0
        names = _smallest(root, node)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[linked]), pa.array(counts[linked]), pa.array(names[linked])], names=["node", "links", "tied"]
        )


def _owned(left: np.ndarray, right: np.ndarray, code: int) -> np.ndarray:
    """Whether the smallest leaf that both sides' lists share is this one (the lists are ascending)."""
    shared = (left[:, :, None] == right[:, None, :]).any(axis=2) & (left != np.iinfo(np.int64).min)
    return left[np.arange(len(left)), shared.argmax(axis=1)] == code


def _tie(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give both ends of every edge the same smallest root."""
    while len(x):
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while (root[root] != root).any():
            root[:] = root[root]
        open_edges = root[x] != root[y]
        x, y = x[open_edges], y[open_edges]


def _smallest(root: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The smallest node of each row's tree."""
    least = np.full(len(root), np.iinfo(np.int64).max)
    np.minimum.at(least, root, node)
    return least[root]


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector (vec_id, embedding, label)."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    embedding = F.col("embedding") if single else F.col("embedding").cast("array<double>")  # singles are widened in the tasks
    given = vectors.select("vec_id", embedding.alias("embedding"), "label")
    good = F.col("label").isNotNull() & usable(F.col("embedding"))
    valid = given.where(good).withColumn("name", F.xxhash64("label", "embedding"))
    nodes = keep(
        valid.groupBy("label", "name", "embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
        .withColumn("node", F.coalesce("least", "name")),
        "nodes",
    )
    leaves = keep(_distinct(forest(nodes).withColumn("code", F.xxhash64("tree", "leaf"))), "forest")
    codes = leaves.groupBy("node").agg(F.array_sort(F.collect_list("code")).alias("codes"))  # a node's leaves: few
    sizes = leaves.groupBy("code").agg(F.count(F.lit(1)).alias("count"))
    parts = F.when(F.col("count") > 2 * LEAF_MOST, F.ceil(F.col("count") * 2 / LEAF_MOST)).otherwise(1).cast("int")
    known = leaves.join(sizes.select("code", parts.alias("parts")), "code").join(codes, "node")
    dealt = known.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn(
        "k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    groups = dealt.select(
        "code", F.least("part", "k").alias("i"), F.greatest("part", "k").alias("j"), "part", "node", "codes"
    )
    with_vectors = groups.join(nodes.select("node", "weight", "embedding"), "node")  # till here leaves hold names alone
    sorted_groups = with_vectors.repartition("code", "i", "j").sortWithinPartitions("code", "i", "j", "node")
    found = keep(sorted_groups.mapInArrow(_links, "node long, links long, tied long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    tied = keep(components(found.select(F.col("node").alias("a"), F.col("tied").alias("b"))), "components")
    placed = nodes.join(links, "node", "left").join(tied, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "component").select(
        "label", "name", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    linked = valid.join(named, ["label", "name", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = given.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
