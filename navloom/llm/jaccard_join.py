"""N-gram Jaccard join over count-vector R-trees.

Every text becomes its set of distinct word shingles. Shingles are hashed into `GROUPS` groups, and a
set's group counts are its point. The summed minima of two points' coordinates bound the overlap of
their sets from above; R-trees over the points use the same bound on whole nodes. Pairs that survive
are verified on the sets themselves.

A tree over all points would have to be searched everywhere, as unrelated points lie at like
distances in many dimensions. So there is one tree for each shingle that could start a link: with any
global order of shingles, two sets whose Jaccard similarity is at least 3/4 share one of the first
n - ceil(3n/4) + 1 shingles of both. The order puts frequent shingles last, which keeps trees small;
the frequent ones are found on a fixed share of the texts and only steer the order, never the result.

Copies and most near copies never reach the trees: equal sets are one node, and every node is first
verified against one pivot, a central node it shares most of its keys (pairs of minima) with. Only pairs across
the components known so far are searched. The trees tell which nodes have a candidate partner at all; the sets of
these are brought together once for each group of trees, verified there, and of the links found only those
are reported that unite something. So rows grow with the nodes, never with their pairs, and the components
in the end are exact.

Defined results: a null text, or one without words, has the empty set and links with nothing; a text
with fewer words than a shingle has its whole sequence as one shingle; equal rows are in one
component; a row with null id belongs to a component named by its smallest id that is not null; an
empty table gives no rows; columns besides id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.llm.components import components
from navloom.llm.shared import keep, mix64, sliced, text_of, utf8, whole_groups
from navloom.llm.words import split

WORDS = 5
#: Groups of the trees' points; larger sets have a multiple, at most CROWD shingles to a group.
GROUPS = 64
CROWD = 6
#: Minima of each set under as many hashes; two neighbours together are a key of the first pass.
MINIMA = 8
#: A shingle is frequent if this share of the sampled texts has it, and at least FREQUENT_LEAST do.
FREQUENT_SHARE = 1 / 4000
FREQUENT_LEAST = 4
SAMPLE_OF = 16
#: At most so many frequent shingles are told to all tasks (8 bytes each); more only cost speed.
FREQUENT_MOST = 1 << 20
#: Members of a tree, and shingles of them all; larger groups are joined part by part.
TREE_MOST = 4096
SHINGLES_MOST = 1 << 22
LEAF = 16
#: Coordinates of pairs compared at a time; bounds the work arrays.
PAIR_CELLS = 1 << 20
#: Text whose shingles are cut at a time; the arrays of a slice take some 60 times its bytes.
SLICE_BYTES = 1 << 18

_PLACES = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
_SEEDS = mix64(np.arange(1, MINIMA + 3, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, ascending, one text after another, and their n + 1 offsets."""
    data, offsets = utf8(texts)
    words, docs = split(data, offsets), len(offsets) - 1
    count = np.bincount(words.doc, minlength=docs) if docs else np.zeros(0, np.int64)
    short = (count > 0) & (count < WORDS)
    size = np.where(short, 1, np.maximum(0, count - WORDS + 1))
    ends = np.cumsum(size)
    values = np.zeros(int(ends[-1]) if docs else 0, np.uint64)
    n = len(words.hash)
    if n >= WORDS:
        last = n - WORDS + 1
        run = np.zeros(last, np.uint64)
        for j in range(WORDS):
            run += words.hash[j : j + last] * _PLACES[j]
        inside = words.doc[:last] == words.doc[WORDS - 1 :]
        values[np.repeat(~short, size)] = mix64(run[inside])
    first = np.cumsum(count) - count
    for i in np.flatnonzero(short).tolist():
        few = words.hash[first[i] : first[i] + count[i]]
        values[ends[i] - 1] = mix64(np.array([(few * _PLACES[: len(few)]).sum() + np.uint64(len(few))], np.uint64))[0]
    bounds = np.concatenate([[0], ends])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    starts = bounds[:-1][size > 0]
    new[starts] = True
    return values[new], np.concatenate([[0], np.cumsum(new)])[bounds]


def _sums(values: np.ndarray, bounds: np.ndarray, add: np.ufunc) -> np.ndarray:
    """`add` over each text's values; 0 for none."""
    out = np.zeros(len(bounds) - 1, values.dtype)
    some = bounds[1:] > bounds[:-1]
    if some.any():
        out[some] = add.reduceat(values, bounds[:-1][some])
    return out


def signatures(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set; the first names its node."""
    return tuple(_sums(mix64(values ^ seed), bounds, np.add).view(np.int64) for seed in _SEEDS[:2])


def cells_of(n: np.ndarray) -> np.ndarray:
    """Groups of a set's point: GROUPS, doubled until a group has few shingles, as crowded groups bound nothing."""
    doubled = np.ceil(np.log2(np.maximum(n, 1) / (GROUPS * CROWD))).clip(0).astype(np.int64)
    return GROUPS << doubled


def folded(points: np.ndarray, cells: int) -> np.ndarray:
    """Points of more groups as points of fewer: a shingle's group is its hash modulo the number of groups."""
    return points.reshape(len(points), -1, cells).sum(axis=1, dtype=np.int64)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, limit=SLICE_BYTES):
        values, bounds = shingle_sets(batch.column("text"))
        n, docs = np.diff(bounds), len(bounds) - 1
        node, check = signatures(values, bounds)
        minima = np.stack([_sums(mix64(values ^ seed), bounds, np.minimum) for seed in _SEEDS[2:]], axis=1)
        keys = mix64(minima + np.roll(minima, 1, axis=1) * _PLACES[0])
        cells = cells_of(n)
        at = np.concatenate([[0], np.cumsum(cells)])
        cell = np.repeat(at[:-1], n) + (values % np.repeat(cells, n).astype(np.uint64)).astype(np.int64)
        points = np.bincount(cell, minlength=at[-1]).astype("<u2")
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(docs + 1, dtype=np.int32) * MINIMA), pa.array(keys.view(np.int64).ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n.astype(np.int64)),
                pa.array(node),
                pa.array(check),
                lists,
                pa.array([points[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary()),
            ],
            names=["doc_id", "n", "node", "check", "keys", "point"],
        )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, text_a, text_b), the pairs whose sets really link; rows of another text with the same id fall out."""
    for batch in sliced(batches, "text_a", limit=SLICE_BYTES):
        sides = [shingle_sets(batch.column(c)) for c in ("text_a", "text_b")]
        fits = np.ones(batch.num_rows, bool)
        for name, (values, bounds) in zip("ab", sides, strict=True):
            fits &= signatures(values, bounds)[0] == batch.column(name).to_numpy()
        (left, at_left), (right, at_right) = sides
        for i in np.flatnonzero(fits).tolist():
            a, b = left[at_left[i] : at_left[i + 1]], right[at_right[i] : at_right[i + 1]]
            both = np.concatenate([a, b])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            fits[i] = 7 * shared >= 3 * (len(a) + len(b))
        kept = pa.array(fits)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in ("a", "b")], names=["a", "b"])


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that link, decided on one text of each."""
    named = nodes.select("node", "doc_id")
    both = pairs.join(named.toDF("a", "id_a"), "a").join(named.toDF("b", "id_b"), "b")
    texts = docs.select("doc_id", "text")
    left = both.join(texts.toDF("id", "text_a"), F.col("id_a").eqNullSafe(F.col("id"))).select("a", "b", "id_b", "text_a")
    pair_texts = left.join(texts.toDF("id", "text_b"), F.col("id_b").eqNullSafe(F.col("id")))
    found = pair_texts.select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long")
    return keep(found.distinct(), "links")


def pivots(nodes: DataFrame) -> DataFrame:
    """For each node, the pair with the pivot it shares most of its keys with.

    The pivot of a key is the member met most often over all its keys: of edited copies that is the
    original, which is nearer to each copy than the copies are to each other.
    """
    keys = nodes.select("node", F.posexplode("keys").alias("place", "value"))
    shared = keys.groupBy("place", "value").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = keep(keys.join(shared, ["place", "value"]), "keys")
    central = met.groupBy("node").agg(F.sum("members").alias("degree"))
    ranked = met.join(central, "node").groupBy("place", "value").agg(F.max_by("node", F.struct("degree", "node")).alias("pivot"))
    votes = met.join(ranked, ["place", "value"]).where("node <> pivot").groupBy("node", "pivot").count()
    best = votes.groupBy("node").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("b"))
    return best.withColumnRenamed("node", "a")


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles in at least FREQUENT_SHARE of the texts, by a fixed sample of them; ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, limit=SLICE_BYTES):
            values, _ = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], names=["h"])

    sample = docs.where(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(SAMPLE_OF)) == 0).select("text")
    least = max(FREQUENT_LEAST, math.ceil(FREQUENT_SHARE * sample.count()))
    counts = sample.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= least)
    rows = counts.orderBy(F.desc("count"), "h").limit(FREQUENT_MOST).select("h").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def _prefixes(frequent: np.ndarray):
    """For mapInArrow: the shingles of each text that could start a link, as (h, node, n, frequent)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, limit=SLICE_BYTES):
            values, bounds = shingle_sets(batch.column("text"))
            node, _ = signatures(values, bounds)
            n = np.diff(bounds)
            common = np.zeros(len(values), bool)
            if len(frequent):
                common = frequent[np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)] == values
            doc = np.repeat(np.arange(len(n)), n)
            rare = np.concatenate([[0], np.cumsum(~common)])
            rares = rare[bounds[1:]] - rare[bounds[:-1]]
            before = rare[:-1] - rare[bounds[:-1]][doc]
            inside = np.arange(len(values)) - bounds[:-1][doc]
            rank = np.where(common, rares[doc] + inside - before, before)
            first = rank < (n - (3 * n + 3) // 4 + 1)[doc]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(values[first].view(np.int64)),
                    pa.array(node[doc[first]]),
                    pa.array(n[doc[first]].astype(np.int32)),
                    pa.array(common[first]),
                ],
                names=["h", "node", "n", "frequent"],
            )

    return run


class RTree:
    """Points packed by sort-tile order; every node knows the largest coordinates and smallest size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.levels = [(points[o := self._tiled(points, sizes)], sizes[o])]
        self.order = o
        while len(self.levels[-1][0]) > LEAF:
            top, least = self.levels[-1]
            cuts = np.arange(0, len(top), LEAF)
            self.levels.append((np.maximum.reduceat(top, cuts), np.minimum.reduceat(least, cuts)))

    @staticmethod
    def _tiled(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """By size in slabs, within a slab by the widest coordinate."""
        order = np.argsort(sizes, kind="stable")
        slab = max(LEAF, int(math.sqrt(len(points) * LEAF)))
        for a in range(0, len(order), slab):
            part = order[a : a + slab]
            order[a : a + slab] = part[np.argsort(points[part][:, points[part].var(axis=0).argmax()], kind="stable")]
        return order

    def partners(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (i, j), i < j, whose bound allows a similarity of 3/4."""
        query, node = (x.ravel() for x in np.indices((len(self.points), len(self.levels[-1][0]))))
        for level in range(len(self.levels) - 1, -1, -1):
            top, least = self.levels[level]
            good = np.concatenate(
                [self._may(query[a : a + 16384], node[a : a + 16384], top, least) for a in range(0, len(query), 16384)]
                or [np.zeros(0, bool)]
            )
            query, node = query[good], node[good]
            if level:
                below = len(self.levels[level - 1][0])
                query, node = np.repeat(query, LEAF), (node[:, None] * LEAF + np.arange(LEAF)).ravel()
                query, node = query[node < below], node[node < below]
        other = self.order[node]
        return query[query < other], other[query < other]

    def _may(self, query: np.ndarray, node: np.ndarray, top: np.ndarray, least: np.ndarray) -> np.ndarray:
        bound = np.minimum(self.points[query], top[node]).sum(axis=1, dtype=np.int64)
        size = self.sizes[query]
        return (7 * bound >= 3 * (size + least[node])) & (4 * bound >= 3 * size)


def _pairs_in(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within each range a:b."""
    row = np.concatenate([np.arange(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)] or [np.zeros(0, np.int64)])
    after = np.repeat(b, b - a) - 1 - row
    x = np.repeat(row, after)
    return x, x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(after) - after, after)


class Points:
    """Points of a batch in as many groups as each has; bounds are taken in as many as both sides have."""

    def __init__(self, blobs: list[bytes]):
        self.cells = np.array([len(b) // 2 for b in blobs], np.int64)
        self.place = np.zeros(len(blobs), np.int64)
        self.parts: dict[int, np.ndarray] = {}
        for cells in np.unique(self.cells).tolist():
            rows = np.flatnonzero(self.cells == cells)
            self.place[rows] = np.arange(len(rows))
            self.parts[cells] = np.frombuffer(b"".join([blobs[i] for i in rows.tolist()]), "<u2").reshape(-1, cells)

    def some_in(self, rows: np.ndarray, cells: int) -> np.ndarray:
        """The points of some rows, which have at least so many groups."""
        out = np.empty((len(rows), cells), np.uint32)
        for own in np.unique(self.cells[rows]).tolist():
            these = np.flatnonzero(self.cells[rows] == own)
            out[these] = folded(self.parts[own][self.place[rows[these]]], cells)
        return out

    def may(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the summed minima of each pair's points allow a similarity of 3/4."""
        good = np.zeros(len(x), bool)
        level = np.minimum(self.cells[x], self.cells[y])
        for cells in np.unique(level).tolist():
            of_level = np.flatnonzero(level == cells)
            step = max(1, PAIR_CELLS // cells)
            for s in range(0, len(of_level), step):
                k = of_level[s : s + step]
                rows, which = np.unique(np.concatenate([x[k], y[k]]), return_inverse=True)
                points = self.some_in(rows, cells)
                bound = np.minimum(points[which[: len(k)]], points[which[len(k) :]]).sum(axis=1, dtype=np.int64)
                good[k] = 7 * bound >= 3 * (size[x[k]] + size[y[k]])
        return good


def _tree_survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows grouped by (leader, i, j) and, within, by h: the nodes with a candidate partner in another component.

    A pair is a candidate in a group of one h, across its parts if i <> j. However many partners a node
    has, and in however many groups of its leader, it is one row.
    """
    for batch in whole_groups(batches, ["leader", "i", "j"]):
        leader, i, j, h, part, node, n, known = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("leader", "i", "j", "h", "part", "node", "n", "component")
        )
        points, n = Points(batch.column("point").to_pylist()), n.astype(np.int64)
        new = (leader[1:] != leader[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        border = np.flatnonzero(np.concatenate([[True], new | (h[1:] != h[:-1])]))
        ends = np.append(border[1:], len(h))
        small = ends - border <= LEAF  # a tree of one leaf
        survives = np.zeros(len(h), bool)

        def judge(x: np.ndarray, y: np.ndarray) -> None:
            good = (known[x] != known[y]) & ((part[x] != part[y]) | (i[x] == j[x]))
            good &= 4 * np.minimum(n[x], n[y]) >= 3 * np.maximum(n[x], n[y])
            x, y = x[good], y[good]
            good = points.may(x, y, n)
            survives[x[good]] = survives[y[good]] = True

        judge(*_pairs_in(border[small], ends[small]))
        for a, b in zip(border[~small].tolist(), ends[~small].tolist(), strict=True):
            cells = int(points.cells[a:b].min())  # as many groups as all members have
            x, y = RTree(points.some_in(np.arange(a, b), cells), n[a:b]).partners()
            judge(x + a, y + a)
        group = np.concatenate([[0], np.cumsum(new)])
        _, first = np.unique(np.stack([group[survives], node[survives]]), axis=1, return_index=True)
        kept = pa.array(np.flatnonzero(survives)[first])
        yield batch.select(["leader", "i", "j", "node", "component"]).take(kept)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to (node, members), the sorted shingles; rows of another text with the same id fall out."""
    for batch in sliced(batches, limit=SLICE_BYTES):
        values, bounds = shingle_sets(batch.column("text"))
        fits = np.flatnonzero(signatures(values, bounds)[0] == batch.column("node").to_numpy())
        members = [values[bounds[k] : bounds[k + 1]].tobytes() for k in fits.tolist()]
        yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(fits)), pa.array(members, pa.binary())], names=["node", "members"])


def linked(sets: list[np.ndarray], component: np.ndarray) -> list[tuple[int, int]]:
    """Links that unite the sets as far as any of theirs do: a spanning forest over the components given.

    A set is held against all others at once. Sets of the largest component need not be, once all
    outside of it were: what is left are pairs within.
    """
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    everything = np.concatenate(sets)
    _, of = np.unique(component, return_inverse=True)
    sizes = np.bincount(of)
    todo = np.ones(len(sets), bool)
    found = []
    while True:
        outside = np.flatnonzero(todo & (of != sizes.argmax()))
        if not len(outside):
            return found
        # The first one tells how dense the rest is; others come from small components.
        v = int(outside[sizes[of[outside]].argmin()])
        todo[v] = False
        at = np.searchsorted(sets[v], everything)
        shared = np.bincount(owner[sets[v][np.minimum(at, n[v] - 1)] == everything], minlength=len(sets))
        links = np.flatnonzero((7 * shared >= 3 * (n + n[v])) & (of != of[v]))
        _, first = np.unique(of[links], return_index=True)
        for u in links[first].tolist():
            found.append((v, u))
            sizes[of[v]] += sizes[of[u]]
            sizes[of[u]] = 0
            of[of == of[u]] = of[v]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows grouped by (leader, i, j): verified links (a, b) across components, less than one per node."""
    for batch in whole_groups(batches, ["leader", "i", "j"]):
        keys = [batch.column(c).to_numpy() for c in ("leader", "i", "j")]
        node, component = batch.column("node").to_numpy(), batch.column("component").to_numpy()
        border = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]))
        members = batch.column("members")
        a, b = [], []
        for start, end in zip(border.tolist(), [*border[1:].tolist(), batch.num_rows], strict=True):
            sets = [np.frombuffer(members[k].as_buffer(), np.uint64) for k in range(start, end)]
            for x, y in linked(sets, component[start:end]):
                a.append(node[start + x])
                b.append(node[start + y])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def tree_links(docs: DataFrame, nodes: DataFrame, known: DataFrame) -> DataFrame:
    """Links (a, b) that unite the known components: all that the sets have, or others that unite the same.

    Groups of one shingle with the same smallest node, their leader, are taken together, as texts that
    share one shingle of their prefixes mostly share many: their nodes meet once, not once a shingle.
    """
    rows = docs.select("text").mapInArrow(_prefixes(frequent_shingles(docs)), "h long, node long, n int, frequent boolean")
    # A frequent shingle's rows are dealt over many tasks; the others' groups are a small share of the input.
    salt = F.when(F.col("frequent"), F.pmod("node", F.lit(1024))).otherwise(F.lit(0))
    group = Window.partitionBy("h", "salt")
    lone = F.min("node").over(group) == F.max("node").over(group)
    met = rows.withColumn("salt", salt).withColumn("lone", lone).where("frequent OR NOT lone")
    named = met.select("h", "node", "n").distinct().join(known.toDF("node", "component"), "node", "left")
    starts = keep(named.withColumn("component", F.coalesce("component", "node")), "starts")
    mixed = starts.groupBy("h").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("node").alias("leader"),
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"),
    )
    parts = F.ceil(F.greatest(F.col("members") / TREE_MOST, F.col("shingles") / SHINGLES_MOST)).cast("int")
    open_groups = mixed.where("low <> high").select("h", "leader", F.when(parts > 1, 2 * parts).otherwise(1).alias("parts"))
    inside = starts.join(open_groups, "h").withColumn("part", F.pmod("node", F.col("parts")).cast("int"))
    spread = inside.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns(
        {"i": F.least("part", "k"), "j": F.greatest("part", "k")}
    )
    pointed = spread.select("leader", "i", "j", "h", "part", "node", "n", "component").join(nodes.select("node", "point"), "node")
    grouped = pointed.repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j", "h", "node")
    left = keep(grouped.mapInArrow(_tree_survivors, "leader long, i int, j int, node long, component long"), "survivors")
    texts = left.select("node").distinct().join(nodes.select("node", F.col("doc_id").alias("id")), "node").join(
        docs, F.col("id").eqNullSafe(F.col("doc_id"))
    )
    sets = keep(texts.select("node", "text").mapInArrow(_sets, "node long, members binary").dropDuplicates(["node"]), "members")
    gathered = left.join(sets, "node").repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j", "node")
    return keep(gathered.mapInArrow(_forests, "a long, b long").distinct(), "links")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and set_id (equal for equal sets) of every document (doc_id long, text)."""
    docs = docs.select("doc_id", "text")
    described = keep(docs.mapInArrow(_described, "doc_id long, n long, node long, check long, keys array<long>, point binary"), "sets")
    some = described.where("n > 0")
    nodes = keep(
        some.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("point").alias("point"),
            (F.min("check") != F.max("check")).alias("clash"),
        ),
        "nodes",
    )
    if not nodes.where("clash").isEmpty():
        raise ValueError("two different sets have one 64-bit name")
    stars = verified(pivots(nodes), nodes, docs)
    known = keep(components(stars), "components")
    links = tree_links(docs, nodes, known)
    placed = nodes.select("node", "doc_id").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if not links.isEmpty():
        of = placed.select("node", "component")
        ends = links.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        merged = keep(components(ends.distinct()), "components").toDF("component", "into")
        placed = placed.join(merged, "component", "left").withColumn("component", F.coalesce("into", "component")).drop("into")
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = placed.join(least, "component").select("node", "component_id")
    return (
        described.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
        .join(names, "node", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.col("node").alias("set_id"),
        )
    )


def _set_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, limit=SLICE_BYTES):
        values, bounds = shingle_sets(text_of(batch, "text"))
        names = pa.array(signatures(values, bounds)[0], mask=bounds[1:] == bounds[:-1])
        yield pa.RecordBatch.from_arrays([batch.column("record"), names], names=["record", "set_id"])


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id, and all without words; all columns."""
    joined = keep(join(docs), "joined")
    chosen = joined.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    if joined.groupBy("doc_id").count().where("count > 1").isEmpty():
        ids = chosen.select(F.col("doc_id").alias("chosen"))
        return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("chosen")), "left_semi")
    # Ids that repeat do not name a row: tell rows apart by id and set, and keep one of each.
    schema = T.StructType().add("record", docs.schema).add("set_id", "long")
    named = docs.select(F.struct("*").alias("record")).mapInArrow(_set_ids, schema)
    pairs = chosen.where("set_id IS NOT NULL").select(F.col("doc_id").alias("chosen"), F.col("set_id").alias("chosen_set")).distinct()
    same = F.col("record.doc_id").eqNullSafe(F.col("chosen")) & (F.col("set_id") == F.col("chosen_set"))
    first = Window.partitionBy("record.doc_id", "set_id").orderBy(F.xxhash64("record"))
    with_words = named.join(pairs, same, "left_semi").withColumn("row", F.row_number().over(first)).where("row = 1")
    return with_words.select("record.*").union(named.where("set_id IS NULL").select("record.*"))
