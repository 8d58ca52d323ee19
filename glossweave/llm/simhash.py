"""SimHash near-duplicates with vantage-point trees.

Texts get 64-bit fingerprints of their word shingles; equal fingerprints are one point from there on. Two points are linked if at most
`radius` bits differ. If the bits are cut into t = radius // 2 + 1 blocks, two linked points differ by at most one bit in some block, so each block
has a vantage-point tree of its own over the Hamming distance within the block: a node sends points within the median distance of its vantage
point to one side, the rest to the other. A point has one home leaf a tree; as a query it goes to every leaf that the triangle inequality
can't exclude, that is, across every boundary its ball overlaps. A leaf is a shard; pairs are exact over all 64 bits.

Trees are laid out from a sample of SAMPLE points at most, which decides only where shards end: every point is routed and compared. A ball of
radius 1 in a block of 21 or 22 bits holds 23 values at most, so a point goes to 23 leaves a tree at most, however many leaves there are.
A leaf whose points can't be told apart in its block is dealt over several shards: homes to one, visitors to all. Shards report a spanning
forest of their links, never all pairs of a group; components come from alternating star contractions of those links.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, drop_stash, narrow, stash, thrifty

SAMPLE, LEAF = 8192, 2000
BROADCAST_ROWS = 1_000_000
FEW_EDGES = 1 << 20


def fingerprint(text: bytes, k: int) -> int:
    """64-bit SimHash of the k-word shingles' XXH64 (seed 42): a bit is set if it is set in over half of them."""
    words = text.lower().split()  # ASCII only, as these are bytes
    if not words:
        return 0
    if len(words) <= k:
        shingles = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[: len(words) - k]]).tolist()
        shingles = [line[s:e] for s, e in zip(starts, (ends[k - 1 :] - 1).tolist())]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, 42) for s in shingles], np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """(doc_id, fp long) for each row of docs: the fingerprint's bits as a signed number. A text without words, or null, has 0."""
    arrow_limits(docs.sparkSession)

    def run(batches):
        for b in batches:
            h = np.array([fingerprint((t.as_py() or "").encode(), shingle) for t in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(h.view(np.int64), pa.int64())], ["doc_id", "fp"])

    return narrow(docs, id_col, text_col).mapInArrow(thrifty(run), "doc_id long, fp long")


@dataclass
class Tree:
    """A vantage-point tree over the bits of mask; node i has children 2 at kids[i], or is leaf number -kids[i] - 1."""

    mask: int
    radius: int
    vantage: list[int] = field(default_factory=list)
    bound: list[int] = field(default_factory=list)
    kids: list[tuple[int, int] | None] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    parts: list[int] = field(default_factory=list)  # by leaf: shards it is dealt over

    def grow(self, points: np.ndarray, weight: float, rng: np.random.Generator, depth: int = 0) -> int:
        """Add the subtree of the sample's points, each of which stands for weight points; returns its root."""
        node = len(self.kids)
        for x in (self.vantage, self.bound):
            x.append(0)
        self.kids.append(None)
        self.leaf.append(-1)
        if len(points) * weight > LEAF and depth < 40:
            choices = points[rng.integers(0, len(points), 4)]
            spread = [np.bitwise_count((points ^ v) & np.uint64(self.mask)) for v in choices]
            best = max(range(4), key=lambda i: spread[i].std())
            d, bound = spread[best], int(np.median(spread[best]))
            if not (d > bound).any():
                bound -= 1
            if (d <= bound).any():
                self.vantage[node], self.bound[node] = int(choices[best]), bound
                near = self.grow(points[d <= bound], weight, rng, depth + 1)
                self.kids[node] = (near, self.grow(points[d > bound], weight, rng, depth + 1))
                return node
        self.leaf[node] = len(self.parts)
        self.parts.append(max(1, round(len(points) * weight / (4 * LEAF))))
        return node

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the point, leaf, and whether the leaf is its home, for every leaf that the point's ball may overlap."""
        index, leaves, homes = [], [], []
        stack = [(0, np.arange(len(points)), np.ones(len(points), bool))]
        while stack:
            node, at, home = stack.pop()
            if not len(at):
                continue
            if self.kids[node] is None:
                index.append(at)
                leaves.append(np.full(len(at), self.leaf[node]))
                homes.append(home)
                continue
            d = np.bitwise_count((points[at] ^ np.uint64(self.vantage[node])) & np.uint64(self.mask)).astype(np.int64)
            inner = d <= self.bound[node]
            near, far = d - self.radius <= self.bound[node], d + self.radius > self.bound[node]
            stack.append((self.kids[node][0], at[near], (home & inner)[near]))
            stack.append((self.kids[node][1], at[far], (home & ~inner)[far]))
        if not index:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
        return np.concatenate(index), np.concatenate(leaves), np.concatenate(homes)


def masks(trees: int) -> list[int]:
    cut = [64 * i // trees for i in range(trees + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cut[:-1], cut[1:])]


def connect(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; parent maps each item to the smallest item of its set."""
    while len(a):
        a, b = parent[a], parent[b]
        ne = a != b
        a, b = a[ne], b[ne]
        if not len(a):
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def routed(points: DataFrame, n: int, radius: int) -> DataFrame:
    """points (fp and any columns) at every shard they belong to: (tree, leaf, shard, home, all columns)."""
    sample = np.array([r.fp for r in points.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    rng, trees = np.random.default_rng(7), []
    for mask in masks(radius // 2 + 1):
        trees.append(Tree(mask, radius // (radius // 2 + 1)))
        trees[-1].grow(sample, n / max(1, len(sample)), rng)

    def route(batches):
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for t, tree in enumerate(trees):
                at, leaf, home = tree.route(fp)
                parts = np.array(tree.parts)
                own = (fp[at] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts[leaf]
                # A visitor goes to all shards of a leaf; so does a point at home, as a visitor to the shards it doesn't live in.
                count = parts[leaf]
                rep = np.repeat(np.arange(len(at)), count)
                shard = np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count)
                own_columns = b.take(pa.array(at[rep]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rep), t, np.int32)), pa.array(leaf[rep].astype(np.int32)), pa.array(shard.astype(np.int32)), pa.array(home[rep] & (shard == own[rep])), *own_columns.columns],
                    ["tree", "leaf", "shard", "home", *b.schema.names],
                )

    kept = ", ".join(f"{c} {k}" for c, k in points.dtypes)
    return points.mapInArrow(thrifty(route), f"tree int, leaf int, shard int, home boolean, {kept}")


def links(points: DataFrame, n: int, radius: int) -> DataFrame:
    """(u, v), u > v: spanning forests of all pairs of points (fp) that differ in 1 to radius bits."""

    def pairs(_, table):
        fp, home = table["fp"].to_numpy().view(np.uint64), table["home"].to_numpy()
        order = np.argsort(fp)
        fp, home = fp[order], home[order]
        parent, rows = np.arange(len(fp)), np.flatnonzero(home)
        step = max(1, (1 << 21) // max(1, len(fp)))
        for i in range(0, len(rows), step):
            near = np.bitwise_count(fp[rows[i : i + step], None] ^ fp[None, :]) <= radius
            a, b = np.nonzero(near)
            connect(parent, rows[a + i], b)
        child = np.flatnonzero(parent != np.arange(len(fp)))
        signed = fp.view(np.int64)
        a, b = signed[child], signed[parent[child]]
        return pa.table({"u": np.maximum(a, b), "v": np.minimum(a, b)})

    return routed(points.select("fp"), n, radius).groupBy("tree", "leaf", "shard").applyInArrow(pairs, "u long, v long")


def forest(batches):
    """For mapInArrow over all edges (u, v) of a graph in one task: each node but the smallest of its component with the smallest."""
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*parts) if parts else ((), ())))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = np.arange(len(nodes))
    connect(parent, at[: len(u)], at[len(u) :])
    child = np.flatnonzero(parent != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[child]), pa.array(nodes[parent[child]])], ["u", "v"])


def stars(edges: DataFrame) -> DataFrame:
    """(u, v): each node of the edges that isn't the smallest of its component, with the smallest; a table of the shared folder.

    Up to FEW_EDGES edges, 16 MB, are joined by one task. More go through alternating large and small stars until nothing changes.
    A node's smallest neighbour is a partial aggregate, and is joined back one row to many. The joins are merges at every size: dozens of small
    broadcasts would all go through the driver.
    """
    every = stash(edges.select("u", "v"), "edges")
    if every.count() <= FEW_EDGES:
        roots = stash(every.coalesce(1).mapInArrow(thrifty(forest), "u long, v long"), "roots")
        drop_stash(every)
        return roots
    current = stash(every.distinct(), "edges")
    drop_stash(every)
    while True:
        # Nothing is left to do when every node has one edge to a smaller one, and that one has none.
        ends = current.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(current.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").isEmpty():
            return current
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))  # here v < u always
        small = large.join(down.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        after = stash(small.distinct(), "edges")
        drop_stash(current)
        current = after


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, radius: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id reachable by links of at most radius differing bits, the document's own included.

    One row for each row of docs. Null ids get the component of their fingerprint, null if it has no other id. Other columns aren't read.
    """
    marked = stash(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "fingerprints")
    points = stash(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    n = points.count()
    roots = stars(links(points, n, radius))
    named = points.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")
