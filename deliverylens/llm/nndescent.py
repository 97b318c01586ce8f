"""Approximate nearest neighbours: a graph built by NN-descent, searched greedily.

Equal vectors are one node of the graph. Its first edges come from random
projection trees: the top of each tree, chosen on a bounded sample (`SAMPLE`),
deals the nodes to cells, and cells that stay large are halved by jobs until
none has more than `CELL_LIMIT` nodes; a task goes on splitting its cell into
leaves of `LEAF` nodes, whatever the size of the table, and compares each; a leaf
gives a node its `FIRST` nearest. The number of trees grows with the nodes (`trees_for`). Then
NN-descent improves the graph until a round changes less than `STOP` of its
edges: around every node the ends of its edges, in and out, are joined with
their vectors, and each pair of them that has not met there before and is nearer
than the farthest edge of one of the two becomes an edge of it. Of the edges
into a node the nearest `EDGES` count, so a hub does not gather the table.

A search keeps the nearest `BEAM` nodes found for each query, and follows the
edges of all of them that it has not followed yet, until none is left. All
queries search at once; a step is a join with the graph and one with the vectors.

Every valid vector is indexed. Distances are Euclidean, in double precision on
the original components, also in the graph; where the products of two vectors
nearly cancel, from their differences.

Defined cases: vectors that are null, empty or zero, or hold a null or
non-finite component, and rows with a null id take no part, as candidates or
queries; shorter vectors are padded with zeros; of rows of one id the least
vector counts, so repeated rows count once; ties go to the smaller id; a query
with fewer candidates than asked gets all of them; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_tasks, hash_sample, written

EDGES = 32
TREES = 8
#: The graph is done when a round changes less than this share of its edges.
STOP = 0.01
BEAM = 96
ENTRIES = 16
SAMPLE = 8192
CELL = 4096
#: Cells of the top that the driver builds; larger cells than this are halved by jobs.
TOP_CELLS = 1024
CELL_LIMIT = 4 * CELL
LEAF = 512
FIRST = 16
BLOCK = 256
PAIRS = 16_384


# ---------------------------------------------------------------- numpy

def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` from those of ``b``; from the differences where products cancel."""
    both = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None]
    d = both - 2 * (a @ b.T)
    r, c = np.nonzero(d < 1e-6 * both)
    for i in range(0, len(r), PAIRS):
        gap = a[r[i: i + PAIRS]] - b[c[i: i + PAIRS]]
        d[r[i: i + PAIRS], c[i: i + PAIRS]] = (gap * gap).sum(axis=1)
    return d


def nearest(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and squared distances of the k nearest others of each row of ``x``, a block of rows at a time."""
    k = min(k, len(x) - 1)
    at, near = np.empty((len(x), k), np.int64), np.empty((len(x), k))
    for i in range(0, len(x), BLOCK):
        d = squared(x[i: i + BLOCK], x)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        at[i: i + BLOCK] = np.argpartition(d, k - 1, axis=1)[:, :k]
        near[i: i + BLOCK] = np.take_along_axis(d, at[i: i + BLOCK], axis=1)
    return at, near


def _halves(x: np.ndarray, r: np.random.Generator) -> tuple[np.ndarray, float]:
    """Direction and threshold of a split between two random rows that halves ``x``."""
    i, j = r.choice(len(x), 2, replace=False)
    direction = x[i] - x[j]
    return direction, float(np.median(x @ direction))


def build_tree(sample: np.ndarray, cells: int, seed: int) -> list:
    """Nodes (direction, threshold, low child, high child); a negative child c is cell -c - 1."""
    r, nodes, leaves = np.random.default_rng(seed), [], 0

    def grow(x: np.ndarray, want: int) -> int:
        nonlocal leaves
        if want <= 1 or len(x) < 8:
            leaves += 1
            return -leaves
        direction, cut = _halves(x, r)
        low = x @ direction <= cut
        if low.all() or not low.any():
            leaves += 1
            return -leaves
        at = len(nodes)
        nodes.append(None)
        nodes[at] = (direction, cut, grow(x[low], want // 2), grow(x[~low], want - want // 2))
        return at

    grow(sample, cells)
    return nodes


def cells_of(x: np.ndarray, nodes: list) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))] if nodes else []
    while todo:
        at, who = todo.pop()
        if at < 0:
            out[who] = -at - 1
            continue
        direction, cut, low, high = nodes[at]
        side = x[who] @ direction <= cut
        todo += [(low, who[side]), (high, who[~side])]
    return out


def cell_edges(x: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, to, squared distance) of the nearest others of each row within its leaf of a random tree."""
    r, todo, out = np.random.default_rng(seed), [np.arange(len(x))], []
    while todo:
        who = todo.pop()
        if len(who) < 2:
            continue
        if len(who) > LEAF:
            direction, cut = _halves(x[who], r)
            low = x[who] @ direction <= cut
            if low.all() or not low.any():
                low = np.arange(len(who)) % 2 == 0
            todo += [who[low], who[~low]]
            continue
        at, d = nearest(x[who], k)
        out.append((np.repeat(who, at.shape[1]), who[at.ravel()], d.ravel()))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.float64))
    return tuple(np.concatenate(c) for c in zip(*out))


def _matrix(vecs, dtype: str) -> np.ndarray:
    """Rows of vectors kept as bytes, in double precision."""
    vecs = vecs.to_pylist() if hasattr(vecs, "to_pylist") else vecs
    return np.frombuffer(b"".join(vecs), dtype).reshape(len(vecs), -1).astype(np.float64)


# ---------------------------------------------------------------- Spark

def valid(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


class Vectors:
    """The vectors that take part: ``rows`` (vec_id, node), ``nodes`` (node, vec); ``vec``: the components as bytes.
    """

    def __init__(self, table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"):
        spark = table.sparkSession
        arrow_tasks(spark)
        wide = table.schema[vector_col].dataType.elementType != T.FloatType()
        self.dtype = "<f8" if wide else "<f4"
        kind = "double" if wide else "float"
        rows = (table.select(F.col(id_col).cast("long").alias("vec_id"),
                             F.col(vector_col).cast(f"array<{kind}>").alias("x"))
                .where(F.col("vec_id").isNotNull() & valid(F.col("x"))))
        self.size = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
        size, dtype = self.size, self.dtype

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = []
                for v in b["x"].to_pylist():
                    padded = np.zeros(size, dtype)
                    padded[: len(v)] = v
                    out.append((padded + 0.0).astype(dtype))  # -0.0 becomes 0.0
                yield pa.RecordBatch.from_arrays(
                    [b["vec_id"], pa.array([v.tobytes() for v in out], pa.binary())], ["vec_id", "vec"])

        packed = rows.groupBy("vec_id").agg(F.min("x").alias("x")).mapInArrow(pack, "vec_id long, vec binary")
        packed = written(packed, "vectors")
        self.nodes = written(packed.groupBy("vec").agg(F.min("vec_id").alias("node"))
                             .select("node", "vec"), "nodes")
        self.rows = written(packed.join(self.nodes.select("node", "vec"), "vec").select("vec_id", "node"), "members")


def _best(pairs: DataFrame, by: str, k: int) -> DataFrame:
    """Of (by, to, d) the k nearest of each, every pair once; no group is larger than k in any shuffle's output."""
    once = pairs.groupBy(by, "to").agg(F.min("d").alias("d"))
    order = Window.partitionBy(by).orderBy("d", "to")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def trees_for(n: int) -> int:
    """Trees over ``n`` nodes: one more for each doubling beyond what `TREES` trees serve."""
    return TREES + max(0, int(np.ceil(np.log2(max(1, n) / (TREES * 4 * LEAF)))))


def halved(dealt: DataFrame, vectors: Vectors, limit: int) -> DataFrame:
    """(tree, cell, node) with every cell of more than ``limit`` nodes split until none is left.

    A level splits all of them at once: each between two of its nodes, chosen by hash, at about the median.
    """
    nodes, dtype, level = vectors.nodes, vectors.dtype, 0

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.zeros(0)
            if b.num_rows:
                at = (_matrix(b["vec"], dtype) * (_matrix(b["a"], dtype) - _matrix(b["b"], dtype))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([b["tree"], b["cell"], b["node"], pa.array(at, pa.float64())],
                                             ["tree", "cell", "node", "at"])

    while True:
        h = F.xxhash64("node", F.lit(level))
        large = written(dealt.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("n"), F.min_by("node", h).alias("one"),
                                                          F.max_by("node", h).alias("two"))
                        .where(F.col("n") > limit).drop("n"), "large_cells")
        if large.limit(1).count() == 0:
            return dealt
        end = lambda name, vec: nodes.select(F.col("node").alias(name), F.col("vec").alias(vec))
        ends = large.join(end("one", "a"), "one").join(end("two", "b"), "two").select("tree", "cell", "a", "b")
        at = written(dealt.join(ends, ["tree", "cell"]).join(nodes, "node").select("tree", "cell", "node", "vec", "a", "b")
                     .mapInArrow(projected, "tree int, cell long, node long, at double"), "projected")
        cuts = at.groupBy("tree", "cell").agg(F.percentile_approx("at", 0.5).alias("cut"), F.min("at").alias("least"),
                                              F.max("at").alias("most"))
        # Where all lie at the cut there is no direction: such cells are halved by hash.
        side = (F.when(F.col("most") > F.col("least"), F.when(F.col("cut") < F.col("most"), F.col("at") <= F.col("cut"))
                       .otherwise(F.col("at") < F.col("cut"))).otherwise(F.pmod(h, F.lit(2)) == 0))
        split = at.join(cuts, ["tree", "cell"]).select("tree", F.xxhash64("cell", side).alias("cell"), "node")
        dealt = written(dealt.join(large, ["tree", "cell"], "left_anti").select("tree", "cell", "node")
                        .unionByName(split), "cells")
        level += 1


def first_edges(vectors: Vectors, k: int = EDGES, trees: int | None = None, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(node, to, d) from the leaves of random projection trees; d is the squared distance."""
    nodes, dtype = vectors.nodes, vectors.dtype
    n = nodes.count()
    sample = [bytes(r.vec) for r in hash_sample(nodes.select("node", "vec"), SAMPLE, "node").collect()]
    cells = min(TOP_CELLS, -(-n // CELL))
    tops = [build_tree(_matrix(sample, dtype), cells, seed) if sample else []
            for seed in range(trees_for(n) if trees is None else trees)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b["vec"], dtype) if b.num_rows else np.zeros((0, 1))
            for t, top in enumerate(tops):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t), pa.int32()),
                                                  pa.array(cells_of(x, top), pa.int64()), b["node"]],
                                                 ["tree", "cell", "node"])

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("node")
        ids = table["node"].to_numpy()
        a, b, d = cell_edges(_matrix(table["vec"], dtype), min(k, FIRST), int(table["tree"][0].as_py()))
        return pa.table({"node": ids[a], "to": ids[b], "d": d})

    dealt = written(nodes.select("node", "vec").mapInArrow(deal, "tree int, cell long, node long"), "cells")
    dealt = halved(dealt, vectors, cell_limit).join(nodes, "node").select("tree", "cell", "node", "vec")
    return _best(dealt.groupBy("tree", "cell").applyInArrow(compare, "node long, to long, d double"), "node", k)


def surroundings(edges: DataFrame, vectors: Vectors, k: int = EDGES) -> DataFrame:
    """(at, member): every node with the ends of its edges, out and in, and itself."""
    # In-edges: the k nearest of each node, so that a hub does not grow.
    back = _best(edges.select(F.col("to").alias("at"), F.col("node").alias("to"), "d"), "at", k)
    return (edges.select(F.col("node").alias("at"), F.col("to").alias("member"))
            .unionByName(back.select("at", F.col("to").alias("member")))
            .unionByName(vectors.nodes.select(F.col("node").alias("at"), F.col("node").alias("member"))).distinct())


def improved(edges: DataFrame, vectors: Vectors, k: int = EDGES, around: DataFrame | None = None,
             met: DataFrame | None = None) -> DataFrame:
    """One round of NN-descent over (node, to, d).

    ``around``: the `surroundings` of the edges; ``met``: those of the round before, whose pairs have been compared.
    """
    dtype = vectors.dtype
    far = edges.groupBy("node").agg(F.max("d").alias("far"), F.count(F.lit(1)).alias("n"))
    far = far.select(F.col("node").alias("member"), F.when(F.col("n") < k, float("inf")).otherwise(F.col("far")).alias("far"))
    around = surroundings(edges, vectors, k) if around is None else around
    if met is None:
        around = around.withColumn("fresh", F.lit(True))
    else:
        around = around.join(met.withColumn("old", F.lit(True)), ["at", "member"], "left").select(
            "at", "member", F.col("old").isNull().alias("fresh"))
        # Where nobody is new, all pairs have met: such nodes go before their vectors are fetched.
        lists = around.groupBy("at").agg(F.collect_list(F.struct("member", "fresh")).alias("m"))  # 2 k + 1 at most
        around = lists.where(F.exists("m", lambda x: x.fresh)).select("at", F.explode("m").alias("m")).select("at", "m.*")
    known = vectors.nodes.select(F.col("node").alias("member"), "vec").join(far, "member", "left")
    held = (around.join(known, "member")
            .groupBy("at").agg(F.collect_list(F.struct("member", F.coalesce("far", F.lit(float("inf"))).alias("far"),
                                                       "vec", "fresh")).alias("m")))  # 2 k + 1 at most

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b["m"]
            ends = m.offsets.to_numpy() - m.offsets[0].as_py()
            flat = m.flatten()
            ids, limit = flat.field("member").to_numpy(), flat.field("far").to_numpy()
            fresh = flat.field("fresh").to_numpy(zero_copy_only=False).astype(bool)
            x = _matrix(flat.field("vec"), dtype) if len(flat) else np.zeros((0, 1))
            out = []
            for i, j in zip(ends[:-1], ends[1:]):
                if j - i < 2:
                    continue
                d = squared(x[i:j], x[i:j])
                np.fill_diagonal(d, np.inf)
                r, c = np.nonzero((d < limit[i:j, None]) & (fresh[i:j, None] | fresh[None, i:j]))
                out.append((ids[i:j][r], ids[i:j][c], d[r, c]))
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["node", "to", "d"])

    return _best(edges.unionByName(held.select("m").mapInArrow(meet, "node long, to long, d double")), "node", k)


def build(vectors: Vectors, k: int = EDGES, trees: int | None = None, stop: float = STOP) -> DataFrame:
    """(node, to, d): the graph after the first round that changes less than ``stop`` of its edges."""
    edges = written(first_edges(vectors, k, trees), "edges")
    met = None
    while True:
        around = written(surroundings(edges, vectors, k), "around")
        after = written(improved(edges, vectors, k, around, met), "edges")
        changed = after.join(edges.select("node", "to"), ["node", "to"], "left_anti").count()
        edges, met = after, around
        if changed <= stop * after.count():
            return edges


def distances(pairs: DataFrame, dtype: str) -> DataFrame:
    """(query, to, d) of (query, to, a, b): the Euclidean distance of vectors a and b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            gap = _matrix(b["a"], dtype) - _matrix(b["b"], dtype)
            yield pa.RecordBatch.from_arrays([b["query"], b["to"], pa.array(np.sqrt((gap * gap).sum(axis=1)))],
                                             ["query", "to", "d"])
    return pairs.select("query", "to", "a", "b").mapInArrow(run, "query long, to long, d double")


def search(queries: DataFrame, edges: DataFrame, vectors: Vectors, beam: int = BEAM) -> DataFrame:
    """(query, to, d): the nodes nearest to each query's vector that a greedy search finds, ``beam`` at most.

    ``queries``: (query, vec); a query that is itself a node starts there too.
    """
    nodes, dtype = vectors.nodes, vectors.dtype
    # Edges are followed both ways; in-edges are kept to the nearest ones of each node.
    back = _best(edges.select(F.col("to").alias("at"), F.col("node").alias("to"), "d"), "at", EDGES)
    ways = written(edges.select(F.col("node").alias("at"), "to").unionByName(back.select("at", "to")).distinct(), "ways")
    entries = nodes.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).select("node", "vec").collect()
    here = queries.select("query", F.col("vec").alias("a"))
    places = [F.struct(F.lit(r.node).alias("to"), F.lit(bytes(r.vec)).alias("b")) for r in entries]
    at = F.explode(F.array(*places)) if places else F.explode(F.array().cast("array<struct<to:bigint,b:binary>>"))
    starts = (here.withColumn("e", at).select("query", "a", F.col("e.to").alias("to"), F.col("e.b").alias("b"))
              .unionByName(here.join(nodes.select(F.col("node").alias("to"), F.col("vec").alias("b")),
                                     F.col("query") == F.col("to"))).distinct())
    found = distances(starts, dtype).withColumn("done", F.lit(False))
    order = Window.partitionBy("query").orderBy("d", "to")
    while True:
        # The nearest of each query, followed or not.
        found = written(found.groupBy("query", "to").agg(F.min("d").alias("d"), F.max("done").alias("done"))
                        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= beam).drop("rank"), "beam")
        front = found.where("NOT done")
        if front.limit(1).count() == 0:
            return found.drop("done")
        new = (front.select("query", F.col("to").alias("at")).join(ways, "at").select("query", "to").distinct()
               .join(found.select("query", "to"), ["query", "to"], "left_anti"))
        near = distances(new.join(nodes.select(F.col("node").alias("to"), F.col("vec").alias("b")), "to")
                         .join(here, "query"), dtype)
        found = found.withColumn("done", F.lit(True)).unionByName(near.withColumn("done", F.lit(False)))


def nearest_ids(table: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose vec_id is divisible by ``every``."""
    vectors = Vectors(table)
    asked = vectors.rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "node")
    # One search for all queries with one vector.
    starts = written(asked.select("node").distinct().join(vectors.nodes, "node")
                     .select(F.col("node").alias("query"), "vec"), "queries")
    found = search(starts, build(vectors), vectors)
    # The k + 1 smallest ids of each node, and of each query: one may be the query itself.
    by_node = Window.partitionBy("node").orderBy("vec_id")
    members = vectors.rows.withColumn("nth", F.row_number().over(by_node)).where(F.col("nth") <= k + 1)
    order = Window.partitionBy("query").orderBy("d", "vec_id")
    near = (found.join(members.select(F.col("node").alias("to"), "vec_id"), "to")
            .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
            .select(F.col("query").alias("node"), "vec_id", "d"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))
    return (asked.join(near, "node").where("vec_id <> query_id").withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("d").alias("score")))
