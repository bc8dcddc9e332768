"""Approximate nearest neighbours: NN-descent builds a graph, queries search it greedily.

Equal vectors are one node of the graph, named by their smallest vec_id, so a vector that occurs very often is no hub; its
rows come back when results are written. The graph starts from random projection trees: their borders are fitted on a
bounded sample (``SAMPLE`` nodes), and leaves that are still large are split by planes fitted on their own nodes, so a leaf
has about ``LEAF`` nodes in a table of any size. All nodes of a leaf are compared. A leaf is a smaller share of a larger table,
so that gets more trees; otherwise its first graph would be worse and more steps, with more rows each, would follow.
NN-descent then improves the graph: each node brings together its neighbours and those it is a neighbour of, and every two
of them, at least one of them new, try to become neighbours, until hardly an edge changes. The recall of the edges is
measured on some nodes whose nearest are known exactly; while it is too low, nodes keep longer lists.

A search begins at the query's own node. Each step joins the best nodes not yet expanded with the graph in both
directions and keeps the ``BEAM`` nearest, until no query has anything left to expand. Distances in the search are
exact, in double precision, on the original vectors.

Vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do rows without vec_id and vectors
whose length is not the most frequent one (of several, the longest). Of rows with the same vec_id the smallest vector
counts. An empty table gives no rows. Extra columns are never read.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import mixed, staged

K, WIDER = 32, 8  # neighbours a node keeps at least, and more for every doubling of the table beyond FEW nodes
FEW = 16_384
TREES, MORE, LEAF = 4, 4, 1024  # trees at least, and more for every doubling of the table beyond FEW nodes; nodes of a leaf
SAMPLE = 20_000  # nodes on which the borders of a tree, or of a part of it, are fitted at once
SETTLED = 0.002  # share of changed edges at which the steps end
GOAL, PROBES, SLOW = 0.9, 256, 0.05  # recall a graph must reach, nodes it is measured on, changed edges at which it is due
FILL = 8  # edges a node gets from each step's group while its longer list is filled
BEAM = 128
NODE_BLOCK = 1000  # nodes whose vectors are in a task at once during a search
TOP = 10
MERGED = 5000  # lists of the first graph that are merged at once, at least
EDGES = "node long, nbr long, dist float, new boolean"


def usable(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vec (array of double) of the rows that take part, one per vec_id."""
    doubles = F.col(vector).cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), doubles.alias("vec")).where("vec_id IS NOT NULL AND vec IS NOT NULL")
    rows = rows.where(finite).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    length = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("vec") == (length.d if length else 0))


def _matrix(column: pa.Array, dtype: type = np.float32) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1 if len(column) else 1).astype(dtype)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of rows with the same first column, across batches; the rows come sorted by it."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if waiting and waiting[0].column(0)[0].as_py() != key[a]:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting = []
            waiting.append(batch.slice(a, b - a))
            if b < len(key):
                yield waiting[0] if len(waiting) == 1 else pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting = []
    if waiting:
        yield waiting[0] if len(waiting) == 1 else pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def _distances(x: np.ndarray) -> np.ndarray:
    norms = (x**2).sum(1)
    return np.maximum(norms[:, None] + norms - 2 * (x @ x.T), 0)


def _edges(a: list[np.ndarray], b: list[np.ndarray], d: list[np.ndarray]) -> pa.RecordBatch:
    n = sum(map(len, a))
    parts = [pa.array(np.concatenate(x) if x else np.zeros(0, t)) for x, t in ((a, np.int64), (b, np.int64), (d, np.float32))]
    return pa.RecordBatch.from_arrays([*parts, pa.array(np.ones(n, bool))], names=["node", "nbr", "dist", "new"])


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest different neighbours of each node; an edge that was there before is not new."""
    once = edges.groupBy("node", "nbr").agg(F.min("dist").alias("dist"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("dist", "nbr"))
    return once.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def _grown(least: int, more: int, n: int) -> int:
    """A number that grows by ``more`` for every doubling of the table beyond FEW nodes."""
    return least + round(more * max(0.0, math.log2(max(n, 1) / FEW)))


# --- the first graph ---


def _planes(sample: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A perfect tree of planes between two random sample points each, through the middle of their node."""
    r = np.random.default_rng(seed)
    normals, borders = np.zeros((2**depth - 1, sample.shape[1]), np.float32), np.zeros(2**depth - 1, np.float32)
    inside = {0: np.arange(len(sample))}
    for node in range(2**depth - 1):
        rows = inside.pop(node)
        if len(rows) > 1:
            i, j = r.choice(len(rows), 2, replace=False)
            normals[node] = sample[rows[i]] - sample[rows[j]]
        value = sample[rows] @ normals[node]
        borders[node] = np.median(value) if len(rows) else 0
        right = value > borders[node]
        inside[2 * node + 1], inside[2 * node + 2] = rows[~right], rows[right]
    return normals, borders


def _depth(n: int, sample: int) -> int:
    return max(0, min(math.ceil(math.log2(max(1, n / LEAF))), int(math.log2(max(1, sample / 8)))))


def _down(leaf: np.ndarray, ids: np.ndarray, x: np.ndarray, planes: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    """The leaves under ``leaf`` that the vectors belong to; a leaf's children are 2 leaf and 2 leaf + 1. What lies in a plane goes to either side."""
    normals, borders = planes
    at = np.zeros(len(x), np.int64)
    for level in range(depth):
        value = np.einsum("ij,ij->i", x, normals[at])
        either = (mixed(ids.astype(np.uint64) + leaf.astype(np.uint64)) >> np.uint64(level)) & np.uint64(1) == 1
        right = (value > borders[at]) | ((value == borders[at]) & either)
        at = 2 * at + 1 + right
    return (leaf << depth) + at - (2**depth - 1)


def _split(large: DataFrame) -> DataFrame:
    """Leaves (tree, leaf, size, node, vec) in parts of about LEAF nodes, by planes fitted on nodes of the leaf; only these are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, planes, depth = None, None, 0
        waiting: list[pa.RecordBatch] = []

        def out(part: pa.RecordBatch) -> pa.RecordBatch:
            leaf = _down(part.column(1).to_numpy(), part.column(3).to_numpy(), _matrix(part.column(4)), planes, depth)
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(leaf), part.column(3), part.column(4)], names=["tree", "leaf", "node", "vec"])

        def fitted() -> Iterator[pa.RecordBatch]:
            nonlocal planes, depth, waiting
            sample = np.concatenate([_matrix(w.column(4)) for w in waiting])[:SAMPLE]
            depth = max(1, _depth(waiting[0].column(2)[0].as_py(), len(sample)))
            planes = _planes(sample, depth, hash(key) & 0x7FFFFFFF)
            yield from map(out, waiting)
            waiting = []

        for batch in batches:
            if not batch.num_rows:
                continue
            tree, leaf = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((tree[1:] != tree[:-1]) | (leaf[1:] != leaf[:-1])) + 1).tolist(), len(leaf)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if key != (int(tree[a]), int(leaf[a])):
                    if waiting:
                        yield from fitted()
                    key, planes = (int(tree[a]), int(leaf[a])), None
                part = batch.slice(a, b - a)
                if planes is not None:
                    yield out(part)
                    continue
                waiting.append(part)
                if sum(w.num_rows for w in waiting) >= SAMPLE:
                    yield from fitted()
        if waiting:
            yield from fitted()

    rows = large.select("tree", "leaf", "size", "node", "vec").repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", F.xxhash64("node"))
    return rows.mapInArrow(run, "tree int, leaf long, node long, vec array<float>")


def _leaves(nodes: DataFrame, n: int) -> DataFrame:
    """node, vec and one leaf per tree (tree, leaf), of about LEAF nodes and 2 LEAF at most, whatever n is."""
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vec").toArrow()
    sample = _matrix(rows["vec"].combine_chunks())
    depth = _depth(n, len(sample))
    trees = [_planes(sample, depth, seed) for seed in range(_grown(TREES, MORE, n))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for t, planes in enumerate(trees):
                leaf = _down(np.ones(len(x), np.int64), ids, x, planes, depth)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(leaf), batch.column(0), batch.column(1)], names=["tree", "leaf", "node", "vec"])

    placed = staged(nodes.select("node", "vec").mapInArrow(run, "tree int, leaf long, node long, vec array<float>"), "leaves")
    small: DataFrame | None = None
    while True:
        large = placed.groupBy("tree", "leaf").agg(F.count("*").alias("size")).where(F.col("size") > 2 * LEAF)
        large = staged(large, "large-leaves")
        rest = placed.join(large.select("tree", "leaf"), ["tree", "leaf"], "left_anti")
        small = rest if small is None else small.unionByName(rest)
        if large.isEmpty():
            return small
        placed = staged(_split(placed.join(large, ["tree", "leaf"])), "leaves")


def _first_graph(placed: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node among those it shares a leaf with. A leaf sends one list per node, not a row per edge."""
    rows = placed.select(F.xxhash64("tree", "leaf").alias("block"), "node", "vec")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            ids, x = group.column(1).to_numpy(), _matrix(group.column(2))
            if len(ids) < 2:
                continue
            d = _distances(x)
            np.fill_diagonal(d, np.inf)
            m = min(k, len(ids) - 1)
            near = np.argpartition(d, m - 1, axis=1)[:, :m]
            ends = pa.array(np.arange(0, len(ids) * m + 1, m, dtype=np.int32))
            dists = np.take_along_axis(d, near, 1).astype(np.float32).ravel()
            columns = [pa.array(ids), pa.ListArray.from_arrays(ends, pa.array(ids[near].ravel())), pa.ListArray.from_arrays(ends, pa.array(dists))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "nbrs", "dists"])

    def nearest_of(whole: pa.RecordBatch) -> pa.RecordBatch:
        a = np.repeat(whole.column(0).to_numpy(), whole.column(1).value_lengths().to_numpy())
        b, d = whole.column(1).flatten().to_numpy(), whole.column(2).flatten().to_numpy()
        order = np.lexsort((d, b, a))
        a, b, d = a[order], b[order], d[order]
        once = np.ones(len(a), bool)
        once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b, d = a[once], b[once], d[once]
        order = np.lexsort((b, d, a))
        order = order[np.arange(len(a)) - np.searchsorted(a, a) < k]  # a is sorted before and after
        return _edges([a[order]], [b[order]], [d[order]])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(w.num_rows for w in waiting) >= MERGED:
                whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                ids = whole.column(0).to_numpy()
                cut = int(np.searchsorted(ids, ids[-1]))  # more lists of the last node may follow
                yield nearest_of(whole.slice(0, cut))
                waiting = [whole.slice(cut)]
        if sum(w.num_rows for w in waiting):
            yield nearest_of(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])

    found = rows.repartition("block").sortWithinPartitions("block").mapInArrow(lists, "node long, nbrs array<long>, dists array<float>")
    return staged(found.repartition("node").sortWithinPartitions("node").mapInArrow(merged, EDGES), "graph")


# --- NN-descent ---


def _joined(left: pa.Table, right: pa.Table, fill: int | None) -> pa.Table:
    """Edges among the members of each node of a block. left: the members' reach and vectors; right: u, of (a member), new."""
    a, b, d = [], [], []
    if left.num_rows and right.num_rows:
        ids, x, reach = left["member"].to_numpy(), _matrix(left["vec"].combine_chunks()), left["reach"].to_numpy()
        order = np.argsort(ids)
        ids, x, reach = ids[order], x[order], reach[order]
        norms = (x**2).sum(1)
        u, new = right["u"].to_numpy(), right["new"].to_numpy()
        order = np.argsort(u, kind="stable")
        at, new = np.searchsorted(ids, right["of"].to_numpy()[order]), new[order]
        ends = np.append(np.flatnonzero(np.diff(u[order])) + 1, len(u))
        for i, j in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
            m, w = at[i:j], new[i:j]
            y = x[m]
            near = np.maximum(norms[m][:, None] + norms[m] - 2 * (y @ y.T), 0)
            good = (near < reach[m][:, None]) & (w[:, None] | w)
            np.fill_diagonal(good, False)
            if fill is not None and len(m) > fill:
                kept = np.argpartition(np.where(good, near, np.inf), fill - 1, axis=1)[:, :fill]
                few = np.zeros_like(good)
                np.put_along_axis(few, kept, True, axis=1)
                good &= few
            p, q = np.nonzero(good)
            a.append(m[p].astype(np.int32))
            b.append(m[q].astype(np.int32))
            d.append(near[p, q])
            if len(a) % 64 == 0:
                a, b, d = ([v] for v in _once(a, b, d))
        a, b, d = _once(a, b, d)
        a, b = ids[a], ids[b]
    return pa.table([pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64)), pa.array(np.asarray(d, np.float32)), pa.array(np.ones(len(a), bool))], names=["node", "nbr", "dist", "new"])


def _once(a: list[np.ndarray], b: list[np.ndarray], d: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair once: several nodes of a block may bring it together."""
    a, b, d = np.concatenate(a), np.concatenate(b), np.concatenate(d)
    _, first = np.unique(a.astype(np.int64) << 32 | b, return_index=True)
    return a[first], b[first], d[first]


def _step(graph: DataFrame, nodes: DataFrame, home: DataFrame, k: int, fill: int | None = None) -> DataFrame:
    """Edges that the neighbours of each node found among themselves and that may improve one of their lists.

    Nodes of a leaf are worked on together, as they share many neighbours: a vector is sent once per leaf that needs it.
    """
    ahead = graph.select(F.col("node").alias("u"), F.col("nbr").alias("member"), "new")
    back = graph.select(F.col("nbr").alias("u"), F.col("node").alias("member"), "new")
    order = Window.partitionBy("u").orderBy(F.desc("new"), F.xxhash64("member", "u"))
    back = back.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k * 2 // 3).drop("_r")
    members = ahead.union(back).groupBy("u", "member").agg(F.max("new").alias("new"))
    # Two members are compared if one of them is new, so nodes without a new member send nothing.
    members = members.join(home, "u").withColumn("_any", F.max("new").over(Window.partitionBy("u")))
    members = staged(members.where("_any").select("block", "u", "member", "new"), "members")
    reach = graph.groupBy("node").agg(F.when(F.count("*") < k, float("inf")).otherwise(F.max("dist")).cast("float").alias("reach"))
    carried = nodes.join(reach, "node", "left").select(F.col("node").alias("member"), F.coalesce("reach", F.lit(float("inf")).cast("float")).alias("reach"), "vec")
    wanted = members.select("block", "member").distinct().join(carried, "member").select("block", "member", "reach", "vec")
    asking = members.select(F.col("block").alias("by"), "u", F.col("member").alias("of"), "new")
    return wanted.groupBy("block").cogroup(asking.groupBy("by")).applyInArrow(lambda left, right: _joined(left, right, fill), EDGES)


def _exact_lists(nodes: DataFrame, top: int) -> DataFrame:
    """node, nbr: the exact nearest of PROBES nodes, by one pass over all nodes."""
    probes = nodes.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(PROBES).toArrow()
    own, x = probes["node"].to_numpy(), _matrix(probes["vec"].combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, names = np.full((len(own), 0), np.inf, np.float32), np.zeros((len(own), 0), np.int64)
        for batch in batches:
            if batch.num_rows:
                ids, y = batch.column(0).to_numpy(), _matrix(batch.column(1))
                d = np.maximum((x**2).sum(1)[:, None] + (y**2).sum(1) - 2 * (x @ y.T), 0)
                d[own[:, None] == ids] = np.inf
                near, names = np.concatenate([near, d], 1), np.concatenate([names, np.broadcast_to(ids, d.shape)], 1)
                best = np.argsort(near, axis=1)[:, :top]
                near, names = np.take_along_axis(near, best, 1), np.take_along_axis(names, best, 1)
        ok = np.isfinite(near)
        yield _edges([np.broadcast_to(own[:, None], near.shape)[ok]], [names[ok]], [near[ok]])

    return staged(_nearest(nodes.select("node", "vec").mapInArrow(run, EDGES), top).select("node", "nbr"), "exact")


def _recall(graph: DataFrame, exact: DataFrame) -> float:
    n = exact.count()
    return graph.join(exact, ["node", "nbr"]).count() / n if n else 1.0


def _let_go(nodes: DataFrame) -> None:
    """Shuffle files of steps that are done go with the objects that name them."""
    gc.collect()
    nodes.sparkSession._jvm.System.gc()


def build_graph(nodes: DataFrame) -> DataFrame:
    """node, nbr, dist (squared): nearest of every node (columns node, vec).

    Steps go on until hardly an edge changes. Where the graph has then, or will have, less than GOAL of the true nearest
    of the probes, lists become longer and the steps go on, at the most until every node has all others.
    """
    n = nodes.count()
    k = max(1, min(n - 1, _grown(K, WIDER, n)))
    placed = _leaves(nodes, n)
    home = staged(placed.where("tree = 0").select(F.col("node").alias("u"), F.col("leaf").alias("block")), "home")
    graph, exact = _first_graph(placed, k), _exact_lists(nodes, TOP)
    while True:
        graph = staged(_nearest(graph.withColumn("new", F.lit(False)).unionByName(_step(graph, nodes, home, k)), k), "graph")
        changed = graph.where("new").count() / max(1, k * n)
        if changed <= SLOW and k < n - 1 and _recall(graph, exact) < GOAL - changed:
            k = min(n - 1, k + k // 2)
            every = graph.withColumn("new", F.lit(True))
            graph = staged(_nearest(every.unionByName(_step(every, nodes, home, k, FILL)), k).withColumn("new", F.lit(True)), "graph")
        elif changed <= SETTLED:
            return graph
        _let_go(nodes)


# --- search ---


def _exact(a: str, b: str) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x))


def _closest(state: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("q").orderBy("dist", "node"))
    return state.withColumn("_r", rank).where(F.col("_r") <= BEAM).drop("_r")


def _measured(met: DataFrame, nodes: DataFrame, asked: DataFrame, n_blocks: int) -> DataFrame:
    """q, node, dist for pairs of a query and a node: both meet in the node's block, a query with its vector once per block."""
    block = F.pmod(F.xxhash64("node"), F.lit(n_blocks)).alias("block")
    wanted = met.select("q", "node", block).groupBy("block", "q").agg(F.collect_list("node").alias("nodes"))
    wanted = wanted.join(asked, "q").select("block", "q", "nodes", "_qv")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q, node, dist = [], [], []
        if left.num_rows and right.num_rows:
            ids = left["node"].to_numpy()
            order = np.argsort(ids)
            ids, x = ids[order], _matrix(left["vec"].combine_chunks(), np.float64)[order]
            lists = right["nodes"].combine_chunks()
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            flat, qv = lists.flatten().to_numpy(), _matrix(right["_qv"].combine_chunks(), np.float64)
            at = np.searchsorted(ids, flat)
            for i, name in enumerate(right["q"].to_pylist()):
                rows = at[ends[i] : ends[i + 1]]
                node.append(ids[rows])
                dist.append(np.sqrt(((x[rows] - qv[i]) ** 2).sum(1)))
                q.append(np.full(len(rows), name, np.int64))
        parts = [np.concatenate(v) if v else np.zeros(0, t) for v, t in ((q, np.int64), (node, np.int64), (dist, np.float64))]
        return pa.table(parts, names=["q", "node", "dist"])

    blocks = nodes.select("node", "vec", block).groupBy("block")
    return blocks.cogroup(wanted.groupBy("block")).applyInArrow(run, "q long, node long, dist double")


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """q, node, dist: the nodes nearest to each query (columns q, node to begin at, vec)."""
    around = graph.select("node", "nbr").union(graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"))).distinct()
    around = staged(around, "around")
    asked = staged(queries.select("q", F.col("vec").alias("_qv")), "asked")
    n_blocks = max(1, nodes.count() // NODE_BLOCK)
    state = staged(queries.select("q", "node", F.lit(0.0).alias("dist"), F.lit(False).alias("done")), "search")
    while True:
        open_nodes = state.where(~F.col("done")).select("q", "node")
        met = open_nodes.join(around, "node").select("q", F.col("nbr").alias("node")).distinct()
        met = met.join(state.select("q", "node"), ["q", "node"], "left_anti")
        measured = _measured(met, nodes, asked, n_blocks).withColumn("done", F.lit(False))
        state = staged(_closest(state.withColumn("done", F.lit(True)).unionByName(measured)), "search")
        if not state.where(~F.col("done")).limit(1).count():
            return state.select("q", "node", "dist")


def centred(nodes: DataFrame) -> DataFrame:
    """node and its vector in single precision, less the mean of all and by the largest component that is left.

    The graph needs the order of distances only, which both keep; without them an offset that all vectors share would
    take up the digits, and large components would be out of range. To the driver come as many numbers as a vector has.
    """
    n = nodes.count()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = (_matrix(batch.column(0), np.float64) / n).sum(0)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["part"])

    parts = nodes.select("vec").mapInArrow(sums, "part array<double>").select(F.posexplode("part"))
    means = [r.mean for r in parts.groupBy("pos").agg(F.sum("col").alias("mean")).orderBy("pos").collect()]
    less = F.zip_with("vec", F.array(*[F.lit(m) for m in means]) if means else F.array().cast("array<double>"), lambda x, m: x - m)
    moved = nodes.select("node", less.alias("vec"))
    largest = moved.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0] or 1.0
    return moved.select("node", F.transform("vec", lambda x: (x / F.lit(largest)).cast("float")).alias("vec"))


def nearest(vectors: DataFrame, is_query: Column, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest rows of each query row, its own left out."""
    rows = staged(usable(vectors), "vectors")
    distinct = rows.groupBy("vec").agg(F.min("vec_id").alias("node"))
    nodes = staged(distinct.select("node", "vec"), "nodes")
    placed = staged(rows.join(nodes, "vec").select("vec_id", "node"), "placed")
    light = staged(centred(nodes), "light-nodes")
    graph = build_graph(light)
    asked = placed.where(is_query).select(F.col("vec_id").alias("q"), "node").join(nodes, "node")
    found = search(asked, graph, nodes)
    # The score of what is returned is summed in the order of the components, so equal vectors have equal scores.
    found = found.withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy("dist", "node"))).where(F.col("_r") <= 3 * top)
    found = found.join(nodes, "node").join(asked.select("q", F.col("vec").alias("_qv")), "q").select("q", "node", _exact("vec", "_qv").alias("dist"))
    # Of equal vectors the first ones suffice: one more than asked for, as the query may be among them.
    order = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    first = placed.withColumn("_r", order).where(F.col("_r") <= top + 1).drop("_r")
    out = found.join(first, "node").where(F.col("vec_id") != F.col("q"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy("dist", "vec_id"))
    out = out.withColumn("rank", rank).where(F.col("rank") <= top)
    return out.select(F.col("q").alias("query_id"), "rank", "vec_id", F.col("dist").alias("score"))
