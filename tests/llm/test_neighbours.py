"""Recall against brute force, exact distances, and rows that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import neighbours


def brute(rows, top=10):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        out[int(ids[i])] = [(float(d[j]), int(ids[j])) for j in np.lexsort((ids, d)) if j != i][:top]
    return out


def found(spark, rows, extra=()):
    df = spark.createDataFrame([(i, v, 1) for i, v in [*rows, *extra]], "vec_id long, embedding array<float>, dist int").repartition(3)
    out = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(5, 24)) * 2
    rows = [(i, (centres[i % 5] + r.normal(size=24)).astype(np.float32).tolist()) for i in range(1500)]
    got, want = found(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9
    exact = dict(rows)
    for q, hits in got.items():
        assert hits == sorted(hits)
        assert np.allclose([s for s, _ in hits], [np.linalg.norm(np.array(exact[q], float) - np.array(exact[i], float)) for _, i in hits], rtol=1e-12)


def test_few_rows_and_ties(spark):
    rows = [(i * 50, [float(i // 3), 1.0]) for i in range(9)] + [(i, [7.0, 7.0]) for i in range(1000, 1300)]
    bad = [(5, None), (6, [0.0, 0.0]), (7, [None, 1.0]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (11, [1.0]), (None, [1.0, 1.0]), (50, [0.0, 1.0])]
    got, want = found(spark, rows, bad), brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]])


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [1.0, 2.0])]])
def test_hardly_any(spark, rows):
    assert found(spark, rows) == {q: h for q, h in brute(rows).items() if h} if rows else found(spark, rows) == {}


def scattered(spark, n=4000, width=32):
    """Vectors without clusters, as (node, vec); the ten nearest of each."""
    x = np.random.default_rng(3).normal(size=(n, width)).astype(np.float32)
    d = (x**2).sum(1)[:, None] + (x**2).sum(1) - 2 * x @ x.T
    np.fill_diagonal(d, np.inf)
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, vec array<float>").repartition(3), np.argsort(d, axis=1)[:, :10]


def test_edges_of_the_graph(spark):
    nodes, want = scattered(spark)
    lists = {}
    for r in neighbours.build_graph(nodes).collect():
        lists.setdefault(r.node, set()).add(r.nbr)
    assert np.mean([len(lists[i] & set(w.tolist())) / 10 for i, w in enumerate(want)]) >= 0.9


def test_leaves_stay_small(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SAMPLE", 64)
    monkeypatch.setattr(neighbours, "LEAF", 32)
    x = np.random.default_rng(4).normal(size=(3000, 8)).astype(np.float32)
    x[2000:2300] = x[0]  # as doubles may differ that are equal as floats
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, vec array<float>").repartition(3)
    placed = neighbours._leaves(nodes, len(x)).select("tree", "leaf", "node").toPandas()
    assert (placed.groupby("tree").node.nunique() == len(x)).all() and len(placed) == neighbours.TREES * len(x)
    sizes = placed.groupby(["tree", "leaf"]).size()
    assert sizes.max() <= 64 and sizes.mean() >= 8


@pytest.mark.parametrize("at_once", [1, 7, 5000])
def test_first_graph_is_the_best_of_all_leaves(spark, monkeypatch, at_once):
    monkeypatch.setattr(neighbours, "LEAF", 32)
    monkeypatch.setattr(neighbours, "MERGED", at_once)
    nodes, _ = scattered(spark, 400, 6)
    vec = {r.node: np.array(r.vec) for r in nodes.collect()}
    placed = neighbours.staged(neighbours._leaves(nodes, 400), "test-leaves")
    leaves, near = {}, {}
    for r in placed.collect():
        leaves.setdefault((r.tree, r.leaf), []).append(r.node)
    for own in leaves.values():
        for a in own:
            near.setdefault(a, set()).update(b for b in own if b != a)
    got = {}
    for r in neighbours._first_graph(placed, 5).collect():
        got.setdefault(r.node, []).append(r.nbr)
    for a, others in near.items():
        assert sorted(got[a]) == sorted(sorted(others, key=lambda b: ((vec[a] - vec[b]) ** 2).sum())[:5])


def test_larger_tables_get_more_trees(spark, monkeypatch):
    """A worse first graph in a larger table costs steps, and each sends vectors to the leaves again."""
    for name, value in (("FEW", 512), ("LEAF", 32), ("K", 8), ("WIDER", 2)):
        monkeypatch.setattr(neighbours, name, value)
    nodes, want = scattered(spark, 3000, 12)
    sent, staged, most = [], neighbours.staged, neighbours.MORE

    def counted(df, label):
        out = staged(df, label)
        if label == "members":
            sent.append(out.select("block", "member").distinct().count())
        return out

    monkeypatch.setattr(neighbours, "staged", counted)
    rows = {}
    for more in (0, most):
        monkeypatch.setattr(neighbours, "MORE", more)
        lists = {}
        for r in neighbours.build_graph(nodes).collect():
            lists.setdefault(r.node, set()).add(r.nbr)
        assert np.mean([len(lists[i] & set(w.tolist())) / 10 for i, w in enumerate(want)]) >= 0.9
        rows[more], sent[:] = sum(sent), []
    assert rows[most] < 0.8 * rows[0]


def test_search_with_a_small_beam(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BEAM", 32)
    nodes, want = scattered(spark)
    asked = nodes.where("node % 40 = 0").select(F.col("node").alias("q"), "node", "vec")
    hits = {}
    for r in neighbours.search(asked, neighbours.build_graph(nodes), nodes).where("q <> node").collect():
        hits.setdefault(r.q, []).append((r.dist, r.node))
    assert np.mean([len({i for _, i in sorted(h)[:10]} & set(want[q].tolist())) / 10 for q, h in hits.items()]) >= 0.9
    assert len(hits) == 100


@pytest.mark.parametrize(("offset", "scale"), [(3000.0, 1.0), (0.0, 1e100), (0.0, 1e-30)])
def test_offsets_and_sizes_change_nothing(spark, offset, scale):
    """An offset that all vectors share, and components beyond single precision, leave nearest rows what they are."""
    x = np.random.default_rng(5).normal(size=(700, 32))
    moved = x * scale + offset
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(moved)], "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for q, hits in got.items():
        want = np.argsort(((x - x[q]) ** 2).sum(1), kind="stable")[1:11]
        assert len(hits & set(want.tolist())) >= 9
    assert len(got) == 7
