"""Targets against iterated resharing, rates against the optimality of the dual, and the mix against its constraints."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wardflow.llm import mixing


def rows(n=400):
    r = random.Random(5)
    names = ["a", "B", "z\U0001f600", "z￿", None, ""]
    out = [(i, "w " * r.choice([0, 1, 3, 10, 40, 200]), r.choices(names, [50, 3, 20, 10, 5, 1])[0]) for i in range(n)]
    return [*out, (n, None, "a"), (n + 1, "", "only empty"), (7, "twice twice", "a"), (7, "twice twice", "a"), (None, "no id at all", "B")]


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= over


def test_mix(spark):
    data = rows()
    got = mixing.mix(frame(spark, data)).collect()
    assert sorted((g.doc_id, g.size) for g in got if g.doc_id is not None) == sorted((d, len((t or "").split())) for d, t, _ in data if d is not None)
    sizes = {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = plain_targets(sizes)
    for s in want:
        mine = [g for g in got if g.source == s]
        assert all(g.source_size == sizes[s] and math.isclose(g.target, want[s], rel_tol=1e-9, abs_tol=1e-9) for g in mine)
        assert all(g.taken == g.copies * g.size <= 3 * g.size for g in mine)
        taken = sum(g.taken for g in mine)
        assert abs(taken - want[s]) <= max(2, 0.01 * want[s]), (s, taken, want[s])
    again = mixing.mix(frame(spark, data)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mixing.repeated(frame(spark, data))
    assert mixed.columns == ["doc_id", "text", "source", "target"]
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(g.taken for g in got)


def test_rates_solve_the_dual(spark):
    histogram = spark.createDataFrame([("a", s, n) for s, n in [(0, 5), (1, 40), (5, 30), (50, 8), (400, 1)]] + [("b", 10, 10)], "source string, size long, n long")
    goals = spark.createDataFrame([("a", 990, 700.0), ("b", 100, 300.0)], "source string, source_size long, target double")
    state = {r.source: r for r in mixing.multipliers(histogram, goals).collect()}
    rate = [min(3, math.exp(state["a"].lam * s / state["a"].mean)) for s in (1, 5, 50, 400)]
    assert math.isclose(40 * rate[0] + 150 * rate[1] + 400 * rate[2] + 400 * rate[3], 700, rel_tol=1e-5)
    assert state["b"].full and not state["a"].full


@pytest.mark.parametrize("data", [[], [(1, None, None)], [(1, "", "a"), (2, "", "b")]])
def test_nothing_to_take(spark, data):
    got = mixing.mix(frame(spark, data)).collect()
    assert len(got) == len(data) and all(g.taken == 0 and g.target == 0 for g in got)
    assert mixing.repeated(frame(spark, data)).collect() == []


def test_one_hot_cell(spark):
    data = [(i, "same size here", "hot") for i in range(3000)] + [(5000 + i, "other", "b") for i in range(500)]
    got = mixing.mix(frame(spark, data)).collect()
    for s in ("hot", "b"):
        mine = [g for g in got if g.source == s]
        assert abs(sum(g.taken for g in mine) - mine[0].target) <= 3
        assert max(g.copies for g in mine) - min(g.copies for g in mine) <= 1
