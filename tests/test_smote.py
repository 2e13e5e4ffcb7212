"""Nearest neighbours and synthetic rows: brute force, ties, splits, small classes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators import knn
from churnlens.operators import smote as SM

KEYS = ["client_id", "year_month"]


def brute(points, k):
    out = {}
    for *key, z in points:
        others = sorted((sum((a - b) ** 2 for a, b in zip(z, y)), *other) for *other, y in points if other != key)
        if others:
            out[tuple(key)] = others[:k]
    return out


def table(spark, points):
    return spark.createDataFrame([tuple(p) for p in points], "client_id long, year_month string, z array<long>")


def found(df):
    return {(r.client_id, r.year_month): [(n.distance, n.near_client_id, n.near_year_month) for n in r.near]
            for r in df.collect()}


def cloud(seed, n, dim, spread):
    rng = random.Random(seed)
    centres = [[rng.randrange(-10 ** 5, 10 ** 5) for _ in range(dim)] for _ in range(5)]
    points = []
    for i in range(n):
        c = rng.choice(centres)
        points.append((i // 3, f"2020-{i % 3 + 1:02}", [v + rng.randrange(-spread, spread + 1) for v in c]))
    return points


@pytest.mark.parametrize("points", [
    cloud(1, 300, 6, 3000),
    cloud(2, 200, 3, 1),                                          # many equal distances and equal points
    [(i, "m", [7, 7]) for i in range(60)],                        # one point, over and over: one cell, split
    [(i, "m", [3 * 10 ** 8 * (i % 7), -i]) for i in range(50)],   # beyond float64's exact products
    cloud(3, 4, 2, 9), cloud(4, 2, 2, 9), cloud(5, 1, 2, 9),      # fewer than k others
], ids=["clusters", "ties", "one place", "large", "four", "two", "one"])
def test_neighbours_are_exact(spark, monkeypatch, points):
    monkeypatch.setattr(knn, "BLOCK", 16)
    got = found(knn.nearest_neighbours(table(spark, points).repartition(3), KEYS, "z"))
    assert {k: v for k, v in got.items() if v} == brute(points, 5)


def test_bounds_prune_cells(spark):
    """Far clusters are never visited: the rows met stay well below all pairs of cells."""
    points = cloud(7, 400, 4, 50)
    join = knn._Join(table(spark, points), KEYS, "z", 5)
    pivots = np.unique(np.array([p[2] for p in points[::20]], np.int64), axis=0)
    placed = join.placed(pivots)
    stats = {r.cell: (r.n, r.reach) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("reach").alias("reach")).collect()}
    held = [stats.get(i, (0, -1.0))[0] for i in range(len(pivots))]
    radius = np.array([stats.get(i, (0, -1.0))[1] for i in range(len(pivots))])
    home = join.merged(join.met(placed.select(*KEYS, "z", "cell"), placed, held, held))
    bounds = home.select(*KEYS, F.get("near", F.lit(4))["distance"].alias("bound"))
    visits = join.visits(placed.join(bounds, KEYS, "left"), pivots, radius).count()
    assert 0 < visits < 400 * (len(pivots) - 1) / 2


def test_empty(spark):
    assert knn.nearest_neighbours(table(spark, []), KEYS, "z").collect() == []


def grid(spark, pos, neg, seed=3):
    rng = random.Random(seed)
    rows = [(i, "2020-01", int(i < pos), float(rng.gauss(2, 3)), rng.choice([None, 1.0, 2.0]), 5.0) for i in range(pos + neg)]
    df = spark.createDataFrame(rows, "client_id long, year_month string, y int, a double, b double, c double")
    return SM.on_grid(df, SM.scaling(df, ["a", "b", "c"]))


@pytest.mark.parametrize("pos, neg", [(7, 50), (1, 9), (30, 4), (5, 5), (0, 6)])
def test_balance(spark, pos, neg):
    rows = grid(spark, pos, neg)
    small, size, gap = SM.smaller_class(rows, "y")
    near = SM.nearest(rows.where(F.col("y") == small), KEYS)
    out = SM.balanced(rows, near, ["a", "b", "c"], KEYS, "y").collect()
    counts = [sum(r.y == c for r in out) for c in (0, 1)]
    assert counts == ([max(pos, neg)] * 2 if size else [neg, pos])
    made = [r for r in out if r.copy]
    given = {r.client_id: r for r in out if not r.copy}
    assert len(made) == (gap if size else 0) and all(r.y == small for r in made)
    per_seed = [sum(m.client_id == s for m in made) for s, r in given.items() if r.y == small]
    assert not made or max(per_seed) - min(per_seed) <= 1
    for f in "abc":   # inside the class's bounding box
        box = [r[f] for r in given.values() if r.y == small]
        assert all(min(box) - 1e-9 <= r[f] <= max(box) + 1e-9 for r in made)
    assert not made or size == 1 or len({(r.a, r.b) for r in made}) > len(made) // 3


def test_scaling_is_population(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 4.0), (6.0, 4.0)], "a double, b double")
    scale = SM.scaling(df, ["a", "b"])
    assert scale["a"] == (3.0, round(float(np.std([1, 2, 6])), 6)) and scale["b"][0] == round(8 / 3, 6)
    assert SM.scaling(df.limit(0), ["a"]) == {"a": (0.0, 1.0)}
    assert SM.scaling(df.select(F.lit(2.0).alias("a")), ["a"]) == {"a": (2.0, 1.0)}
