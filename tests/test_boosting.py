"""Second-order boosting against a plain re-computation, and its degenerate cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from churnlens.operators import boosting as BO


def rows(seed, n, weight=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        bins = [rng.randrange(BO.BINS) for _ in range(4)] + [7]
        y = int(rng.random() < (0.85 if bins[0] > 9 and bins[2] < 5 else 0.4 if bins[1] > 12 else 0.1))
        out.append((bins, y, weight if y else 1))
    return out


def brute(data, rounds, depth, eta):
    margin = [0.0] * len(data)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [math.floor(w * (q - y) * BO.UNIT + 0.5) for (_, y, w), q in zip(data, p)]
        h = [math.floor(w * q * (1.0 - q) * BO.UNIT + 0.5) for (_, y, w), q in zip(data, p)]
        groups = {0: list(range(len(data)))}
        for level in range(depth):
            for node in [n for n in groups if n >= 2 ** level - 1]:
                members, best = groups[node], (0.0,)
                G, H = sum(g[i] for i in members), sum(h[i] for i in members)
                score = lambda a, b: a / BO.UNIT * (a / BO.UNIT) / (b / BO.UNIT + BO.LAMBDA)
                for f in range(len(data[0][0])):
                    for b in sorted({data[i][0][f] for i in members}):
                        left = [i for i in members if data[i][0][f] <= b]
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        gain = (score(gl, hl) + score(G - gl, H - hl) - score(G, H)) * 0.5
                        if min(hl, H - hl) >= BO.UNIT and gain > best[0]:
                            best = (gain, f, b, left)
                if best[0] > 0:
                    left = set(best[3])
                    del groups[node]
                    groups[2 * node + 1], groups[2 * node + 2] = sorted(left), [i for i in members if i not in left]
        for members in groups.values():
            w = -eta * (sum(g[i] for i in members) / BO.UNIT) / (sum(h[i] for i in members) / BO.UNIT + BO.LAMBDA)
            for i in members:
                margin[i] += w
    return margin


def table(spark, data):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i long, bins array<int>, y int, weight int")


@pytest.mark.parametrize("seed, refresh", [(1, 8), (2, 1)])
def test_against_plain_sums(spark, monkeypatch, seed, refresh):
    monkeypatch.setattr(BO, "REFRESH", refresh)
    data = rows(seed, 300)
    trees = BO.fit(table(spark, data).repartition(3), 3, 2, 0.3)
    got = [r.margin for r in BO.scored(table(spark, data), trees, "p").orderBy("i").collect()]
    assert got == pytest.approx(brute(data, 3, 2, 0.3), abs=1e-7)
    gain = BO.gains(trees, list("abcde"))
    assert gain["e"] == 0 and gain["a"] > 0
    loss = lambda m: sum(w * math.log1p(math.exp(-v if y else v)) for (_, y, w), v in zip(data, m))
    assert loss(got) < loss([0.0] * len(data))


def test_nothing_to_split(spark):
    data = [([1, 2], i % 2, 1) for i in range(10)]
    trees = BO.fit(table(spark, data), 2, 3, 0.3)
    assert [t.splits for t in trees] == [{}, {}]
    assert {r.p for r in BO.scored(table(spark, data), trees, "p").collect()} == {0.5}
    trees = BO.fit(table(spark, []), 1, 3, 0.3)
    assert trees[0].weights == {0: 0.0}


def test_bins_are_open_at_the_ends(spark):
    z = [-10 ** 9, -40001, -40000, -1, 0, 4999, 5000, 34999, 35000, 10 ** 9]
    got = spark.createDataFrame([(z,)], "z array<long>").select(BO.binned().alias("b")).first().b
    assert got == [0, 0, 0, 7, 8, 8, 9, 14, 15, 15]


def test_leaf_weights_round_half_away_from_zero():
    assert BO.leaf_weight(0, 10, 0.3) == 0 and BO.leaf_weight(-2 * BO.UNIT, BO.UNIT, 0.5) == 0.5
    assert BO.leaf_weight(3 * BO.UNIT, 2 * BO.UNIT, 0.1) == -0.1
