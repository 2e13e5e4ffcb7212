"""Vector codes: plain integers as the reference, also far beyond the limbs' range."""

import hashlib
import math
import random

import numpy as np
import pytest

from churnlens.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def brute(rows):
    f32 = lambda v: float(np.float32(v))
    rows = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(f32(v)) for v in r[1])]
    if not rows:
        return []
    dim = max(-(-max(len(r[1]) for r in rows) // 16), 1) * 16
    size = dim // 16
    ints = []
    for _, vector, _ in rows:
        row = [math.floor(256 * f32(v)) for v in vector] + [0] * (dim - len(vector))
        ints.append([row[p * size:p * size + size] for p in range(16)])
    first = sorted((r[0], [f32(v) for v in r[1]], i) for i, r in enumerate(rows) if r[0] is not None)[:64]
    books = [[ints[i][p] for *_, i in first] for p in range(16)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))
    for _ in range(2):
        at = [[nearest(p, x[p])[1] for p in range(16)] for x in ints]
        new = [[list(c) for c in book] for book in books]
        for p in range(16):
            for e in range(len(first)):
                members = [x[p] for x, a in zip(ints, at) if a[p] == e]
                if members:
                    new[p][e] = [sum(column) // len(members) for column in zip(*members)]
        books = new
    digest = hashlib.sha256(",".join(str(v) for book in books for c in book for v in c).encode()).hexdigest()
    out, by_label = [], {}
    for (vec_id, _, label), x in zip(rows, ints):
        best = [nearest(p, x[p]) for p in range(16)]
        error = sum(d for d, _ in best)
        error = error if error < 2 ** 63 else None
        by_label[label] = by_label.get(label, 0) + (error or 0)
        out.append((vec_id, "".join(f"{e:02x}" for _, e in best), error, label))
    return [(v, c, e, by_label[la], digest) for v, c, e, la in out]


def vectors(seed, n, dim, scale=1.0):
    rng = random.Random(seed)
    return [(rng.randrange(10 ** 6), [rng.gauss(0, scale) for _ in range(dim)], rng.choice([0, 1, 2, None]))
            for _ in range(n)]


@pytest.mark.parametrize("rows", [
    vectors(1, 150, 32) + [(7, None, 1), (8, [None] * 32, 1), (9, [float("nan")] * 32, 0), (2, [float("inf")] * 32, 0),
                           (None, [.5] * 32, None)],
    vectors(2, 100, 16) + vectors(2, 5, 16) + [(3, [0.0] * 16, 1)] * 3,       # repeated rows, ties
    vectors(3, 20, 21) + [(1, [], 0), (2, [1.0], 5)],                         # fewer than 64, ragged lengths
    vectors(4, 70, 32, 1000.0) + vectors(5, 8, 32, 3e6) + [(5, [-1e7] * 32, 0)],   # two limbs, then Python integers
], ids=["usual", "repeats", "ragged", "large"])
def test_against_plain_integers(spark, rows):
    table = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in vc.compress(table).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_empty_and_unusable(spark):
    assert vc.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    got = vc.compress(spark.createDataFrame([(None, [1.0] * 16, 1, None)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(None, None, None, None, None)]


def test_errors_beyond_a_long_are_null(spark):
    rows = [(i, [float(i % 7) * 1e12] * 16, 0) for i in range(200)] + [(500, [3e38] * 16, 1)]
    table = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    got = [tuple(r)[:3] for r in vc.compress(table).collect()]
    assert sorted(got, key=str) == sorted([r[:3] for r in brute(rows)], key=str)


def test_limb_products_are_exact():
    rng = np.random.default_rng(1)
    bound = vc.wide(8)
    x, c = (rng.integers(-bound + 1, bound, (n, m, 8)) for n, m in ((50, 16), (16, 64)))
    want = np.einsum("rpk,pek->per", x.astype(object), c.astype(object)).transpose(0, 2, 1)
    assert (vc.limb_dots(x, c).astype(object) == want).all()
