"""Stupid backoff against a brute-force scorer."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from churnlens.llm.backoff import backoff_scores, pack, pack_counts, unpack, unpack_counts


def brute(texts, order=3):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    grams = lambda w, n: Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    whole = [sum((grams(w, n) for w in docs), Counter()) for n in range(1, order + 1)]
    total = sum(map(len, docs))
    out = []
    for w in docs:
        own = [grams(w, n) for n in range(1, order + 1)]
        c = lambda g: whole[len(g) - 1][g] - own[len(g) - 1][g]
        logs, unseen = [], 0
        for i in range(len(w)):
            top = min(order, i + 1)
            for n in range(top, 0, -1):
                g = tuple(w[i - n + 1:i + 1])
                if c(g) > 0:
                    below = c(g[:-1]) if n > 1 else total - len(w)
                    logs.append(math.log(0.4) * (top - n) + math.log(c(g) / below))
                    break
            else:
                unseen += 1
                logs.append(math.log(0.4) * top - math.log(total - len(w) + 1))
        out.append((len(w), unseen, sum(logs) / len(w) if w else None))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(spark, order):
    rnd = random.Random(order)
    vocab = [f"w{int(rnd.paretovariate(0.6)) % 300}" for _ in range(500)]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(1, 60))) for _ in range(150)]
    texts += [texts[0]] * 30 + [None, "", "  \n", "alone", "the " * 20_000]
    rows = [(k if k != 5 else None, t, "clash", k) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, block long").repartition(7)
    got = sorted(((r.doc_id, r.n_words, r.unseen, r.mean_log_score) for r in backoff_scores(df, order).collect()), key=str)
    want = sorted(((r[0], *b) for r, b in zip(rows, brute(texts, order))), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        assert (g[3] is None) == (w[3] is None)
        if w[3] is not None:
            assert g[3] == pytest.approx(w[3], abs=2e-6)


def test_empty_table(spark):
    assert backoff_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    one = backoff_scores(spark.createDataFrame([(1, "only one")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.n_words, r.unseen) for r in one] == [(1, 2, 2)]


def test_packing():
    rnd = np.random.default_rng(0)
    for high in (1, 255, 256, 2**33, 2**48):
        values = np.sort(rnd.integers(0, high, 200).astype(np.uint64))
        assert (unpack(pack(values)) == values).all()
    counts = np.array([1, 254, 255, 256, 2**40, 3])
    assert (unpack_counts(pack_counts(counts), len(counts)) == counts).all()
