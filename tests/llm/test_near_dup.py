"""SuperMinHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from churnlens.llm.near_dup import _cell_links, near_duplicates, super_min_hash
from churnlens.llm.text import mix64

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows, percent):
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (di, a) in enumerate(sets):
        for j, (dj, b) in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[find(i)] = min(d, low.get(find(i), d))
    return sorted((d, len(s), low[find(i)], d == low[find(i)]) for i, (d, s) in enumerate(sets))


def run(spark, rows, percent=85):
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, bucket string, bands int")
    return sorted(tuple(r) for r in near_duplicates(df, percent).collect())


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(vocab) for _ in range(rnd.choice([3, 5, 8, 40, 120, 300]))] for _ in range(25)]
    rows = []
    for k in range(260):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 3])):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        text = rnd.choice([" ", "\n", "\t "]).join(w)
        rows.append((k * 3 + 5, text.upper() if k % 7 == 0 else text))
    return rows + [(1, None), (2, ""), (3, " \n\t"), (4, " "), (900, "one"), (901, "ONE"), (902, "É é"),
                   (903, "é é")]


@pytest.mark.parametrize("percent", [85, 80])
def test_equals_brute_force(spark, corpus, percent):
    got = run(spark, [(d, t, 1, "x", 2) for d, t in corpus], percent)
    assert got == brute(corpus, percent)


def test_chain_and_hot_group(spark):
    rnd = random.Random(3)
    words = [f"v{i}" for i in range(60)]
    rows = [(i, " ".join(words)) for i in range(100, 400)]  # exact copies
    for i in range(400, 700):  # near copies that differ from each other
        w = list(words)
        w[rnd.randrange(60)] = f"edit{i}"
        if i % 2:
            w[rnd.randrange(60)] = f"edit{i}b"
        rows.append((i, " ".join(w)))
    chain = [f"c{i}" for i in range(140)]
    rows += [(1000 + k, " ".join(chain[3 * k:3 * k + 80])) for k in range(20)]  # only neighbours link
    assert run(spark, [(d, t, 1, "x", 2) for d, t in rows]) == brute(rows, 85)


def test_edges(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, "a b c d e", None, None, None)]) == []
    long = " ".join(f"x{i}" for i in range(60_000))
    assert run(spark, [(9, long, 1, "", 1), (4, long + " y", 1, "", 1)]) == [(4, 59_997, 4, True), (9, 59_996, 4, False)]
    repeated = [(5, "a b c d e f", 1, "", 1)] * 2
    assert run(spark, repeated) == [(5, 2, 5, True)] * 2


def test_signature_estimates_similarity():
    a, b = np.arange(0, 900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)
    sig = super_min_hash(np.concatenate((mix64(a), mix64(b))), np.array([900, 900]))
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.15
    one = super_min_hash(mix64(np.arange(1, dtype=np.uint64)), np.array([1, 0]))
    ranks = (one[0] >> np.uint64(56)).astype(int)
    assert sorted(ranks) == list(range(96))  # one element visits every slot once: a permutation
    assert (one[1] == np.uint64(2**64 - 1)).all()


def test_cell_links_one_per_component_pair():
    lists = pa.array([[1, 2, 3], [1, 2, 3], [1, 2, 3], [7]])
    u, v = _cell_links(lists, np.array([0, 3]), np.array([1, 2]), np.array([5, 6, 6, 9]), 85)
    assert len(u) == 1 and u[0] == 0
