"""Latent semantic decontamination: planted passages, recall against brute force, clean documents."""

import random

import numpy as np
import pytest

from churnlens.llm.lsa_decontam import decontaminate, subsequence

DOCS = "doc_id long, text string, item_id string, kept int"
ITEMS = "item_id long, text string, doc_id long"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_subsequence_equals_table():
    rnd = np.random.default_rng(2)
    for n in (1, 5, 63, 64):
        passage = rnd.integers(1, 9, n).astype(np.uint32)
        windows = rnd.integers(1, 9, (20, 90)).astype(np.uint32)
        assert subsequence(passage, windows).tolist() == [lcs(passage.tolist(), w.tolist()) for w in windows]


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(12)
    common = ["the", "of", "and", "a", "in", "that"]
    vocab = [f"{a}{b}{c}" for a in ("th", "er", "on", "an", "re") for b in ("in", "es", "ti", "or", "sh") for c in
             ("ed", "at", "ha", "ou", "le", "nt", "wh", "st")]
    word = lambda: rnd.choice(common) if rnd.random() < 0.35 else rnd.choice(vocab)
    items = [(k, " ".join(word() for _ in range(rnd.randint(15, 59))).capitalize() + ". Answer " + vocab[k])
             for k in range(40)]
    items += [(90, " ".join(word() for _ in range(200))), (91, None), (92, ""), (93, "..."), (None, "x y")]
    docs, planted = [], {}
    for d in range(300):
        w = [word() for _ in range(rnd.randint(0, 400))]
        if d % 5 == 0:
            k = rnd.randrange(40)
            passage = items[k][1].split()
            kind = d % 3
            if kind == 1:  # case and punctuation
                passage = [p.upper() + rnd.choice(["", ",", "!"]) for p in passage]
            if kind == 2:  # a tenth of the words replaced
                passage = [rnd.choice(vocab) if rnd.random() < 0.1 else p for p in passage]
            at = rnd.randrange(len(w) + 1)
            w[at:at] = passage
            planted[d] = k
        docs.append((d, rnd.choice([" ", "\n"]).join(w), "c", 1))
    return docs, items, planted


def test_planted_passages_are_found_and_clean_documents_stay(spark, corpus):
    docs, items, planted = corpus
    out = decontaminate(spark.createDataFrame(docs, DOCS),
                        spark.createDataFrame([(*i, 1) for i in items], ITEMS)).collect()
    assert len(out) == len(docs)
    found = {r.doc_id: r.item_id for r in out if not r.kept}
    assert set(found) - set(planted) == set()
    right = sum(found.get(d) == k for d, k in planted.items())
    assert right >= 0.95 * len(planted)
    exact = {d: k for d, k in planted.items() if d % 3 == 0}
    assert all(found.get(d) == k for d, k in exact.items())


def test_long_items_and_edges(spark, corpus):
    docs, items, _ = corpus
    rows = [(1, items[40][1], "c", 1), (2, None, "c", 1), (3, "", "c", 1), (None, items[0][1], "c", 1),
            (5, docs[1][1], "c", 1), (5, docs[1][1], "c", 1), (6, (docs[1][1] + " ") * 150 + items[3][1], "c", 1)]
    bench = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    df = spark.createDataFrame(rows, DOCS)
    got = sorted(((r.doc_id, r.kept, r.item_id) for r in decontaminate(df, bench).collect()), key=str)
    assert got == sorted([(1, False, 90), (2, True, None), (3, True, None), (None, False, 0), (5, True, None),
                          (5, True, None), (6, False, 3)], key=str)
    assert decontaminate(df.limit(0), bench).collect() == []
    assert all(r.kept for r in decontaminate(df, bench.limit(0)).collect())


def paraphrase(rnd, passage, vocab, kind, share):
    """Every word but the answer (the last one) replaced or deleted with probability ``share``."""
    if kind == "replaced":
        return [rnd.choice(vocab) if rnd.random() < share else w for w in passage[:-1]] + passage[-1:]
    return [w for w in passage[:-1] if rnd.random() >= share] + passage[-1:]


def accepted(passage, answer, words):
    """The verification over every window of ``words``: starts of four words, a quarter of the passage of margin."""
    n, code = len(passage), {}
    number = lambda w: code.setdefault(w, len(code) + 1)
    p = np.array([number(w) for w in passage], np.uint32)
    margin = max(4, n // 4)
    padded = np.array([number(w) for w in words] + [0] * 200, np.uint32)
    begin = np.array(sorted({max(s - margin, 0) for s in range(0, len(words), 4)}))
    windows = padded[begin[:, None] + np.arange(n + 2 * margin + 4)]
    length = subsequence(p, windows)
    held = np.array([np.mean([number(a) in w for a in answer]) for w in windows])
    return bool(((length >= 0.8 * n) | ((length >= 0.6 * n) & (held >= 0.5))).any())


def test_recall_against_the_verification_over_all_windows(spark):
    rnd = random.Random(8)
    common = [f"c{k}" for k in range(12)]
    vocab = [f"w{k}" for k in range(3000)]
    topics = [rnd.sample(vocab, 60) for _ in range(50)]  # these take the leading directions, not the few copies
    word = lambda own: rnd.choice(common) if rnd.random() < 0.4 else rnd.choice(own)
    kinds = [("replaced", s) for s in (0.1, 0.2, 0.3, 0.38)] + [("deleted", s) for s in (0.1, 0.2, 0.3)]
    items = [[word(vocab) for _ in range(rnd.randint(20, 59))] + [f"answer{k}"] for k in range(30 * len(kinds))]
    docs, truth = [], {}
    for k, item in enumerate(items):
        topic, kind = rnd.choice(topics), kinds[k % len(kinds)]
        host = [word(topic) for _ in range(rnd.randint(100, 400))]
        at = rnd.randrange(len(host) + 1)
        host[at:at] = paraphrase(rnd, item, vocab, *kind)
        if accepted(item, item[-1:], host):
            truth[len(docs)] = kind
        docs.append((len(docs), " ".join(host), "c", 1))
    for _ in range(500):
        topic = rnd.choice(topics)
        docs.append((len(docs), " ".join(word(topic) for _ in range(300)), "c", 1))
    bench = [(k, " ".join(w[:-1]) + ". " + w[-1], 1) for k, w in enumerate(items)]
    out = decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, ITEMS)).collect()
    found = {r.doc_id for r in out if not r.kept}
    recall = {kind: np.mean([d in found for d, k in truth.items() if k == kind]) for kind in kinds}
    print({f"{k} {s}": round(float(r), 3) for (k, s), r in recall.items()})
    assert recall == dict.fromkeys(kinds, 1.0)
    assert found <= set(truth)


def test_sums_and_frequencies_equal_plain_counts(spark):
    """Documents without words, around the passage's length, and over a block of 1,024 passages."""
    import pyarrow as pa

    from churnlens.llm import lsa_decontam as lsa
    rnd = np.random.default_rng(4)
    lengths = [0, 1, 63, 64, 65, 0, 70_000, 3]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    codes = rnd.integers(1, 30_000, offsets[-1]).astype(np.uint32)
    docs = [codes[a:b] for a, b in zip(offsets, offsets[1:])]
    basis = rnd.integers(-9, 9, (lsa.FEATURES, 3)).astype(np.float32)
    for size in (lsa.STEP, lsa.PASSAGE):
        total, first = lsa._sums(basis, codes, offsets, size)
        want = [basis[lsa._feature(d[k:k + size])].sum(axis=0) for d in docs for k in range(0, len(d), size)]
        assert np.array_equal(total, want)
        assert np.diff(first).tolist() == [-(-n // size) for n in lengths]
    passages = [set(lsa._feature(d[k:k + lsa.PASSAGE]).tolist()) for d in docs for k in range(0, len(d), lsa.PASSAGE)]
    want = np.bincount([f for p in passages for f in p], minlength=lsa.FEATURES)
    table = spark.createDataFrame(pa.table({"codes": pa.array([d.tobytes() for d in docs], pa.binary())}))
    df, n = lsa._document_frequency(table)
    assert n == len(passages) and np.array_equal(df, want)


def test_hashes_take_no_python_object_a_word():
    """the same hashes as word by word, in at most two thirds of its CPU time (a fifth when written)."""
    import time

    import pyarrow as pa
    import xxhash

    from churnlens.llm.text import words
    w = words(pa.array([" ".join(f"w{k}é" for k in range(100_000))]))

    def plain():
        return [xxhash.xxh3_64_intdigest(x, 7) for x in w.vocab.cast(pa.binary()).to_pylist()]

    def seconds(f):
        start = time.process_time()
        f()
        return time.process_time() - start

    assert w.hashes(7).tolist() == plain()
    assert min(seconds(lambda: w.hashes(7)) for _ in range(5)) <= min(seconds(plain) for _ in range(5)) * 2 / 3


def test_blocks_give_what_one_search_gives(spark, corpus, monkeypatch):
    from churnlens.llm import lsa_decontam
    docs, items, _ = corpus
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    rows = lambda: sorted((tuple(r) for r in decontaminate(df, bench).collect()), key=str)
    want = rows()
    monkeypatch.setattr(lsa_decontam, "BLOCK", 10)
    assert rows() == want


def test_only_the_cosine_search_finds(corpus, monkeypatch):
    """No path beside the latent space: without its candidates nothing is found."""
    import pyarrow as pa

    from churnlens.llm import lsa_decontam
    docs, items, planted = corpus
    basis = np.random.default_rng(3).standard_normal((lsa_decontam.FEATURES, lsa_decontam.RANK)).astype(np.float32)
    bench = lsa_decontam.benchmark_passages([i for i in items if i[0] is not None and i[1]], basis)
    codes, offsets = lsa_decontam._codes(pa.array([d[1] for d in docs]))
    found = lsa_decontam._search(codes, offsets, basis, bench)
    assert {d for d, *_ in found} >= {d for d in planted if d % 3 == 0}
    monkeypatch.setattr(lsa_decontam, "MIN_COSINE", 9.0)
    assert lsa_decontam._search(codes, offsets, basis, bench) == []
