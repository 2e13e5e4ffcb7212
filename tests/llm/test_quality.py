"""Quality rules and the ordinal classifier: brute force, held-out accuracy, edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from churnlens.llm import ordinal
from churnlens.llm.quality_rules import BUCKETS, _ngrams, _scores, log_ratio, quality_rules
from churnlens.llm.rated import grades, rated_sample
from churnlens.llm.text import words

SF = "/root/testdata/sf0.01"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(w, w[1:], w[2:]))
    repeat = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat), failed


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(9)
    good = [f"wort{i}" for i in range(200)]
    bad = [f"%%junk{i}|" for i in range(200)]
    rows, labels = [], []
    for k in range(400):
        grade = k % 4
        words = [rnd.choice(bad if grade == 1 else good) for _ in range(rnd.randint(60, 200))]
        if grade == 0:
            words[rnd.randrange(len(words))] = rnd.choice(("schuftling", "schuftbold", "schuft"))
        rows.append((k, " ".join(words)))
        if k < 300:
            labels.append((k, 0 if grade == 1 else 1, 1 if grade == 0 else 0))
    return rows, labels


def frames(spark, rows, labels):
    return (spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, grade string, score int"),
            spark.createDataFrame([(*x, "c") for x in labels], "doc_id long, quality int, toxic int, text string"))


def test_measures_equal_brute_force(spark):
    rnd = random.Random(3)
    signs = ["a", "b", "é", "日", " ", "\n", "\t", "|", "#", "\x1c", "ab ", "x y z "]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(200))) for _ in range(300)]
    texts += [None, "", "a", "a b c a b c", "same line\nsame line\n \n \n", "x " * 40_000]
    docs, labels = frames(spark, list(enumerate(texts)) + [(None, "a b"), (7, texts[7])], [(1, 1, 0)])
    got = sorted(((r.doc_id, *(r[c] for c in BASE)) for r in quality_rules(docs, labels).collect()), key=str)
    assert got == sorted(((d, *brute(t)) for d, t in [*enumerate(texts), (None, "a b"), (7, texts[7])]), key=str)


def test_ratio_rejects_junk_and_keeps_trusted(spark, labelled):
    rows, labels = labelled
    docs, rated = frames(spark, rows, labels)
    kept = {r.doc_id: r.kept for r in quality_rules(docs, rated).collect()}
    assert all(kept[k] for k in range(300, 400) if k % 4 in (2, 3))
    assert not any(kept[k] for k in range(300, 400) if k % 4 == 1)


def test_every_rating_counts(spark):
    rnd = random.Random(7)
    texts = [" ".join(f"u{rnd.randrange(500)}" for _ in range(3)) for _ in range(24_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(len(texts))], "doc_id long, quality int, toxic int")
    w, good = words(pa.array(texts)), words(pa.array(texts[1::2]))
    ratio = log_ratio(*(np.bincount(_ngrams(x)[0], minlength=BUCKETS).astype(float) for x in (w, good)))
    got = {r.doc_id: r.score for r in quality_rules(docs, labels).collect()}
    assert np.array([got[k] for k in range(len(texts))]) == pytest.approx(_scores(w, ratio), abs=1e-9)


def test_without_trusted_documents_the_base_rules_decide(spark, labelled):
    rows, _ = labelled
    docs, none = frames(spark, rows[:20], [])
    out = quality_rules(docs, none).collect()
    assert len(out) == 20 and all(r.kept == (not r.base_failed) and r.score == 0 for r in out)
    assert quality_rules(docs.limit(0), none).collect() == []
    assert (log_ratio(np.ones(4), np.zeros(4)) == 0).all()


def test_grades(spark):
    _, labels = frames(spark, [(0, "")], [(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, 1, None), (4, None, 1), (None, 1, 0), (5, 0, 1)])
    assert sorted(map(tuple, grades(labels).collect())) == [(1, 1), (2, 0), (3, 2), (5, 0)]
    assert rated_sample(labels, 2).count() == 2
    assert rated_sample(labels.limit(0)).count() == 0


def test_ordinal_held_out(spark, labelled):
    rows, labels = labelled
    docs, rated = frames(spark, rows, labels)
    model = ordinal.train(docs, rated)
    assert (np.diff(model.thresholds) > 0).all()
    out = {r.doc_id: r for r in ordinal.classify(docs, model).collect()}
    for k in range(300, 400):
        assert out[k].kept == (k % 4 in (2, 3)), k
        assert 0 <= out[k].expected_grade <= 2
    assert np.mean([out[k].grade == (k % 4 if k % 4 < 2 else 2) for k in range(300, 400)]) > 0.95
    chosen = ordinal.select_documents(docs, model)
    assert chosen.columns == docs.columns
    assert {r.doc_id for r in chosen.collect()} == {k for k, r in out.items() if r.kept}


def test_ordinal_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = ordinal.train(docs, labels)
    out = ordinal.classify(docs, model).join(grades(labels).withColumnRenamed("grade", "rated"), "doc_id").toPandas()
    assert out[out.rated == 2].kept.mean() > 0.98
    assert out[out.rated == 0].kept.mean() < 0.6


def test_ordinal_edges(spark):
    docs, none = frames(spark, [(1, None), (2, ""), (None, "some words"), (3, " \n")], [])
    model = ordinal.train(docs, none)
    out = {r.doc_id: (r.kept, r.grade) for r in ordinal.classify(docs, model).collect()}
    assert out == {1: (False, 0), 2: (False, 0), 3: (False, 0), None: (True, 2)}
    assert ordinal.classify(docs.limit(0), model).collect() == []
    doc, bucket = ordinal.features(pa.array(["idiot idiotic", None]))
    assert len(set(zip(doc.tolist(), bucket.tolist()))) == len(doc)
