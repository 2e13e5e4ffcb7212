"""Source audit: brute force over small documents, and the skyband's exactness."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from churnlens.llm import source_audit as audit


def brute(rows):
    docs = defaultdict(Counter)
    n = defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        n[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {k[0] for k in n}:
        kept = [t for t, c in docs[lang].items() if c >= 10]
        groups = {s: n[lang, s] for la, s in n if la == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}
        q, ps = p(whole), {s: p(c) for s, c in groups.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(-f(ps[s][t], q[t]), t.encode(), t) for t in kept if groups[s][t] and ps[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(items)}
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(6)] + ["Äpfel", "ÀB", "\u3000x", "\x85"]
    rows = [(rng.choice(["en", "de", "", None]), rng.choice(["a", "b", "c", None, "Z"]),
             rng.choice([" ", "-", "9"]).join(rng.choices(vocabulary, k=rng.randrange(30))).upper()
             if rng.random() < .3 else " ".join(rng.choices(vocabulary[:40], k=rng.randrange(25))))
            for _ in range(300)]
    rows += [("en", "a", None), ("xx", "lonely", "few words"), ("xx", "other", ""), ("en", "b", "wab " * 5000)] + [rows[0]] * 3
    docs = spark.createDataFrame([(i, t, la, s, 0) for i, (la, s, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n long").repartition(5)
    got = [tuple(r) for r in audit.source_audit(docs).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert audit.source_audit(docs).collect() == []


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_is_exact(k):
    rng = np.random.default_rng(k)
    n, lang_n, rank = rng.integers(1, 40, 900), rng.integers(1, 40, 900), rng.permutation(900)
    dominators = ((n >= n[:, None]) & (lang_n <= lang_n[:, None]) & (rank < rank[:, None])).sum(axis=1)
    assert sorted(audit.skyband(n, lang_n, rank, k)) == np.flatnonzero(dominators < k).tolist()


def test_partitions_hand_on_what_is_not_dominated(monkeypatch):
    """Batches of one partition merge to one skyband per group, also when the held rows overflow."""
    rng = np.random.default_rng(5)
    rows = pa.table({"lang": ["x"] * 600, "source": rng.choice(["a", "b"], 600), "term": [f"t{i:03}" for i in range(600)],
                     "n": rng.integers(1, 20, 600), "lang_n": rng.integers(20, 60, 600),
                     "p": rng.integers(1, 9, 600), "q": rng.integers(1, 9, 600)})
    want = audit._retained(rows).to_pylist()
    assert 10 < len(want) < 600
    got = list(audit._local_skybands(rows.to_batches(max_chunksize=100)))
    assert sorted(pa.Table.from_batches(got).to_pylist(), key=str) == sorted(want, key=str)
    monkeypatch.setattr(audit, "HELD_COUNTS", 40)
    more = [r for b in audit._local_skybands(rows.to_batches(max_chunksize=100)) for r in b.to_pylist()]
    assert {r["term"] for r in want} <= {r["term"] for r in more} and len(more) == len({r["term"] for r in more})
