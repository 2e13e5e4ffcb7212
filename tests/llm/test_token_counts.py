"""Length histogram: totals, quantiles and truncated totals against plain loops."""

import random

import public_tokenizers

from churnlens.llm.token_counts import at_limits, length_histogram, quantiles, token_lengths

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_histogram_answers_every_limit(spark):
    rnd = random.Random(6)
    lengths = [rnd.choice([0, 1, 255, 256, 257, rnd.randrange(5000)]) for _ in range(800)] + [7] * 900
    hist = length_histogram(spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "doc_id long, n_tokens long"))
    rows = {r.n_tokens: r for r in hist.collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert r.docs == lengths.count(n) and r.tokens == n * r.docs
        assert r.docs_longer == sum(x > n for x in lengths)
        assert r.tokens_longer == sum(x for x in lengths if x > n)
        assert r.truncated_tokens == sum(min(x, n) for x in lengths)
        assert abs(r.docs_share - sum(x <= n for x in lengths) / len(lengths)) < 1e-8
    limits = [0, 5, 256, 1000, 10**9]
    for r in at_limits(hist, limits).collect():
        assert r.tokens_kept == sum(min(x, r.limit) for x in lengths)
        assert r.docs_cut == sum(x > r.limit for x in lengths)
        assert r.tokens_lost == sum(lengths) - r.tokens_kept
    ordered = sorted(lengths)
    for r in quantiles(hist, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == ordered[-(-int(r.level * len(ordered) * 10) // 10) - 1]


def test_token_lengths(spark):
    from churnlens.llm.token_counts import _encoding

    texts = [None, "", "Hello world", "Hello world", " \n ", "é" * 20_000, "<|endoftext|>"]
    df = spark.createDataFrame([(k if k != 2 else None, t, "c", 1) for k, t in enumerate(texts)],
                               "doc_id long, text string, n_tokens string, docs int")
    got = sorted((tuple(r) for r in token_lengths(df, PATH, public_tokenizers.PATTERN).collect()), key=str)
    enc = _encoding(PATH, public_tokenizers.PATTERN)
    want = sorted(((k if k != 2 else None, len(enc.encode_ordinary(t or ""))) for k, t in enumerate(texts)), key=str)
    assert got == want
    assert enc.decode(enc.encode_ordinary(texts[5])) == texts[5]
    assert length_histogram(token_lengths(df.limit(0), PATH, public_tokenizers.PATTERN)).collect() == []
