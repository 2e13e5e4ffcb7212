"""What a Python worker of the pipeline's operators holds at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from churnlens.llm import bpe, line_dedup, lsa_decontam, near_dup, ordinal
from churnlens.llm.text import slices

ROWS = 300


def _batch() -> pa.RecordBatch:
    rng = np.random.default_rng(5)
    texts = ["\n".join(" ".join(f"w{k}" for k in rng.integers(0, 4000, 40)) for _ in range(50)) for _ in range(ROWS)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(ROWS), pa.int64()), pa.array(texts), pa.array([1] * ROWS, pa.int64()),
         pa.array([1] * ROWS, pa.int32())], ["doc_id", "text", "version", "grade"])


@pytest.mark.parametrize("operator", [near_dup._signatures, near_dup._sets, line_dedup._lines,
                                      lsa_decontam._encode, ordinal._packed])
def test_texts_are_taken_in_small_pieces(operator):
    batch = _batch()
    assert 3_000_000 < batch.column("text").nbytes < 6_000_000
    whole = pa.Table.from_batches([p for k in range(ROWS) for p in operator(iter([batch.slice(k, 1)]))])
    pieces = list(operator(iter([batch])))
    assert len(pieces) >= 3   # was one
    assert pa.Table.from_batches(pieces).to_pylist() == whole.to_pylist()


def test_pairs_are_aligned_a_few_at_a_time():
    n = 1000
    one = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array([7] * n, pa.int64()), pa.array([[1, 2, 3]] * n, pa.list_(pa.int64())),
         pa.array([[6, 6, 6]] * n, pa.list_(pa.int32())), pa.array([[1, 2, 4]] * n, pa.list_(pa.int64()))],
        ["doc_id", "version", "hashes", "sizes", "earlier_hashes"])
    pieces = list(line_dedup._align(iter([one, one.slice(0, 0)])))
    assert len(pieces) == 4   # was one, of all rows as Python numbers
    rows = pa.Table.from_batches(pieces).to_pylist()
    assert rows == [{"doc_id": k, "version": 7, "cut": [0, 1]} for k in range(n)]


def test_encoder_remembers_few_words():
    words = bpe._Words(str.upper)
    assert all(words[f"w{k}"] == f"W{k}" for k in range(120_000))
    assert len(words) <= 50_000   # was 120,000


def test_freed_arrow_memory_is_given_back(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(1)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    assert sum(p.num_rows for p in slices(iter([_batch(), _batch()]))) == 2 * ROWS
    assert len(calls) == 2
