"""Words of whole texts as numpy arrays, one Arrow batch slice at a time.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]`` everywhere in this package.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
_GOLD = U64(0x9E3779B97F4A7C15)
_MIX1 = U64(0xBF58476D1CE4E5B9)
_MIX2 = U64(0x94D049BB133111EB)
PIECE_BYTES = 1_000_000  # of text at a time where a piece takes many times its size in a worker


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public SplitMix64 generator, elementwise."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x = (x ^ (x >> U64(30))) * _MIX1
        x = (x ^ (x >> U64(27))) * _MIX2
        return x ^ (x >> U64(31))


@dataclass
class Words:
    """The words of consecutive texts: ``vocab[codes[offsets[d]:offsets[d+1]]]`` are document d's."""

    codes: np.ndarray
    offsets: np.ndarray
    vocab: pa.Array

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1, dtype=np.int64), self.lengths)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of each vocabulary entry."""
        vocab = self.vocab.cast(pa.binary()).to_numpy(zero_copy_only=False)
        return np.fromiter(map(xxhash.xxh3_64_intdigest, vocab, repeat(seed)), dtype=U64, count=len(vocab))


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Split texts (NULL: no words); ``lower`` folds A-Z only."""
    texts = texts.fill_null("")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    encoded = flat.dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    vocab = encoded.dictionary
    empty = pc.index(vocab, "").as_py()
    if empty >= 0:  # leading and trailing white space leaves empty strings
        real = codes != empty
        offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
        codes = codes[real]
        codes = np.where(codes > empty, codes - 1, codes)
        vocab = pa.concat_arrays([vocab[:empty], vocab[empty + 1:]])
    return Words(codes.astype(np.int64), offsets, vocab)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", max_rows: int = 4096,
           max_bytes: int = 6_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds few rows and few text bytes
    (a single longer text is a piece of its own: texts are never cut).  Workers live on between tasks, so
    what Arrow has freed goes back to the system after each batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.binary_length(batch.column(text)).fill_null(0).to_numpy().astype(np.int64)
        ends = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + max_bytes, side="right"))
            stop = min(max(stop, start + 1), start + max_rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()


def windows(hashes: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word windows and their document index; ``hashes`` are per position."""
    doc = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
    if len(hashes) < n:
        return np.empty(0, U64), np.empty(0, np.int64)
    last = len(hashes) - n + 1
    with np.errstate(over="ignore"):
        h = hashes[:last]
        for k in range(1, n):
            h = mix64(h) ^ (hashes[k:k + last] * _MIX2 + U64(k))
    inside = doc[:last] == doc[n - 1:]
    return mix64(h[inside]), doc[:last][inside]
