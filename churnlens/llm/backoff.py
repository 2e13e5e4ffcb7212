"""Language-model scoring by stupid backoff, with the corpus itself as the model.

Each document is scored by the n-gram counts of all other documents.  Documents
are taken in blocks of about a million words.  A block counts its own n-grams and
sends each distinct one once, with its count, to the hash bucket that owns it;
the bucket adds up the counts and answers each block; the block joins the
totals to its documents' n-grams and sums per document.  So an n-gram of a third of
all documents costs one entry per block, and no n-gram table is ever broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.store import bucketed
from churnlens.llm.text import U64, mix64, slices, words

ORDER = 3
BACKOFF = 0.4
BUCKET_WORDS = 1_000_000   # words of the corpus per hash bucket: bounds a bucket's memory at any size
REMAINDER_BITS = 47        # of a hash inside its bucket: of a million n-grams, 7e-9 meet another's
BLOCK_BYTES = 12_000_000   # of text: larger blocks repeat more of their n-grams, and so send fewer


def pack(values: np.ndarray) -> bytes:
    """Rising unsigned numbers as gaps of the fewest whole bytes that hold them all."""
    gaps = np.diff(values, prepend=U64(0))
    width = max(1, (int(gaps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    width = packed[0]
    raw = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, width)
    gaps = np.zeros((len(raw), 8), np.uint8)
    gaps[:, :width] = raw
    return np.cumsum(gaps.view("<u8").ravel(), dtype=U64)


def pack_counts(counts: np.ndarray) -> bytes:
    """One byte each; 255 stands for the next of the larger ones, which follow as 64-bit numbers."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(packed, "<i8", offset=n)
    return counts


def pack_places(places: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, compressed: most of them are small."""
    return pa.compress(places.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpack_places(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block of documents: ids, lengths in words, word hashes, and each word's place among them."""
    for part in slices(batches, max_rows=1 << 16, max_bytes=BLOCK_BYTES):
        w = words(part.column("text"))
        # frequent words first, so that their places are short
        order = np.argsort(-np.bincount(w.codes, minlength=len(w.vocab)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        yield pa.RecordBatch.from_arrays(
            [pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
             pa.array([w.lengths.astype(np.int32)], pa.list_(pa.int32())),
             pa.array([w.hashes()[order].tobytes() if len(order) else b""], pa.binary()),
             pa.array([pack_places(rank[w.codes])], pa.binary()), pa.array([len(w.codes)], pa.int64())],
            ["doc_ids", "lengths", "vocab", "places", "n_words"])


def _grams(vocab: bytes, places: bytes, lengths: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to ``order``, one at a time: (hashes, end positions) of all n-grams inside documents."""
    size = int(lengths.sum())
    h = mix64(np.frombuffer(vocab, U64))[unpack_places(places, size)] if size else np.empty(0, U64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    yield h, np.arange(len(h))
    value = h
    for n in range(2, order + 1):
        value = mix64(value[:-1] if len(value) else value) ^ (h[n - 1:] * U64(2 * n + 1))
        ends = np.arange(n - 1, n - 1 + len(value))
        inside = doc[ends] == doc[ends - n + 1]
        yield mix64(value[inside]), ends[inside]


def _edges(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the 2^bits buckets begins among sorted hashes, and the end."""
    starts = np.arange(1, 1 << bits, dtype=U64) << U64(64 - bits)
    return np.concatenate(([0], np.searchsorted(hashes, starts), [len(hashes)]))


def backoff_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, unseen (words that no other document holds), mean_log_score.

    ``docs`` needs doc_id and text; other columns are ignored.  With c the counts over all other
    rows, a word at place i of its document scores c(w[i-n+1..i]) / c(w[i-n+1..i-1])
    for the largest n <= min(order, i + 1) whose n-gram has a count, times 0.4 per
    skipped order; for n = 1 the denominator is the number of all other rows' words T; an
    unseen word scores 0.4 more often over T + 1.  The mean of the logarithms is
    rounded to 6 places.  Texts without words (NULL and empty ones) have a NULL score.  Every
    row is a document of its own, so a repeated row sees its copy; a NULL doc_id is passed on.
    """
    blocks = bucketed(docs.select("doc_id", "text").mapInArrow(
        _blocks, "doc_ids array<long>, lengths array<int>, vocab binary, places binary, n_words long")
        .withColumn("block", F.monotonically_increasing_id()), "block", "blocks")
    total = blocks.agg(F.sum("n_words")).head()[0] or 0
    bits = max(3, (total // BUCKET_WORDS).bit_length())
    shift, mask = 64 - bits - REMAINDER_BITS, (1 << REMAINDER_BITS) - 1

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                lengths = row["lengths"].values.to_numpy()
                for n, (h, _) in enumerate(_grams(row["vocab"].as_py(), row["places"].as_py(), lengths, order), 1):
                    distinct, count = np.unique(h, return_counts=True)
                    edges = _edges(distinct, bits)
                    rest = (distinct >> U64(shift)) & U64(mask)
                    used = np.flatnonzero(np.diff(edges))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(used), n, np.int32)), pa.array(used.astype(np.int32)),
                         pa.array(np.full(len(used), row["block"].as_py(), np.int64)),
                         pa.array([pack(rest[edges[b]:edges[b + 1]]) for b in used], pa.binary()),
                         pa.array([pack_counts(count[edges[b]:edges[b + 1]]) for b in used], pa.binary())],
                        ["n", "bucket", "block", "grams", "counts"])

    def add_up(group: pa.Table) -> pa.Table:
        grams = [unpack(x) for x in group.column("grams").to_pylist()]
        counts = [unpack_counts(x, len(g)) for x, g in zip(group.column("counts").to_pylist(), grams)]
        distinct, at = np.unique(np.concatenate(grams), return_inverse=True)
        totals = np.bincount(at, np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        ends = np.cumsum([len(g) for g in grams])
        answers = [pack_counts(totals[at[e - len(g):e]]) for e, g in zip(ends, grams)]
        return pa.table({"n": group.column("n"), "bucket": group.column("bucket"), "block": group.column("block"),
                         "totals": pa.array(answers, pa.binary())})

    asked = blocks.select("block", "lengths", "vocab", "places").mapInArrow(
        requests, "n int, bucket int, block long, grams binary, counts binary")
    answers = asked.groupBy("n", "bucket").applyInArrow(add_up, "n int, bucket int, block long, totals binary")

    def score(own: pa.Table, answered: pa.Table) -> pa.Table:
        out = []
        packed = {(n, b): t for n, b, t in zip(*(answered.column(c).to_pylist() for c in ("n", "bucket", "totals")))}
        for row in own.to_pylist():
            lengths = np.asarray(row["lengths"], np.int64)
            grams = _grams(row.pop("vocab"), row.pop("places"), lengths, order)
            out.append(_scored(row["doc_ids"], lengths, grams, packed, bits, total))
        return pa.concat_tables(out)

    return (blocks.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(score, "doc_id long, n_words long, unseen long, mean_log_score double"))


def _scored(doc_ids: list, lengths: np.ndarray, grams: Iterator, packed: dict, bits: int, total: int) -> pa.Table:
    """Scores of one block's documents from the totals of its distinct n-grams."""
    size = int(lengths.sum())
    doc = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    others = total - lengths
    counts = []  # per n: count in other documents of the n-gram that ends at each word
    for n, (h, ends) in enumerate(grams, 1):
        distinct, at = np.unique(h, return_inverse=True)
        edges = _edges(distinct, bits)
        totals = np.empty(len(distinct), np.int64)
        for b in np.flatnonzero(np.diff(edges)):
            totals[edges[b]:edges[b + 1]] = unpack_counts(packed.pop((n, int(b))), edges[b + 1] - edges[b])
        key = doc[ends] * max(len(distinct), 1) + at
        del h, distinct
        here = np.zeros(size, np.int64)
        here[ends] = totals[at]
        del at, totals
        _, first, own = np.unique(key, return_inverse=True, return_counts=True)
        here[ends] -= own[first]
        del key, first, own
        counts.append(here)
    before = lambda c: np.concatenate(([0], c[:-1])) if size else c
    largest = np.minimum(len(counts), place + 1)
    with np.errstate(divide="ignore"):
        log = np.log(BACKOFF) * largest - np.log(others + 1.0)[doc]  # unseen words
        settled = np.zeros(size, bool)
        for n in range(len(counts), 0, -1):
            hit = ~settled & (counts[n - 1] > 0)
            below = before(counts[n - 2]) if n > 1 else others[doc]
            log[hit] = (np.log(BACKOFF) * (largest - n) + np.log(np.maximum(counts[n - 1], 1))
                        - np.log(np.maximum(below, 1)))[hit]
            settled |= hit
    sums = np.bincount(doc, log, minlength=len(lengths))
    unseen = np.bincount(doc[~settled], minlength=len(lengths))
    mean = np.round(sums / np.maximum(lengths, 1), 6)
    return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_words": pa.array(lengths),
                     "unseen": pa.array(unseen.astype(np.int64)),
                     "mean_log_score": pa.array(mean, mask=lengths == 0)})
