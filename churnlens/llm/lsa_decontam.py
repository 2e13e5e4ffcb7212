"""Benchmark decontamination by latent semantic retrieval.

1. Words (lower case, outer punctuation stripped) become 32-bit hashes, written once.
2. Passages of 64 words are TF-IDF rows A over hashed features, scaled to equal
   length.  A distributed randomised SVD gives their leading right singular
   vectors: tasks sum A'(A R) for a fixed random R, and the driver
   decomposes that (features x rank) sum by Nystrom's method.
3. Benchmark passages and sliding document windows, as long as the passage and shorter, meet
   in the latent space, each direction scaled by its singular value; a cosine above a
   bound makes a candidate.
4. Candidates are verified on their words: longest common subsequence, and for
   paraphrases the share of the answer's words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.store import written
from churnlens.llm.text import PIECE_BYTES, U64, slices, words

FEATURES = 1 << 13
RANK = 64
EXTRA = 8              # oversampling of the random range
PASSAGE = 64           # words of a passage at most: one bit each in the subsequence search
STEP = 4               # words between window starts
MIN_COSINE = 0.48
SPANS = (1.0, 0.7)     # lengths of the search windows, as shares of the passage's: words may have been deleted
DENSE = 5              # windows of up to so many steps start every step, longer ones every other
VERBATIM = 0.8         # share of a passage in common order that settles it
PARAPHRASE = 0.6       # share that settles it together with the answer
ANSWER_SHARE = 0.5     # share of the answer's words in the window
AT_ONCE = 2048         # steps searched together, an even number
BLOCK = 100_000        # benchmark passages (256 bytes each) that are broadcast at a time
_NO_WORD = np.uint32(0)


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts (never 0), and the texts' offsets.  Signs without a letter or digit are no words."""
    w = words(texts, lower=False)
    core = pc.utf8_lower(pc.utf8_trim(w.vocab, ".,;:!?\"'()[]{}<>«»“”„‘’…*#|&%$-–—"))
    keep = pc.greater(pc.binary_length(core), 0).to_numpy(zero_copy_only=False)
    h = type(w)(w.codes, w.offsets, core).hashes().astype(np.uint32) | np.uint32(1)
    at = keep[w.codes]
    offsets = np.concatenate(([0], np.cumsum(at)))[w.offsets]
    return h[w.codes[at]], offsets


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, max_bytes=PIECE_BYTES):
        codes, at = _codes(part.column("text").fill_null(""))
        raw = pa.py_buffer(codes.astype("<u4").tobytes())
        binary = pa.Array.from_buffers(pa.binary(), part.num_rows,
                                       [None, pa.py_buffer((at * 4).astype(np.int32).tobytes()), raw])
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), binary], ["doc_id", "codes"])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch piece, its codes, offsets of its documents)."""
    for part in slices(batches, text="codes", max_bytes=800_000):
        column = part.column("codes")
        at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // 4
        codes = np.frombuffer(column.buffers()[2] or b"", "<u4")[at[0]:at[-1]]
        yield part, codes, (at - at[0]).astype(np.int64)


def _feature(codes: np.ndarray) -> np.ndarray:
    return ((codes >> np.uint32(1)) & np.uint32(FEATURES - 1)).astype(np.int64)


def _passages(offsets: np.ndarray) -> np.ndarray:
    """Starts of the consecutive 64-word passages of all documents, with the end of the last."""
    n = -(-np.diff(offsets) // PASSAGE)
    first = np.repeat(offsets[:-1], n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.concatenate((first + k * PASSAGE, offsets[-1:]))


def _sums(basis: np.ndarray, codes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the basis rows of every ``size`` words of a document, and the number of each document's first sum."""
    first = np.concatenate(([0], np.cumsum(-(-np.diff(offsets) // size))))
    # documents are filled up to whole sums with a feature of no weight
    filled = np.full(first[-1] * size, FEATURES, np.int32)
    filled[np.arange(len(codes)) + np.repeat(first[:-1] * size - offsets[:-1], np.diff(offsets))] = _feature(codes)
    nth = np.ascontiguousarray(filled.reshape(-1, size).T)
    padded = np.concatenate((basis, np.zeros((1, basis.shape[1]), basis.dtype)))
    total = np.zeros((first[-1], basis.shape[1]), basis.dtype)
    rows = np.empty((1024, basis.shape[1]), basis.dtype)
    for low in range(0, len(total), len(rows)):   # a piece stays in the processor's cache
        own = total[low:low + len(rows)]
        for word in nth[:, low:low + len(rows)]:
            own += np.take(padded, word, axis=0, out=rows[:len(own)], mode="clip")
    return total, first


def _document_frequency(table: DataFrame) -> tuple[np.ndarray, int]:
    """Passages that hold each feature, and the number of passages: FEATURES + 1 rows are collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(FEATURES, np.int64), 0
        for _, codes, offsets in _stream(batches):
            starts, f = _passages(offsets), _feature(codes)
            for first in range(0, len(starts) - 1, 1024):
                ends = starts[first:first + 1025]
                of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                held = np.sort((of * FEATURES + f[ends[0]:ends[-1]]).astype(np.uint32))
                once = held[np.flatnonzero(np.diff(held, prepend=~held[:1]))]
                df += np.bincount(once % np.uint32(FEATURES), minlength=FEATURES)
            n += len(starts) - 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1)), pa.array(np.append(df, n))],
                                         ["feature", "n"])

    sums = (table.select("codes").mapInArrow(run, "feature long, n long").groupBy("feature")
            .agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(FEATURES + 1, np.int64)
    out[sums.column("feature").to_numpy()] = sums.column("n").to_numpy()
    return out[:FEATURES], int(out[FEATURES])


def _summed(table: DataFrame, each) -> np.ndarray:
    """Sum over all pieces of the matrix ``each(codes, offsets)``, reduced in 64 shares of its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, codes, offsets in _stream(batches):
            if len(codes):
                value = each(codes, offsets)
                total = value if total is None else np.add(total, value, out=total)
        if total is not None:
            shares = np.array_split(total, 64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(64, dtype=np.int32)), pa.array([s.astype("<f8").tobytes() for s in shares])],
                ["share", "packed"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<f8") for x in group.column("packed").to_pylist())
        return pa.table({"share": pa.array([group.column("share")[0].as_py()], pa.int32()),
                         "packed": [total.tobytes()]})

    schema = "share int, packed binary"
    rows = table.select("codes").mapInArrow(run, schema).groupBy("share").applyInArrow(add, schema).collect()
    return np.concatenate([np.frombuffer(r.packed, "<f8") for r in sorted(rows, key=lambda r: r.share)]
                          or [np.empty(0)])


def latent_basis(table: DataFrame) -> np.ndarray:
    """The idf-weighted basis (FEATURES x RANK) of all passages.  Empty corpora give a zero basis."""
    df, n = _document_frequency(table)
    idf = np.log((n + 1) / (df + 1)).astype(np.float32)
    if not df.any():
        return np.zeros((FEATURES, RANK), np.float32)
    width = RANK + EXTRA
    start = np.random.default_rng(20).standard_normal((FEATURES, width)).astype(np.float32)
    weighted = start * idf[:, None]

    def back(codes, offsets):
        f = _feature(codes)
        rows, _ = _sums(weighted, codes, offsets, PASSAGE)
        # a random projection keeps lengths: its mean square estimates the row's squared length
        rows /= np.maximum(np.mean(rows * rows, axis=1, keepdims=True), 1e-9)
        of = np.repeat(np.arange(len(rows)), np.diff(_passages(offsets)))
        out, of_word = np.empty((width, FEATURES)), np.empty(len(f))
        for column, of_row in zip(out, np.ascontiguousarray(rows.T, np.float64)):
            column[:] = np.bincount(f, np.take(of_row, of, out=of_word, mode="clip"), FEATURES)
        return out

    # A'A ~ Y (R'Y)^-1 Y', shifted for stability (Tropp et al., 2017)
    y = _summed(table, back).reshape(width, FEATURES).T * idf[:, None]
    r = start.astype(np.float64)
    shift = 1e-6 * np.linalg.norm(y)
    y = y + shift * r
    inner = r.T @ y
    lower = np.linalg.cholesky((inner + inner.T) / 2 + 1e-9 * np.trace(inner) / width * np.eye(width))
    vectors, values, _ = np.linalg.svd(np.linalg.solve(lower, y.T).T, full_matrices=False)
    scale = np.where(values[:RANK] > 1e-6 * values[0], 1 / np.maximum(values[:RANK], 1e-300), 0)
    basis = vectors[:, :RANK] * scale / scale.max()
    return (basis * idf[:, None]).astype(np.float32)


def subsequence(passage: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Longest common subsequence of a passage (64 words at most) with each row of ``windows``.

    Bit-parallel: a cleared bit of a row's word marks a passage word that lengthened the subsequence.
    """
    order = np.argsort(passage, kind="stable")
    vocab, first = np.unique(passage[order], return_index=True)
    bits = np.bitwise_or.reduceat(U64(1) << order.astype(U64), first)
    by_place = np.ascontiguousarray(windows.T)
    at = np.minimum(np.searchsorted(vocab, by_place), len(vocab) - 1)
    masks = np.where(vocab[at] == by_place, bits[at], U64(0))
    full = U64(2**64 - 1)
    v = np.full(len(windows), full)
    with np.errstate(over="ignore"):
        for mask in masks:
            u = v & mask
            v = (v + u) | (v - u)
    used = U64((1 << len(passage)) - 1) if len(passage) < 64 else full
    return np.bitwise_count(~v & used).astype(np.int64)


@dataclass
class Passages:
    """Benchmark passages: item number, words, answer words, latent unit vectors."""

    item: list[int]
    codes: list[np.ndarray]
    answer: list[np.ndarray]
    latent: np.ndarray


def _margin(n: int) -> int:
    return max(STEP, n // 4)


def benchmark_passages(rows: list[tuple[int, str]], basis: np.ndarray) -> Passages:
    """Cut items into passages of 64 words at most, of even length.

    The benchmark names no answers; an item's answer is taken to be its last line
    or sentence, in which questions of this kind put it.
    """
    item, codes, answer = [], [], []
    for item_id, text in rows:
        own, _ = _codes(pa.array([text], pa.string()))
        if not len(own):
            continue
        tail = [s for s in text.replace("\n", ". ").split(". ") if s.strip(" .")][-1]
        last, _ = _codes(pa.array([tail], pa.string()))
        for piece in np.array_split(own, -(-len(own) // PASSAGE)):
            item.append(item_id)
            codes.append(piece)
            answer.append(np.unique(last))
    latent = np.array([basis[_feature(c)].sum(axis=0) for c in codes]).reshape(len(codes), basis.shape[1])
    norm = np.linalg.norm(latent, axis=1, keepdims=True)
    return Passages(item, codes, answer, (latent / np.maximum(norm, 1e-9)).astype(np.float32))


def _candidates(codes: np.ndarray, offsets: np.ndarray, basis: np.ndarray, bench: Passages):
    """(steps, passage numbers) whose windows point into a passage's direction, each pair once, and each step's
    document and first word.  Windows of every share in SPANS of the passage's length are looked at."""
    sums, first = _sums(basis, codes, offsets, STEP)
    doc_of = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    place = np.arange(len(sums)) - first[doc_of]
    lengths = np.array([len(c) for c in bench.codes])
    spans = np.maximum(np.rint(np.outer(SPANS, lengths) / STEP).astype(np.int64), 1)
    longest = int(spans.max())
    # steps are laid out with empty ones between documents, so no window runs into the next document
    room = np.diff(first) + longest
    begin = np.concatenate(([0], np.cumsum(room + room % 2)))
    at, end = begin[doc_of] + place, int(begin[-1])
    laid = np.zeros((end + longest, basis.shape[1]), np.float32)
    laid[at] = sums
    step_at = np.full(end, -1)
    step_at[at] = np.arange(len(sums))
    of_span = {}
    for span in np.unique(spans):
        members = np.flatnonzero((spans == span).any(axis=0))
        of_span[int(span)] = members, np.ascontiguousarray(bench.latent[members].T)
    steps, passages = [], []
    for low in range(0, end, AT_ONCE):
        high = min(low + AT_ONCE, end)
        z, every = np.zeros((high - low, basis.shape[1]), np.float32), 1
        for span in range(1, longest + 1):   # each window grows by a step; a piece stays in the processor's cache
            if span == DENSE + 1:
                z, every = z[::2].copy(), 2
            z += laid[low + span - 1:high + span - 1:every]
            if span in of_span:
                members, latent = of_span[span]
                bound = MIN_COSINE * np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-9)
                hit, which = np.divmod(np.flatnonzero(z @ latent >= bound[:, None]), len(members))
                step = step_at[low + hit * every]
                steps.append(step[step >= 0])
                passages.append(members[which[step >= 0]])
    pairs = np.unique(np.concatenate(passages) * len(sums) + np.concatenate(steps))
    return pairs % len(sums), pairs // len(sums), doc_of, offsets[doc_of] + place * STEP


def _search(codes: np.ndarray, offsets: np.ndarray, basis: np.ndarray, bench: Passages):
    """Verified (document, passage number, subsequence length, first word), one per document at most."""
    if not len(codes) or not bench.codes:
        return []
    steps, passages, doc_of, starts = _candidates(codes, offsets, basis, bench)
    best: dict[int, tuple] = {}
    edges = np.flatnonzero(np.diff(passages, prepend=-1, append=len(bench.codes)))
    for begin, end in zip(edges, edges[1:]):
        for some in range(begin, end, 16384):
            _verify(codes, offsets, doc_of, starts, steps[some:min(some + 16384, end)], int(passages[begin]), bench, best)
    return [(d, *v) for d, v in best.items()]


def _verify(codes, offsets, doc_of, starts, hits, p, bench: Passages, best: dict) -> None:
    """Check candidate windows of passage ``p`` on their words, with half a passage of margin."""
    passage, answer = bench.codes[p], bench.answer[p]
    n = len(passage)
    margin = _margin(n)
    doc = doc_of[hits]
    begin = np.maximum(starts[hits] - margin, offsets[doc])
    index = begin[:, None] + np.arange(n + 2 * margin + STEP)
    inside = index < offsets[doc + 1][:, None]
    windows = np.where(inside, codes[np.minimum(index, len(codes) - 1)], _NO_WORD)
    # a subsequence cannot be longer than the window's words that the passage holds
    known = np.zeros(1 << 16, bool)
    known[passage & np.uint32(0xFFFF)] = True  # may take other words along, so it misses none
    possible = known[windows & np.uint32(0xFFFF)].sum(axis=1) >= PARAPHRASE * n
    if not possible.any():
        return
    doc, begin, windows = doc[possible], begin[possible], windows[possible]
    length = subsequence(passage, windows)
    answered = np.zeros(len(windows))
    for k in np.flatnonzero((length >= PARAPHRASE * n) & (length < VERBATIM * n)):
        answered[k] = np.isin(answer, windows[k]).mean()
    sure = (length >= VERBATIM * n) | ((length >= PARAPHRASE * n) & (answered >= ANSWER_SHARE))
    for k in np.flatnonzero(sure):
        found = (length[k] / n, -int(p), int(length[k]), int(begin[k] - offsets[doc[k]]))
        if int(doc[k]) not in best or found > best[int(doc[k])]:
            best[int(doc[k])] = found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Find the documents that hold a benchmark passage, verbatim or paraphrased.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are
    ignored.  One row per input row: doc_id, kept (false if contaminated), item_id of the
    best passage, overlap (its share in common order) and at_word; the last three
    are NULL for kept documents.  NULL and word-less texts are kept; a NULL doc_id
    is passed on; items without words match nothing; ties go to the passage
    named first by item_id.  Texts are read whole, however long, and repeated rows are judged alike.  A larger
    benchmark is searched in blocks of BLOCK passages, each block's matches written before the next.
    """
    table = written(docs.select("doc_id", "text").mapInArrow(_encode, "doc_id long, codes binary")
                    .withColumn("row", F.monotonically_increasing_id()), "codes")
    basis = latent_basis(table)
    shared = docs.sparkSession.sparkContext.broadcast(basis)
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    passages = items.agg(F.sum(F.ceil(F.size(F.split("text", r"\s+")) / PASSAGE))).head()[0] or 0
    n_blocks = max(1, -(-int(passages) // BLOCK))
    schema = "row long, doc_id long, item_id long, overlap double, at_word long"

    def matches(block: int) -> tuple[DataFrame, Broadcast]:
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).orderBy("item_id", "text")
        bench = docs.sparkSession.sparkContext.broadcast(
            benchmark_passages([(r.item_id, r.text) for r in own.collect()], basis))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, codes, offsets in _stream(batches):
                item, overlap, at = ([None] * part.num_rows for _ in range(3))
                for d, share, p, _, word in _search(codes, offsets, shared.value, bench.value):
                    item[d], overlap[d], at[d] = bench.value.item[-p], share, word
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(item, pa.int64()),
                     pa.array(overlap, pa.float64()), pa.array(at, pa.int64())],
                    ["row", "doc_id", "item_id", "overlap", "at_word"])

        return table.mapInArrow(run, schema), bench

    if n_blocks == 1:
        found, _ = matches(0)
    else:
        found = None
        for block in range(n_blocks):
            rows, passages = matches(block)
            rows = written(rows, "matches")
            passages.unpersist()   # the driver and the executors hold one block at a time
            found = rows if found is None else found.unionAll(rows)
        found = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max(F.struct(
            "overlap", -F.col("item_id"), "item_id", "at_word")).alias("m")).select("row", "doc_id", "m.*")
    return found.select("doc_id", F.col("item_id").isNull().alias("kept"), "item_id", "overlap", "at_word")
