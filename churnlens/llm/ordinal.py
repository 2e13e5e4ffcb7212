"""Quality classifier: cumulative-link (proportional odds) regression on graded ratings.

P(grade <= k | x) = sigmoid(t_k - w.x): one weight vector over hashed text features
for all grades, and ordered thresholds t_0 < t_1 < ...  A document's features
are the presence of its words, word beginnings and shape marks, hashed to buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.rated import RATED_ROWS, rated_sample
from churnlens.llm.store import written
from churnlens.llm.text import PIECE_BYTES, Words, mix64, slices, words

N_GRADES = 3
BUCKETS = 1 << 18
MIN_DOCS = 4        # a bucket needs so many rated documents to carry a weight
MIN_Z = 4.5         # and its documents' share above some grade so many standard errors from the overall share
L2 = 0.0003
STEPS = 250
RATE = 0.1
SPAN = 1 << 19      # features summed at a time: bounds the fit's memory
KEEP_TAIL = 0.5     # a document stays if P(top grade) reaches this
_STEMS = (4, 6)  # lengths of word beginnings


def _shape_marks(texts: pa.Array, w: Words) -> np.ndarray:
    """Document x mark matrix of bucket numbers: coarse bins of the text's shape."""
    n = w.lengths
    size = np.maximum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.float64), 1)
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
    pairs = np.unique(w.doc_of * max(len(w.vocab), 1) + w.codes) // max(len(w.vocab), 1)
    distinct = np.bincount(pairs, minlength=len(n))
    shares = [distinct / np.maximum(n, 1), count(r"\p{Lu}") / size, count(r"[#*$%&|<>]") / size,
              count(r"[!?]") / size, count(r"[0-9]") / size]
    scale = [10, 20, 50, 50, 50]
    bins = [np.minimum(s * k, 15).astype(np.int64) for s, k in zip(shares, scale)]
    bins.append(np.log2(np.maximum(n, 1)).astype(np.int64))
    bins.append(bins[0] + 64 * bins[-1])  # a long text repeats more words
    bins.append(np.minimum(size / np.maximum(n, 1), 31).astype(np.int64))
    return np.stack([_bucket(mix64((b + 4096 * (k + 1)).astype(np.uint64))) for k, b in enumerate(bins)], axis=1)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(texts: pa.Array, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every feature that is present, sorted and distinct.

    ``only``: mask of the buckets that matter; the others are left out early.
    """
    texts = texts.fill_null("")
    w = words(pc.utf8_lower(texts))
    docs = [np.repeat(np.arange(len(texts)), 8)]
    marks = [_shape_marks(texts, w).ravel()]
    if len(w.codes):
        core = pc.utf8_trim(w.vocab, ".,;:!?\"'()[]#*$%&|<>")
        for length in (None, *_STEMS):
            part = core if length is None else pc.utf8_slice_codeunits(core, 0, length)
            encoded = part.dictionary_encode()
            seed = 0 if length is None else length
            h = np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in
                             encoded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(encoded.dictionary))
            bucket = _bucket(h)[encoded.indices.to_numpy(zero_copy_only=False)]
            at = np.arange(len(w.codes)) if only is None else np.flatnonzero(only[bucket][w.codes])
            docs.append(w.doc_of[at])
            marks.append(bucket[w.codes[at]])
    key = np.unique(np.concatenate(docs) * BUCKETS + np.concatenate(marks))
    return key // BUCKETS, key % BUCKETS


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class OrdinalModel:
    """Weights by bucket and ordered thresholds (one fewer than grades)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(doc, self.weights[bucket], minlength=n)

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """Documents x grades."""
        below = _sigmoid(self.thresholds[None, :] - score[:, None])
        return np.diff(np.concatenate((np.zeros((len(score), 1)), below, np.ones((len(score), 1))), axis=1), axis=1)


def telling(counts: np.ndarray) -> np.ndarray:
    """Buckets that may carry a weight, from their documents by grade (grades x BUCKETS) and the
    documents of each grade in the last column: common enough, and with a share above some grade
    that differs from the overall share."""
    by_bucket, documents = counts[:, :-1].astype(float), counts[:, -1].astype(float)
    seen = by_bucket.sum(axis=0)
    out = np.zeros(by_bucket.shape[1], bool)
    for k in range(1, len(documents)):
        share = documents[k:].sum() / max(documents.sum(), 1)
        lift = by_bucket[k:].sum(axis=0) - share * seen
        out |= np.abs(lift) > MIN_Z * np.sqrt(share * (1 - share) * seen)
    return np.flatnonzero(out & (seen >= MIN_DOCS))


def fit(doc: np.ndarray, bucket: np.ndarray, grade: np.ndarray, used: np.ndarray, n_grades: int = N_GRADES,
        steps: int = STEPS) -> OrdinalModel:
    """Maximum penalised likelihood by full-batch Adam steps, from zero: deterministic.

    ``used``: the buckets that carry weights.  Every rated document weighs the same.  With
    fewer than two grades in the sample there is nothing to separate: the model then gives
    every document the top grade.
    """
    weights = np.zeros(BUCKETS)
    present = np.bincount(grade, minlength=n_grades)
    if (present > 0).sum() < 2:
        return OrdinalModel(weights, np.arange(n_grades - 1) - 60.0)
    column = np.full(BUCKETS, -1, np.int32)
    column[used] = np.arange(len(used))
    col = column[bucket]
    doc, col = doc[col >= 0], col[col >= 0]
    spans = [slice(at, at + SPAN) for at in range(0, len(col), SPAN)]

    def gathered(to: np.ndarray, values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Sums of values[at] by ``to``, a span at a time."""
        return sum((np.bincount(to[s], values[at[s]], minlength=n) for s in spans), np.zeros(n))

    share = 1 / len(grade)
    # thresholds: a start and positive gaps, so that they stay ordered
    p = np.concatenate((np.zeros(len(used)), [-1.0], np.zeros(n_grades - 2)))
    m, v = np.zeros_like(p), np.zeros_like(p)
    k = len(used)
    for step in range(1, steps + 1):
        gaps = np.exp(p[k + 1:])
        t = p[k] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = gathered(doc, p, col, len(grade))
        edges = np.concatenate(([-np.inf], t, [np.inf]))
        hi, lo = edges[grade + 1] - score, edges[grade] - score
        fh, fl = (np.where(np.isinf(e), np.where(e > 0, 1.0, 0.0), _sigmoid(np.where(np.isinf(e), 0, e)))
                  for e in (hi, lo))
        prob = np.maximum(fh - fl, 1e-12)
        dh, dl = fh * (1 - fh) / prob * share, fl * (1 - fl) / prob * share  # of log P by the edges
        d_score = -(dh - dl)
        grad_t = np.bincount(grade, dh, n_grades)[:-1] - np.bincount(grade, dl, n_grades)[1:]
        grad = np.concatenate((
            gathered(col, d_score, doc, k) - L2 * p[:k],
            [grad_t.sum()], np.cumsum(grad_t[::-1])[::-1][1:] * gaps))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        p = p + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights[used] = p[:k]
    return OrdinalModel(weights, p[k] + np.concatenate(([0.0], np.cumsum(np.exp(p[k + 1:])))))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, grade and the document's buckets as packed 32-bit integers."""
    for part in slices(batches, max_bytes=PIECE_BYTES):
        doc, bucket = features(part.column("text"))
        at = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=part.num_rows))))
        packed = bucket.astype("<u4")
        rows = [packed[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("grade"), pa.array(rows, pa.binary())],
                                         ["doc_id", "grade", "packed"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by bucket and grade (bucket BUCKETS: all documents), one row per bucket and task."""
    counts = np.zeros((N_GRADES, BUCKETS + 1), np.int64)
    for batch in batches:
        for grade, packed in zip(batch.column("grade").to_pylist(), batch.column("packed").to_pylist()):
            counts[grade, np.frombuffer(packed, "<u4")] += 1
            counts[grade, BUCKETS] += 1
    held = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(held), *[pa.array(c[held]) for c in counts]],
                                     ["bucket", *[f"g{k}" for k in range(N_GRADES)]])


def train(docs: DataFrame, labels: DataFrame, rows: int = RATED_ROWS) -> OrdinalModel:
    """Fit on at most ``rows`` rated documents.

    The sampled ids are broadcast (at most ``rows`` of 12 bytes) and the documents are
    scanned once.  Buckets are screened by counts that the tasks sum up; what reaches the
    driver is at most BUCKETS rows of counts, and the screened buckets of the sample.
    """
    sample = rated_sample(labels, rows)
    rated = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    table = written(rated.mapInArrow(_packed, "doc_id long, grade int, packed binary"), "rated")
    columns = [f"g{k}" for k in range(N_GRADES)]
    sums = (table.select("grade", "packed").mapInArrow(_counted, "bucket long, " + ", ".join(f"{c} long" for c in columns))
            .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns])
            .where(" + ".join(columns) + f" >= {MIN_DOCS} or bucket = {BUCKETS}").toArrow())
    counts = np.zeros((N_GRADES, BUCKETS + 1), np.int64)
    for k, c in enumerate(columns):
        counts[k, sums.column("bucket").to_numpy()] = sums.column(c).to_numpy()
    used = telling(counts)
    mask = np.zeros(BUCKETS, bool)
    mask[used] = True

    def screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(b := np.frombuffer(x, "<u4"))[mask[b]].tobytes() for x in batch.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(kept, pa.binary())],
                                             ["doc_id", "grade", "packed"])

    own = table.mapInArrow(screened, "doc_id long, grade int, packed binary").toArrow()
    own = own.sort_by([("doc_id", "ascending"), ("packed", "ascending")])  # the same sums whatever the layout
    grade = own.column("grade").to_numpy().astype(np.int64)
    lists = [np.frombuffer(x, "<u4") for x in own.column("packed").to_pylist()]
    doc = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    bucket = np.concatenate(lists) if lists else np.empty(0, np.uint32)
    del own, lists, sums
    return fit(doc, bucket, grade, used)


def classify(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, expected_grade, tail_probability (P of the top grade), grade (the likeliest), kept.

    ``docs`` needs doc_id and text; other columns are ignored.  One row per input row.  NULL and
    empty texts hold no evidence of quality: their grade is 0 and they are not kept.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        only = own.weights != 0
        for part in slices(batches, max_bytes=PIECE_BYTES):
            doc, bucket = features(part.column("text"), only)
            p = own.probabilities(own.score(doc, bucket, part.num_rows))
            p[words(part.column("text")).lengths == 0] = [1.0] + [0.0] * (p.shape[1] - 1)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(p @ np.arange(p.shape[1])), pa.array(p[:, -1]),
                 pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(p[:, -1] >= KEEP_TAIL)],
                ["doc_id", "expected_grade", "tail_probability", "grade", "kept"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, expected_grade double, tail_probability double, grade int, kept boolean")


def select_documents(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they are, in a narrow pass."""
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        only = own.weights != 0
        for part in slices(batches, max_bytes=PIECE_BYTES):
            doc, bucket = features(part.column("text"), only)
            tail = own.probabilities(own.score(doc, bucket, part.num_rows))[:, -1]
            worded = words(part.column("text")).lengths > 0
            yield part.filter(pa.array((tail >= KEEP_TAIL) & worded))

    return docs.mapInArrow(run, docs.schema)
