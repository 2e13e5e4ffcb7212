"""Quality rules: fixed text measures, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed words and word pairs, one of trusted documents and
one of the whole corpus; a document's score is the mean over its n-grams of
log p_trusted - log p_corpus (so it does not depend on length), compared with
one threshold that the rated documents fix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.rated import grades
from churnlens.llm.store import written
from churnlens.llm.text import U64, Words, mix64, slices, windows, words

BUCKETS = 1 << 14
SMOOTHING = 1.0        # pseudo-count of every bucket
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
TRUSTED_COST = 10      # losing a share of the trusted documents weighs so many times keeping that of the poor
GRID = 1000            # scores are compared in steps of 1 / GRID
SYMBOLS = "[#*$%&|<>]"


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated_words(w: Words) -> np.ndarray:
    """Words inside 3-word windows that occur twice or more in their document."""
    if len(w.codes) < 4:
        return np.zeros(len(w.lengths), np.int64)
    h, doc = windows(mix64(w.codes.astype(U64)), w.lengths, 3)
    key = mix64(h ^ mix64(doc.astype(U64)))
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    covered = np.zeros(len(w.codes) + 1, bool)
    if len(twice):
        inside = w.doc_of[:-2] == w.doc_of[2:]
        at = np.flatnonzero(inside)[np.isin(key, twice)]
        for k in range(3):
            covered[at + k] = True
    return _per_doc(covered[:-1].astype(np.int64), w.offsets)


def _duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lists = pc.split_pattern(texts, "\n")
    encoded = lists.values.dictionary_encode()
    at = lists.offsets.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    code = encoded.indices.to_numpy(zero_copy_only=False)[at[0]:at[-1]].astype(np.int64)
    worded = pc.match_substring_regex(encoded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    keep = worded[code]
    doc, code = doc[keep], code[keep]
    distinct = np.unique(doc * max(len(worded), 1) + code) // max(len(worded), 1)
    return np.bincount(doc, minlength=len(texts)) - np.bincount(distinct, minlength=len(texts))


def measures(texts: pa.Array, w: Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words per text."""
    of_word = lambda counts: counts.to_numpy(zero_copy_only=False).astype(np.int64)[w.codes]
    return {
        "n_words": w.lengths,
        "word_chars": _per_doc(of_word(pc.utf8_length(w.vocab)), w.offsets),
        "n_symbols": _per_doc(of_word(pc.count_substring_regex(w.vocab, SYMBOLS)), w.offsets),
        "n_dup_lines": _duplicate_lines(texts),
        "n_repeat_words": _repeated_words(w),
    }


def _ngrams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every word and word pair."""
    h = w.hashes()[w.codes] if len(w.codes) else np.empty(0, U64)
    pairs, pair_doc = windows(h, w.lengths, 2)
    bucket = np.concatenate((mix64(h), pairs)) & U64(BUCKETS - 1)
    return bucket.astype(np.int64), np.concatenate((w.doc_of, pair_doc))


def _scores(w: Words, ratio: np.ndarray) -> np.ndarray:
    """Mean log ratio per document on the grid; 0 without words."""
    bucket, doc = _ngrams(w)
    total = np.bincount(doc, ratio[bucket], minlength=len(w.lengths))
    return np.round(total / np.maximum(np.bincount(doc, minlength=len(w.lengths)), 1) * GRID) / GRID


def _bucket_counts(docs: DataFrame) -> np.ndarray:
    """N-grams per bucket over all documents.

    Each task sums its own counts and emits one row per bucket; BUCKETS rows reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for part in slices(batches):
            bucket, _ = _ngrams(words(part.column("text")))
            counts += np.bincount(bucket, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    sums = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out


def ngram_counts(docs: DataFrame, rated: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bucket counts over all documents, and over all trusted (grade 2) ones."""
    trusted = docs.select("doc_id", "text").join(rated.where("grade = 2").select("doc_id"), "doc_id")
    return _bucket_counts(docs), _bucket_counts(trusted)


def log_ratio(corpus: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """log p_trusted - log p_corpus per bucket, add-one smoothed; 0 without trusted text."""
    if not trusted.sum():
        return np.zeros(len(corpus))
    p, q = ((c + SMOOTHING) / (c.sum() + SMOOTHING * len(c)) for c in (trusted, corpus))
    return np.log(p) - np.log(q)


def threshold(scored: DataFrame, rated: DataFrame) -> float:
    """The grid score that best parts the trusted documents from the poor ones.

    Documents below it are rejected; the least weighted loss decides, and within a gap
    its middle.  The scores are counted per grid step and grade, so a bounded number of
    rows is collected.  -inf without trusted or without poor documents.
    """
    counts = (scored.select("doc_id", "score").join(rated.where("grade > 0"), "doc_id").groupBy("score")
              .agg(F.count(F.when(F.col("grade") == 2, 1)).alias("trusted"),
                   F.count(F.when(F.col("grade") == 1, 1)).alias("poor")).orderBy("score").toArrow())
    trusted, poor = (counts.column(c).to_numpy().astype(float) for c in ("trusted", "poor"))
    if not trusted.sum() or not poor.sum():
        return float("-inf")
    score = counts.column("score").to_numpy()
    # loss of rejecting the first k steps
    below = lambda n: np.concatenate(([0.0], np.cumsum(n))) / n.sum()
    loss = TRUSTED_COST * below(trusted) + 1 - below(poor)
    k = int(loss.argmin())
    if k == 0:
        return float("-inf")
    return float((score[k - 1] + score[min(k, len(score) - 1)]) / 2)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Measures and verdict of every document.

    ``docs`` needs doc_id and text, ``labels`` doc_id, quality and toxic; other columns are
    ignored.  One row per input row: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, score, kept.  NULL and empty texts
    have no words and fail the base rules; a NULL doc_id is kept as it is, rated by no
    label; repeated rows repeat.  Without trusted documents the ratio is
    neutral and only the base rules decide.  The multinomials and the threshold count
    all documents and all ratings.
    """
    rated = grades(labels).hint("merge")  # one plan at every size: ratings grow with the documents
    ratio = log_ratio(*ngram_counts(docs, rated))
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").fill_null("")
            w = words(texts)
            m = measures(texts, w)
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
            score = _scores(w, shared.value)
            columns = {"doc_id": part.column("doc_id"), **{k: pa.array(v) for k, v in m.items()},
                       "base_failed": pa.array(failed), "score": pa.array(score)}
            yield pa.RecordBatch.from_pydict(columns)

    scored = written(docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, score double"), "scored")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold(scored, rated)))
