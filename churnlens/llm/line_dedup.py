"""Line deduplication by pairwise alignment.

Documents that share a line are paired through it, aligned with patience diff,
and the aligned common blocks are deleted from the later document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.store import written
from churnlens.llm.text import PIECE_BYTES, mix64, slices

MIN_BLOCK_WORDS = 10   # shorter common blocks stay: chance matches of short lines
PAIRS_PER_COPY = 1000  # pairs that share one copy of an earlier document's lines
PAIRS_AT_ONCE = 256    # pairs whose lines a worker holds as Python numbers


def _longest_rise(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of (i, j), given by rising i, whose j rise too."""
    tails, ends, back = [], [], []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        back.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            ends.append(k)
        else:
            tails[at], ends[at] = j, k
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned (i, j) with a[i] == b[j], rising in both.

    A range's equal start and end align; inside, the lines that occur once on either
    side align in their longest common order, and the ranges between them follow.
    """
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {h: j for j, h in enumerate(b[b0:b1], b0) if in_b[h] == 1}
        anchors = _longest_rise([(i, at_b[h]) for i, h in enumerate(a[a0:a1], a0) if in_a[h] == 1 and h in at_b])
        for i, j in anchors:
            out.append((i, j))
            todo.append((a0, i, b0, j))
            a0, b0 = i + 1, j + 1
        if anchors:
            todo.append((a0, a1, b0, b1))
    return sorted(out)


def _runs(a: list[int], b: list[int], words: list[int], cut: set[int], least: int) -> None:
    """Adds to ``cut`` the runs of ``b`` that ``a`` holds somewhere, though the alignment left them because a
    line repeats or the block moved: of several lines, found by their first two, or of one long line."""
    lines = set(a)
    at: dict[tuple[int, int], int] = {}
    for i in range(len(a) - 1):
        at.setdefault((a[i], a[i + 1]), i)
    j = 0
    while j < len(b):
        if j in cut or not words[j] or b[j] not in lines:
            j += 1
            continue
        end, total, i = j + 1, words[j], at.get((b[j], b[j + 1])) if j + 1 < len(b) else None
        if i is not None:
            while end < len(b) and i + end - j < len(a) and a[i + end - j] == b[end] and end not in cut:
                total += words[end]
                end += 1
        if total >= least:
            cut.update(range(j, end))
            j = end
        else:
            j += 1


def common_blocks(a: list[int], b: list[int], words: list[int], least: int = MIN_BLOCK_WORDS) -> list[int]:
    """Line numbers of ``b`` in aligned blocks (adjacent on both sides) of ``least`` words or more; then those of
    repeated and moved runs, as blocks of their own."""
    cut, block, last = set(), [], None
    for i, j in [*patience(a, b), (-1, -1)]:
        if last is not None and (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[k] for k in block) >= least:
                cut.update(block)
            block = []
        block.append(j)
        last = (i, j)
    _runs(a, b, words, cut, least)
    return sorted(cut)


def _keys(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Distinct keys of a text: its worded lines, and each two worded lines that follow each other."""
    worded = hashes[sizes > 0].view(np.uint64)
    return np.unique(np.concatenate((worded, mix64(mix64(worded[:-1]) ^ worded[1:])))).view(np.int64)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: the hash and word count of every line, and its distinct keys."""
    for part in slices(batches, max_bytes=PIECE_BYTES):
        lists = pc.split_pattern(part.column("text"), "\n")
        encoded = lists.values.dictionary_encode()
        line = encoded.dictionary
        split = pc.list_value_length(pc.ascii_split_whitespace(pc.ascii_trim_whitespace(line)))
        blank = pc.equal(pc.binary_length(pc.ascii_trim_whitespace(line)), 0)
        count = pc.if_else(blank, 0, split).to_numpy(zero_copy_only=False).astype(np.int32)
        h = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in line.cast(pa.binary()).to_pylist()), np.uint64,
                        len(line)).astype(np.int64)
        code = encoded.indices.to_numpy(zero_copy_only=False)
        at = lists.offsets.to_numpy().astype(np.int64)
        hashes, sizes = h[code], count[code]
        keys = [_keys(hashes[s:e], sizes[s:e]) for s, e in zip(at[:-1], at[1:])]
        ends = pa.array(np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32))
        offsets = pa.array((at - at[0]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("version"),
             pa.ListArray.from_arrays(offsets, pa.array(hashes[at[0]:at[-1]])),
             pa.ListArray.from_arrays(offsets, pa.array(sizes[at[0]:at[-1]])),
             pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))],
            ["doc_id", "version", "hashes", "sizes", "keys"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(k, PAIRS_AT_ONCE) for b in batches for k in range(0, b.num_rows, PAIRS_AT_ONCE)):
        ids, versions, cuts = [], [], []
        earlier, later, sizes = (batch.column(c).to_pylist() for c in ("earlier_hashes", "hashes", "sizes"))
        for k, (a, b, n) in enumerate(zip(earlier, later, sizes)):
            cut = common_blocks(a, b, n)
            if cut:
                ids.append(batch.column("doc_id")[k].as_py())
                versions.append(batch.column("version")[k].as_py())
                cuts.append(cut)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(versions, pa.int64()), pa.array(cuts, pa.list_(pa.int32()))],
            ["doc_id", "version", "cut"])


def common_lines(docs: DataFrame) -> DataFrame:
    """doc_id, version (hash of the text), cut: the line numbers to delete, for documents that lose any.

    Every line, and every two lines that follow each other, pair the documents that hold them with the smallest
    doc_id that does, so a line of a third of all documents gives one pair each, never all pairs; a
    block's rarest line or line pair is the one that leads to its source.  The smallest
    doc_id of a line never loses it, so no line vanishes from the corpus.
    """
    texts = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("version"), "text")
    lines = written(texts.mapInArrow(
        _lines, "doc_id long, version long, hashes array<long>, sizes array<int>, keys array<long>")
        .dropDuplicates(["doc_id", "version"]), "lines")
    held = lines.select("doc_id", "version", F.explode("keys").alias("line"))
    first = (held.groupBy("line").agg(F.min("doc_id").alias("earlier"), F.max("doc_id").alias("last"))
             .where("earlier < last").drop("last"))
    pairs = written(held.join(first, "line").where("earlier < doc_id")
                    .select("earlier", "doc_id", "version").distinct(), "pairs")
    # an earlier document of very many pairs has its lines copied once per PAIRS_PER_COPY of them
    copies = pairs.groupBy("earlier").agg(F.ceil(F.count("*") / PAIRS_PER_COPY).cast("int").alias("copies"))
    source = (copies.join(lines.select(F.col("doc_id").alias("earlier"), F.col("hashes").alias("earlier_hashes")),
                          "earlier")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies"))
    later = (pairs.join(lines.select("doc_id", "version", "hashes", "sizes"), ["doc_id", "version"])
             .join(copies, "earlier")
             .withColumn("salt", F.pmod(F.xxhash64("doc_id", "version"), "copies").cast("int")).drop("copies"))
    cuts = later.join(source, ["earlier", "salt"]).select(
        "doc_id", "version", "hashes", "sizes", "earlier_hashes").mapInArrow(
        _align, "doc_id long, version long, cut array<int>")
    return cuts.groupBy("doc_id", "version").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut"))


def without_common_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the common blocks deleted from ``text``, plus n_lines and n_cut.

    All columns of ``docs`` stay (columns named n_lines or n_cut are replaced).  A NULL text
    stays NULL with 0 lines; an empty text has one empty line; a NULL doc_id has no
    place in the order, so its row is returned as it is.  Repeated rows are
    treated alike; different texts of one doc_id are not compared with each other.
    """
    cuts = common_lines(docs).select(F.col("doc_id").alias("_cut_id"), F.col("version").alias("_cut_version"),
                                     F.col("cut").alias("_cut"))
    rows = docs.withColumn("_version", F.xxhash64("text"))
    joined = rows.join(cuts, (F.col("doc_id") == F.col("_cut_id")) & (F.col("_version") == F.col("_cut_version")),
                       "left")
    parts = F.split("text", "\n")
    kept = F.array_join(F.filter(parts, lambda line, i: ~F.array_contains("_cut", i)), "\n")
    return (joined.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long"))
            .withColumn("n_cut", F.when(F.col("_cut").isNull(), 0).otherwise(F.size("_cut")).cast("long"))
            .withColumn("text", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(kept))
            .drop("_version", "_cut_id", "_cut_version", "_cut"))
