"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find.

SuperMinHash (Ertl, 2017) gives element ``e`` the values ``j + r_j`` at the slots
``p(j)`` of its own random permutation ``p``, j = 0, 1, ...; a slot keeps its
minimum.  The ranks of one element are thus correlated, which lowers the
estimate's variance.  Early stopping: values of step j lie in [j, j+1), so
a document needs step j + 1 only while one of its slots is above.
All elements of a piece take step j together, vectorised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.components import components
from churnlens.llm.store import written
from churnlens.llm.text import PIECE_BYTES, U64, mix64, slices, windows, words

SHINGLE_WORDS = 5
ROWS = 4          # signature slots per band
BANDS = 24        # (1 - 0.8^4)^24 = 3e-6 of the links at similarity 0.8 are missed, 2e-8 at 0.85
SLOTS = ROWS * BANDS
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1_000_000  # what one side of a block holds on average at most
_DOC_BITS = 12    # documents of a piece; the other 52 bits of a sort key hold the shingle's hash
_UNSET = U64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (52 bits, sorted) of at most 4096 texts, and the set sizes.

    Fewer than five words: the whole sequence is the one shingle.  No word: empty set.
    """
    w = words(texts, lower=True)
    h = w.hashes()[w.codes] if len(w.codes) else np.empty(0, U64)
    n = w.lengths
    value, doc = windows(h, n, SHINGLE_WORDS)
    short = np.flatnonzero((n > 0) & (n < SHINGLE_WORDS))
    if len(short):
        whole = np.zeros(len(short), U64)
        for k in range(SHINGLE_WORDS - 1):
            has = n[short] > k
            step = mix64(whole[has] ^ h[w.offsets[short[has]] + k])
            whole[has] = step + U64(k + 1)
        value, doc = np.concatenate((value, mix64(whole))), np.concatenate((doc, short))
    keys = np.unique((doc.astype(U64) << U64(64 - _DOC_BITS)) | (value >> U64(_DOC_BITS)))
    sizes = np.bincount((keys >> U64(64 - _DOC_BITS)).astype(np.int64), minlength=len(n))
    return keys & U64((1 << (64 - _DOC_BITS)) - 1), sizes


def super_min_hash(elements: np.ndarray, sizes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (documents x slots) of consecutive element sets; empty sets stay unset."""
    sig = np.full((len(sizes), slots), _UNSET, U64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    seed = mix64(elements)
    picks: list[np.ndarray] = []  # each live element's Fisher-Yates choices so far
    for j in range(slots):
        if not len(doc):
            break
        draw = mix64(seed + U64(2 * j + 1))
        pick = j + (mix64(seed + U64(2 * j + 2)) % U64(slots - j)).astype(np.int64)
        slot = pick
        for i in range(j - 1, -1, -1):  # what the earlier swaps left at that place
            slot = np.where(picks[i] == slot, i, slot)
        np.minimum.at(sig.reshape(-1), doc * slots + slot, (U64(j) << U64(56)) | (draw >> U64(8)))
        live = ((sig >> U64(56)).max(axis=1) > j)[doc]
        doc, seed = doc[live], seed[live]
        picks = [p[live] for p in picks] + [pick[live]]
    return sig


def band_hashes(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of ``rows`` slots, salted with the band's number."""
    n, slots = sig.shape
    bands = sig.reshape(n, slots // rows, rows)
    h = np.broadcast_to(mix64(np.arange(slots // rows, dtype=U64)), bands.shape[:2])
    for k in range(rows):
        h = mix64(h ^ bands[:, :, k])
    return h


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, max_rows=1 << _DOC_BITS, max_bytes=PIECE_BYTES):
        keys, sizes = shingle_sets(part.column("text"))
        at = np.concatenate(([0], np.cumsum(sizes)))
        sums = [np.concatenate((np.zeros(1, U64), np.cumsum(mix64(keys ^ U64(salt)), dtype=U64)))
                for salt in (0x1D, 0x2E35)]
        low, high = (s[at[1:]] - s[at[:-1]] for s in sums)
        bands = band_hashes(super_min_hash(keys, sizes)).astype(np.int64)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * bands.shape[1]), pa.array(bands.ravel()))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(low.astype(np.int64)),
             pa.array(high.astype(np.int64)), lists], ["doc_id", "n", "d1", "d2", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, max_rows=1 << _DOC_BITS, max_bytes=PIECE_BYTES):
        keys, sizes = shingle_sets(part.column("text"))
        at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(at), pa.array(keys.astype(np.int64)))],
            ["doc_id", "shingles"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v; v the leader) whose full sets meet the similarity.

    A leader may stand in a third of all pairs: its set is copied once per
    1,000 of its pairs and the pairs are dealt over the copies.
    """
    member = pairs.join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su")), "u")
    copies = (pairs.groupBy("v").agg(F.ceil(F.count("*") / 1000).cast("int").alias("copies")))
    leader = (copies.join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv")), "v")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))))
    member = member.join(copies, "v").withColumn("salt", F.pmod(F.xxhash64("u"), "copies").cast("int"))
    both = F.size(F.array_intersect("su", "sv"))
    return (member.drop("copies").join(leader.drop("copies"), ["v", "salt"])
            .where(100 * both >= percent * (F.size("su") + F.size("sv") - both)).select("u", "v"))


def _rest(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of different components of a bucket.

    ``rows``: bucket, leader, doc_id, n, component.  Members of the leader's
    component are the main side, all others the outer side.  Each side is dealt
    into blocks by a hash; a cell is an outer block with a main block, or two
    outer blocks (or one, with itself).  A cell's size does not grow with the
    bucket, and emits one link at most for two components.
    """
    rows = rows.withColumn("outer", (F.col("component") != F.col("leader_component")).cast("int"))
    side = rows.groupBy("bucket").agg(
        *[F.greatest(F.lit(1), F.ceil(F.count(F.when(F.col("outer") == k, 1)) / BLOCK_DOCS),
                     F.ceil(F.coalesce(F.sum(F.when(F.col("outer") == k, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES))
          .cast("int").alias(f"blocks{k}") for k in (0, 1)])
    own = F.pmod(F.xxhash64("doc_id"), F.when(F.col("outer") == 1, F.col("blocks1")).otherwise(F.col("blocks0")))
    dealt = rows.join(side, "bucket").withColumn("own", own.cast("int"))
    every_outer, every_main = (F.sequence(F.lit(0), F.col(b) - 1) for b in ("blocks1", "blocks0"))
    # cells (part, kind, i, j): kind 0 is outer block i with main block j, kind 1 outer blocks i <= j;
    # kind 2 holds whole buckets of one block, many of them in a part
    small = (F.col("blocks0") == 1) & (F.col("blocks1") == 1)
    shares = max(1, rows.agg(F.sum("n")).head()[0] // BLOCK_SHINGLES + 1)
    part = F.when(small, F.pmod("bucket", F.lit(shares))).otherwise(F.col("bucket"))

    def cell(kind: int, i, j):
        return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"))

    cells = F.when(small, F.array(cell(2, F.lit(0), F.lit(0)))).when(
        F.col("outer") == 0, F.transform(every_outer, lambda i: cell(0, i, F.col("own")))).otherwise(F.concat(
            F.transform(every_main, lambda j: cell(0, F.col("own"), j)),
            F.transform(every_outer, lambda j: cell(1, F.least(j, "own"), F.greatest(j, "own")))))
    placed = (dealt.select("bucket", part.alias("part"), "doc_id", "component", "outer", "own",
                           F.explode(cells).alias("cell"))
              .select("bucket", "part", "cell.*", "doc_id", "component", "outer", "own")
              .join(sets, "doc_id"))

    def links(table: pa.Table) -> pa.Table:
        kind, i, j = (table.column(c)[0].as_py() for c in ("kind", "i", "j"))
        table = table.sort_by("bucket")
        outer, own, bucket, doc, component = (
            table.column(c).to_numpy() for c in ("outer", "own", "bucket", "doc_id", "component"))
        lists = table.column("shingles").combine_chunks()
        found = []
        for rows in np.split(np.arange(len(bucket)), np.flatnonzero(np.diff(bucket)) + 1):
            if kind == 2:
                left = right = rows
            else:
                left = rows[(outer[rows] == 1) & (own[rows] == i)]
                right = rows[outer[rows] == 0] if kind == 0 else rows[(own[rows] == j)]
            found.append(_cell_links(lists, left, right, component, percent))
        u, v = (np.concatenate(x) for x in zip(*found))
        return pa.table({"u": doc[u], "v": doc[v]})

    return placed.groupBy("part", "kind", "i", "j").applyInArrow(links, "u long, v long")


def _cell_links(lists: pa.ListArray, left: np.ndarray, right: np.ndarray, component: np.ndarray,
                percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (left, right) of different components that meet the similarity, one for two components."""
    none = np.empty(0, np.int64)
    if not len(left) or not len(right):
        return none, none
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy()
    n = np.diff(offsets)

    def side(rows):
        at = np.repeat(np.arange(len(rows)), n[rows])
        return at, np.concatenate([values[offsets[r]:offsets[r + 1]] for r in rows])

    (at_l, el), (at_r, er) = side(left), side(right)
    common = np.intersect1d(el, er)
    both = np.zeros((len(left), len(right)), np.float32)
    keep_l, keep_r = np.isin(el, common), np.isin(er, common)
    col_l, col_r = np.searchsorted(common, el[keep_l]), np.searchsorted(common, er[keep_r])
    at_l, at_r = at_l[keep_l], at_r[keep_r]
    width = 2048
    order_l, order_r = np.argsort(col_l, kind="stable"), np.argsort(col_r, kind="stable")
    col_l, at_l, col_r, at_r = col_l[order_l], at_l[order_l], col_r[order_r], at_r[order_r]
    for start in range(0, len(common), width):
        a0, a1 = np.searchsorted(col_l, (start, start + width))
        b0, b1 = np.searchsorted(col_r, (start, start + width))
        x = np.zeros((len(left), width), np.float32)
        y = np.zeros((len(right), width), np.float32)
        x[at_l[a0:a1], col_l[a0:a1] - start] = 1
        y[at_r[b0:b1], col_r[b0:b1] - start] = 1
        both += x @ y.T
    union = n[left][:, None] + n[right][None, :] - both
    cl, cr = component[left][:, None], component[right][None, :]
    hit_l, hit_r = np.nonzero((100 * both >= percent * union) & (cl != cr))
    if not len(hit_l):
        return none, none
    ends = np.sort(np.stack((component[left[hit_l]], component[right[hit_r]])), axis=0)
    _, first = np.unique(ends, axis=1, return_index=True)
    return left[hit_l[first]], right[hit_r[first]]


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Group documents whose shingle sets have a Jaccard similarity of ``percent`` % or more.

    ``docs`` needs doc_id (unique) and text; other columns are ignored.  Returns
    doc_id, n_shingles, component_id (smallest doc_id reachable over links) and
    kept (doc_id = component_id).  NULL, empty and word-less texts have 0
    shingles and link with nothing.  A NULL doc_id has no identity and gives no
    row; a repeated doc_id gives one row for each of its texts, and its texts
    share a component if linked.  An empty table gives an empty result.

    1. One scan writes each document's set size, set digest and band hashes.
    2. Equal sets fold to one representative, the smallest doc_id.
    3. In every bucket (equal band hash) members pair with the bucket's leader:
       at most one pair per member and band.  Pairs are verified on full sets.
    4. In buckets whose members are not yet one component, the members outside
       the leader's component meet all members of other components, block by
       block of bounded size, so no link is lost.
    5. Union-find, then star contraction, labels the components.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    sig = written(docs.mapInArrow(_signatures, "doc_id long, n long, d1 long, d2 long, bands array<long>"),
                  "signatures")
    some = sig.where("n > 0")
    classes = some.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"))
    classes = written(classes, "classes")
    # a class's bands: those of its representative (equal sets have equal bands)
    reps = some.join(classes.withColumnRenamed("rep", "doc_id").drop("size"), ["doc_id", "n", "d1", "d2"])
    banded = reps.select("doc_id", "n", F.explode("bands").alias("bucket"))
    led = (banded.groupBy("bucket").agg(F.min("doc_id").alias("leader"), F.count("*").alias("size"))
           .where("size > 1").drop("size"))
    # only rows of buckets with company go on; AQE splits a hot bucket's side of the join
    buckets = written(banded.join(led, "bucket"), "buckets")
    candidates = buckets.select("doc_id").distinct()
    texts = docs.join(candidates, "doc_id", "left_semi")
    sets = written(texts.mapInArrow(_sets, "doc_id long, shingles array<long>"), "sets")

    def alike(pairs: DataFrame) -> DataFrame:
        """The smaller set must hold ``percent`` % of the larger."""
        return (pairs.where(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent)
                .select("u", "v").distinct())

    sizes = buckets.where("doc_id = leader").select(F.col("bucket"), F.col("n").alias("nv"))
    first = (buckets.where("doc_id <> leader").join(sizes, "bucket")
             .select(F.col("doc_id").alias("u"), F.col("n").alias("nu"), F.col("leader").alias("v"), "nv"))
    links = written(_verified(alike(first), sets, percent), "links")
    found = written(components(links), "found")

    # buckets that still hold several components; in one of two members the leader has met the other
    def labelled(rows: DataFrame) -> DataFrame:
        for name, id_ in (("component", "doc_id"), ("leader_component", "leader")):
            rows = rows.join(found.select(F.col("node").alias(id_), F.col("component").alias(name)), id_, "left")
            rows = rows.withColumn(name, F.coalesce(name, id_))
        return rows

    def unresolved(rows: DataFrame) -> DataFrame:
        mixed = (rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                F.count("*").alias("size"))
                 .where("lo < hi and size > 2").select("bucket"))
        return rows.join(mixed, "bucket", "left_semi")

    mixed = written(unresolved(labelled(buckets)), "mixed")
    if not mixed.isEmpty():
        links = links.unionAll(written(_rest(mixed, sets, percent), "more"))
        found = written(components(links), "found")

    # back to all documents: class member -> representative -> component
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    return (sig.select("doc_id", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))
