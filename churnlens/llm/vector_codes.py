"""Product-quantised vector codes, exact in integers.

Every component x is the integer floor(256 * x).  Distances come from dot products, and those
from float64 matrix products of limbs: an integer v is ``high * 2**14 + low``, so each limb product summed
over a part stays below 2**53 and is exact; the limb products are put together in int64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.salted import salted_join
from churnlens.llm.store import written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LIMB_BITS = 14
SLICE_ROWS = 2048
DIGIT = 48  # sums leave a task as signed top and unsigned lower digits of this many bits
DIGITS = 4  # 192 bits hold any sum of float32 components
LONG_MAX = 2 ** 63 - 1


def wide(part_size: int) -> int:
    """The magnitude from which limbs, products or distances might not fit: such rows take Python integers.

    Below it a value has two limbs, and 4 * part_size * v * v stays below 2**63.
    """
    bound = 1 << (2 * LIMB_BITS - 1)
    while 4 * max(part_size, 1) * bound * bound >= 2 ** 63:
        bound >>= 1
    return bound


def limb_dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of integer parts: x (rows, parts, size), c (parts, entries, size) -> (parts, rows, entries).

    All magnitudes must be below ``wide(size)``.
    """
    mask = (1 << LIMB_BITS) - 1
    x = np.ascontiguousarray(x.transpose(1, 0, 2))
    c = np.ascontiguousarray(c.transpose(0, 2, 1))
    x_high, x_low = (x >> LIMB_BITS).astype(np.float64), (x & mask).astype(np.float64)
    c_high, c_low = (c >> LIMB_BITS).astype(np.float64), (c & mask).astype(np.float64)
    high = (x_high @ c_high).astype(np.int64)
    middle = (x_high @ c_low).astype(np.int64) + (x_low @ c_high).astype(np.int64)
    low = (x_low @ c_low).astype(np.int64)
    return (high << (2 * LIMB_BITS)) + (middle << LIMB_BITS) + low


@dataclass
class Codebooks:
    """entries: integers (parts, entries, part size), as int64 where they are narrow, else Python integers."""

    entries: np.ndarray

    @classmethod
    def of(cls, entries: list) -> Codebooks:
        exact = np.array(entries, dtype=object)
        narrow = exact.size == 0 or max(abs(v) for v in exact.ravel()) < wide(exact.shape[2])
        return cls(exact.astype(np.int64) if narrow else exact)

    def digest(self) -> str:
        """SHA-256 of all integers in decimal by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        """Nearest entry of every part (ties to the lower index), and each row's summed squared distance."""
        c = self.entries
        if c.dtype == object or x.dtype == object:
            c, x = c.astype(object), x.astype(object)
            code = np.zeros(x.shape[:2], np.int64)
            error = []
            for row, parts in enumerate(x):
                d = ((parts[:, None, :] - c) ** 2).sum(axis=2)
                code[row] = [min(range(d.shape[1]), key=lambda e, p=p: (d[p, e], e)) for p in range(d.shape[0])]
                error.append(sum(int(d[p, e]) for p, e in enumerate(code[row])))
            return code, error
        away = (c * c).sum(axis=2)[:, None, :] - 2 * limb_dots(x, c)
        code = away.argmin(axis=2)
        nearest = np.take_along_axis(away, code[:, :, None], axis=2)[:, :, 0]
        # parts may add up beyond a long: they are summed as Python integers only where they might
        own = (x * x).sum(axis=2).T + nearest
        total = (own.sum(axis=0).tolist() if float(own.max(initial=0)) * len(own) < LONG_MAX
                 else [sum(map(int, column)) for column in own.T])
        return code.T, total


def integers(column: pa.Array, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer parts (rows, PARTS, size)) of float vectors; shorter ones are filled with zeros.

    Narrow rows come as int64, the others as Python integers.
    """
    lengths = pc.list_value_length(column).to_numpy().astype(np.int64)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    at = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    x = np.zeros((len(lengths), dim))
    x[at, place] = np.floor(flat * SCALE)
    narrow = (np.abs(x) < wide(dim // PARTS)).all(axis=1)
    for rows, kind in ((np.flatnonzero(narrow), np.int64), (np.flatnonzero(~narrow), object)):
        if len(rows):
            values = x[rows].astype(np.int64) if kind is np.int64 else np.array(
                [[int(v) for v in row] for row in x[rows]], dtype=object)
            yield rows, values.reshape(len(rows), PARTS, dim // PARTS)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding, label without NULL vectors and vectors with NULL or non-finite components."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return (embeddings.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), "label")
            .where(F.col("embedding").isNotNull() & ~F.exists("embedding", bad)))


def start(vectors: DataFrame, dim: int) -> Codebooks:
    """The codebooks' first entries: the parts of the vectors with the ENTRIES smallest vec_ids
    (a repeated vec_id: by its vectors' order; no NULL vec_id)."""
    first = (vectors.where("vec_id is not null").orderBy("vec_id", "embedding").limit(ENTRIES)
             .select("embedding").collect())
    entries = np.zeros((PARTS, len(first), dim // PARTS), dtype=object)
    for e, row in enumerate(first):
        exact = [int(np.floor(np.float64(v) * SCALE)) for v in row.embedding]
        exact += [0] * (dim - len(exact))
        entries[:, e, :] = np.array(exact, dtype=object).reshape(PARTS, -1)
    return Codebooks.of(entries.tolist())


def _sums(books: Codebooks, dim: int):
    """One row per entry that a task's vectors use, and its components' sums as digits."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("n", pa.int64()),
                        *[(f"d{i}", pa.int64()) for i in range(DIGITS)]])
    size, n_entries = dim // PARTS, books.entries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((PARTS, n_entries), np.int64)
        total = np.zeros((PARTS, n_entries, size), dtype=object)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                for _, x in integers(batch.column("embedding").slice(begin, SLICE_ROWS), dim):
                    code, _ = books.assign(x)
                    for part in range(PARTS):
                        used, at = np.unique(code[:, part], return_inverse=True)
                        sums = np.zeros((len(used), size), dtype=x.dtype)
                        np.add.at(sums, at, x[:, part, :])   # at most 2,048 narrow values: far below a long
                        count[part, used] += np.bincount(at, minlength=len(used))
                        total[part, used] += sums.astype(object)
        part, entry = np.nonzero(count)
        rows = [(p, e, k, int(count[p, e]), int(total[p, e, k]))
                for p, e in zip(part.tolist(), entry.tolist()) for k in range(size)]
        columns = [list(c) for c in zip(*rows)] if rows else [[], [], [], [], []]
        mask = (1 << DIGIT) - 1
        digits = [[(v >> (DIGIT * i)) & mask if i < DIGITS - 1 else v >> (DIGIT * i) for v in columns[4]]
                  for i in range(DIGITS)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns[:4] + digits, schema)],
                                         schema=schema)

    return run


def refined(vectors: DataFrame, books: Codebooks, dim: int) -> Codebooks:
    """Every used entry moves to the componentwise floor of its parts' mean; unused entries stay.

    Tasks add up their own vectors; what reaches the driver has the codebooks' size.
    """
    digits = ", ".join(f"d{i} long" for i in range(DIGITS))
    sums = (vectors.select("embedding")
            .mapInArrow(_sums(books, dim), f"part int, entry int, place int, n long, {digits}")
            .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), *[F.sum(f"d{i}").alias(f"d{i}")
                                                                            for i in range(DIGITS)]))
    entries = books.entries.astype(object)
    for row in sums.collect():
        total = sum(row[f"d{i}"] << (DIGIT * i) for i in range(DIGITS))
        entries[row.part, row.entry, row.place] = total // row.n
    return Codebooks.of(entries.tolist())


def codes(vectors: DataFrame, books: Codebooks, dim: int) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error (NULL where it does not fit a long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(begin, SLICE_ROWS)
                for rows, x in integers(part.column("embedding"), dim):
                    code, error = books.assign(x)
                    at = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id").take(at), part.column("label").take(at),
                         pa.array([bytes(r).hex() for r in code.astype(np.uint8)], pa.string()),
                         pa.array([e if e <= LONG_MAX else None for e in error], pa.int64())],
                        ["vec_id", "label", "code", "error"])

    kinds = dict(vectors.dtypes)
    return vectors.select("vec_id", "embedding", "label").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(embeddings: DataFrame) -> DataFrame:
    """Codes of every usable vector: vec_id, code, error, label_error, codebooks_sha256.

    ``embeddings`` needs vec_id, embedding and label; other columns are ignored.  Rows whose
    vector is NULL or holds a NULL or non-finite component are dropped.  Each position of the 16 equal
    consecutive parts has its own codebook of at most 64 entries (fewer vectors: fewer
    entries), refined twice over all vectors.  Vectors shorter than the longest, and lengths that
    16 does not divide, count as filled with zeros.  Repeated rows are kept and coded alike.  A vector
    without vec_id is coded but starts no entry; where no vector has a vec_id, code and error are NULL.  An
    empty table gives an empty result.  An error beyond a long is NULL, and label_error leaves
    it out; a label_error beyond a long is NULL.

    The driver holds the codebooks only; the vectors are read once a round and never stored
    again.  Label sums are added up before the shuffle and join back over salted labels.
    """
    vectors = usable(embeddings)
    longest = vectors.agg(F.max(F.size("embedding"))).head()[0] or 0
    dim = max(-(-longest // PARTS), 1) * PARTS
    books = start(vectors, dim)
    if books.entries.shape[1] == 0:
        nothing = vectors.select("vec_id", F.lit(None).cast("string").alias("code"))
        for name, kind in (("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string")):
            nothing = nothing.withColumn(name, F.lit(None).cast(kind))
        return nothing
    for _ in range(ROUNDS):
        books = refined(vectors, books, dim)
    coded = written(codes(vectors, books, dim), "codes")
    by_label = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    return salted_join(coded, by_label, ["label"], ["code"]).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
