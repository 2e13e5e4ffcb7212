"""Standardised features (M3) and class balance by synthetic minority rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .knn import nearest_neighbours
from .ordering import prefix_sums

NEIGHBOURS = 5
DIGITS = 6         # features, means and deviations are rounded to so many places first
GRID = 10_000      # steps of the integer grid per standard deviation
MADE = 50_000      # synthetic rows that a task makes, about
SPREAD = 10007     # the place between a row and its neighbour is a multiple of 1 / SPREAD


def rounded(f: str) -> Column:
    """The feature to DIGITS places, missing values as 0; whole numbers, which most features are, skip the decimal
    arithmetic of ``round`` and are the same without it."""
    x = F.coalesce(F.col(f).cast("double"), F.lit(0.0))
    return F.when(F.rint(x) == x, x).otherwise(F.round(x, DIGITS))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's one row: its number of rows, and every feature's mean and sum of squared deviations."""
    n, mean, m2 = 0, 0.0, 0.0
    for batch in batches:
        if batch.num_rows:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            mid = x.mean(0)
            n, mean, m2 = merged_moments((n, mean, m2), (len(x), mid, ((x - mid) ** 2).sum(0)))
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean]), pa.array([m2])], ["n", "mean", "m2"])


def merged_moments(a: tuple, b: tuple) -> tuple:
    """(rows, mean, sum of squared deviations) of two sets of rows together."""
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + gap * gap * (a[0] * b[0] / n)


def _digits(value: float) -> float:
    """To DIGITS places, halves away from zero, as SQL rounds."""
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-DIGITS), ROUND_HALF_UP)) if np.isfinite(value) else value


def scaling(train: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """feature -> (mean, population standard deviation) of the training rows, in one pass that returns one row a task;
    missing values count as 0, a constant feature has deviation 1."""
    # the higher-order function keeps the array out of one generated method too long to be compiled
    x = F.transform(F.array(*[rounded(f) for f in features]), lambda v: v + F.lit(0.0))
    parts = train.select(x.alias("x")).mapInArrow(_moments, "n long, mean array<double>, m2 array<double>").collect()
    total = (0, np.zeros(len(features)), np.zeros(len(features)))
    for r in parts:
        total = merged_moments(total, (r["n"], np.array(r["mean"]), np.array(r["m2"])))
    n, mean, m2 = total
    std = np.sqrt(m2 / max(n, 1))
    return {f: (_digits(float(mean[i])) or 0.0, _digits(float(std[i])) or 1.0) for i, f in enumerate(features)}


def on_grid(df: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    """Adds ``z``: the standardised features as integers, GRID steps a standard deviation."""
    def step(f: str, mean: float, std: float):
        return (rounded(f) - F.lit(mean)) / F.lit(std) * GRID + 0.5
    # as in ``scaling``, the higher-order function splits what would be one method too long to be compiled
    return df.withColumn("z", F.transform(F.array(*[step(f, m, s) for f, (m, s) in scale.items()]), lambda v: F.floor(v)))


def nearest(minority: DataFrame, keys: Sequence[str], k: int = NEIGHBOURS) -> DataFrame:
    """keys and near, the array of each row's k nearest others on the grid ``z``."""
    return nearest_neighbours(minority, keys, "z", k)


def ranked(near: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per row and neighbour: keys, neighbour (1 is the nearest), near_<key>..., distance."""
    return near.select(*keys, F.posexplode("near").alias("neighbour", "_n")).select(
        *keys, (F.col("neighbour") + 1).alias("neighbour"), *[F.col(f"_n.near_{c}") for c in keys], "_n.distance")


def smaller_class(rows: DataFrame, label: str) -> tuple[int, int, int]:
    """(label, rows, missing rows) of the smaller of the classes 0 and 1; the churners on a tie."""
    n = rows.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    return (1, n.pos, n.neg - n.pos) if n.pos <= n.neg else (0, n.neg, n.pos - n.neg)


def balanced(rows: DataFrame, near: DataFrame, features: Sequence[str], keys: Sequence[str], label: str) -> DataFrame:
    """The rows of ``on_grid`` and synthetic ones until both classes are equally large.

    ``near`` holds the smaller class's neighbours (``nearest``).  Columns: ``keys`` (a synthetic row has its
    seed's), copy (0: a given row), label, and the features in standard deviations.  The missing rows
    are dealt evenly over the smaller class in key order; the i-th copy of seed number p lies on the
    way to one of its neighbours, both chosen by arithmetic in p and i.  A class of one row has no
    neighbour and is repeated; with no row or no gap nothing is added.  Labels are 0 and 1.
    """
    rows = rows.select(*keys, F.col(label).cast("int").alias(label), "z")
    small, size, gap = smaller_class(rows, label)
    as_columns = [(F.get("z", F.lit(i)) / GRID).alias(f) for i, f in enumerate(features)]
    kept = rows.select(*keys, F.lit(0).cast("long").alias("copy"), label, *as_columns)
    if size == 0 or gap == 0:
        return kept
    seeds = prefix_sums(rows.where(F.col(label) == small), list(keys), {}, "_p")
    copies = F.lit(gap // size) + F.when(F.col("_p") <= gap % size, 1).otherwise(0)
    slot = F.pmod(F.col("_p") * 31 + F.col("copy") * 17, F.size("_near"))
    made = (seeds.join(near.select(*keys, F.col("near.near_z").alias("_near")), list(keys), "left")
            .withColumn("_c", copies.cast("long")).where("_c > 0")
            # tasks by the rows they make: the seeds alone are few and would share one
            .repartition(-(-gap // MADE), "_p")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_c"))))
            .withColumn("_to", F.when(F.size("_near") > 0, F.get("_near", slot.cast("int"))))
            .withColumn("_u", F.pmod(F.col("_p") * 7919 + F.col("copy") * 4729, F.lit(SPREAD)) / F.lit(SPREAD)))
    # the way as one array: a column each would be one method too long to be compiled
    way = F.zip_with("z", F.coalesce("_to", "z"), lambda a, b: (a + F.col("_u") * (b - a)) / GRID)
    made = made.select(*keys, "copy", label, way.alias("_way"))
    between = [F.get("_way", F.lit(i)).alias(f) for i, f in enumerate(features)]
    return kept.unionByName(made.select(*keys, "copy", label, *between))
