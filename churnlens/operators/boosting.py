"""Second-order boosted trees on binned features (M7).

Each tree level is one aggregate: gradients and hessians of all rows, added up in every task into one small table
per (node, feature, bin), and the tables by Spark.  Split gains and leaf weights are the regularised second-order ones, w = -G / (H + lambda).  Gradients and
hessians are integers in millionths, so their sums do not depend on the order of addition, and a fit is
repeatable on any layout.  The driver receives one row per node and level.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BINS = 16
BIN_WIDTH = 5000        # grid steps of a bin: half a standard deviation; the outer bins are open
UNIT = 1_000_000        # gradients and hessians are integers in millionths
WEIGHT_DIGITS = 9       # leaf weights are rounded to so many places
LAMBDA, GAMMA, MIN_CHILD = 1.0, 0.0, 1.0   # regularisation, least gain, least hessian sum of a child
REFRESH = 8             # trees after which the margins are written, so that plans stay small


def binned(z: str = "z") -> Column:
    """Bin numbers 0 .. BINS - 1 of the integer grid ``z``."""
    return F.transform(z, lambda v: F.least(F.greatest(F.floor(v / BIN_WIDTH) + BINS // 2, F.lit(0)),
                                            F.lit(BINS - 1)).cast("int"))


@dataclass
class Split:
    """A node's split ``bin of feature <= bin``; sums of gradients and hessians left and in all."""

    feature: int
    bin: int
    gain: float
    left: tuple[int, int]
    total: tuple[int, int]


@dataclass
class Tree:
    """Nodes in heap order: the children of n are 2n + 1 and 2n + 2."""

    splits: dict[int, Split] = field(default_factory=dict)
    weights: dict[int, float] = field(default_factory=dict)   # of the leaves

    def _walk(self, bins: str, at, node: int = 0) -> Column:
        if node not in self.splits:
            return at(node)
        s = self.splits[node]
        return F.when(F.get(bins, F.lit(s.feature)) <= s.bin, self._walk(bins, at, 2 * node + 1)).otherwise(
            self._walk(bins, at, 2 * node + 2))

    def node(self, bins: str = "bins") -> Column:
        return self._walk(bins, lambda n: F.lit(n))

    def margin(self, bins: str = "bins") -> Column:
        return self._walk(bins, lambda n: F.lit(self.weights[n]))


def leaf_weight(g: int, h: int, eta: float) -> float:
    """-eta * G / (H + lambda) of sums in millionths, rounded half up."""
    w = -eta * (g / UNIT) / (h / UNIT + LAMBDA)
    return int(abs(w) * 10 ** WEIGHT_DIGITS + 0.5) * (1 if w >= 0 else -1) / 10 ** WEIGHT_DIGITS


def gain_sql(gl: str, hl: str, g: str, h: str) -> str:
    """Half the gain in score of a split into (gl, hl) and the rest of (g, h), less gamma."""
    score = lambda a, b: f"(({a}) / {UNIT}D * (({a}) / {UNIT}D) / (({b}) / {UNIT}D + {LAMBDA}D))"
    return (f"(({score(gl, hl)} + {score(f'{g} - {gl}', f'{h} - {hl}')} - {score(g, h)}) * 0.5D - {GAMMA}D)")


def gradients(rows: DataFrame) -> DataFrame:
    """Adds g and h of the weighted logistic loss at ``margin``, in millionths."""
    p = 1.0 / (1.0 + F.exp(-F.col("margin")))
    step = lambda c: F.floor(c * UNIT + 0.5)
    return (rows.withColumn("p", p).withColumn("g", step(F.col("weight") * (F.col("p") - F.col("y"))))
            .withColumn("h", step(F.col("weight") * F.col("p") * (1.0 - F.col("p")))).drop("p"))


def _added(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of integers by cell: in float64 while it holds them all, else in int64."""
    if float(np.abs(values).max(initial=0)) * len(values) < 2 ** 53:
        return np.bincount(at, values, size).astype(np.int64)
    out = np.zeros(size, np.int64)
    np.add.at(out, at, values)
    return out


def _task_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node, feature and bin that occurs among a task's rows, with the sums of g and h."""
    held: dict[int, np.ndarray] = {}    # node -> rows, g and h by feature and bin
    for batch in batches:
        if not batch.num_rows:
            continue
        bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        wide, features = int(bins.max(initial=0)) + 1, bins.shape[1]
        nodes, place = np.unique(batch.column("node").to_numpy(), return_inverse=True)
        at = ((place[:, None] * features + np.arange(features)) * wide + bins).ravel()
        size = len(nodes) * features * wide
        sums = [np.bincount(at, minlength=size)] + [
            _added(at, np.repeat(batch.column(c).to_numpy(), features), size) for c in ("g", "h")]
        for node, new in zip(nodes.tolist(), np.stack(sums, -1).reshape(len(nodes), features, wide, 3)):
            old = held.get(node)
            if old is not None and old.shape[1] < wide:
                old = np.pad(old, ((0, 0), (0, wide - old.shape[1]), (0, 0)))
            if old is None:
                held[node] = new
            else:
                old[:, :wide] += new
                held[node] = old
    for node, table in held.items():
        feature, bin_ = np.nonzero(table[:, :, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(feature), node), pa.int32()), pa.array(feature, pa.int32()), pa.array(bin_, pa.int32()),
             pa.array(table[feature, bin_, 1]), pa.array(table[feature, bin_, 2])], ["node", "feature", "bin", "g", "h"])


def best_splits(rows: DataFrame) -> list:
    """The best split of every ``node`` of ``rows`` (node, bins, g, h): at most one row a node; equal gains go to the
    lower feature, then the lower bin.  All ``bins`` are equally long and hold no NULL."""
    whole = rows.where(F.col("bins").isNotNull()).select("node", "bins", *[
        F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("g", "h")])
    sums = (whole.mapInArrow(_task_sums, "node int, feature int, bin int, g long, h long")
            .groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")))
    feature = Window.partitionBy("node", "feature")
    upto = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    scored = (sums.withColumn("gl", F.sum("g").over(upto)).withColumn("hl", F.sum("h").over(upto))
              .withColumn("gt", F.sum("g").over(feature)).withColumn("ht", F.sum("h").over(feature))
              .withColumn("gain", F.expr(gain_sql("gl", "hl", "gt", "ht")))
              .where(f"hl >= {MIN_CHILD * UNIT} and ht - hl >= {MIN_CHILD * UNIT} and gain > 0"))
    best = F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl", "gt", "ht"))
    return scored.groupBy("node").agg(best.alias("s")).select("node", "s.*").collect()


def grow(rows: DataFrame, depth: int, eta: float) -> Tree:
    """One tree on ``rows`` (bins, g, h)."""
    tree, level = Tree(), [0]
    sums: dict[int, tuple[int, int]] = {}
    for _ in range(depth):
        if not level:
            break
        deeper = []
        for r in best_splits(rows.withColumn("node", tree.node()).where(F.col("node").isin(level))):
            tree.splits[r.node] = Split(-r.f, -r.b, r.gain, (r.gl, r.hl), (r.gt, r.ht))
            sums[2 * r.node + 1], sums[2 * r.node + 2] = (r.gl, r.hl), (r.gt - r.gl, r.ht - r.hl)
            deeper += [2 * r.node + 1, 2 * r.node + 2]
        level = deeper
    if not tree.splits:
        total = rows.agg(F.sum("g").alias("g"), F.sum("h").alias("h")).first()
        sums[0] = (total.g or 0, total.h or 0)
    tree.weights = {n: leaf_weight(*gh, eta) for n, gh in sums.items() if n not in tree.splits}
    return tree


def fit(train: DataFrame, rounds: int, depth: int, eta: float) -> list[Tree]:
    """``rounds`` trees on ``train``: bins (array), y (0 or 1) and weight, an integer; other columns are ignored.
    Margins start at 0, and every tree is grown on the gradients that its predecessors leave."""
    spark = train.sparkSession
    folder = os.path.join(ensure_checkpoint_dir(spark), f"boost-{uuid.uuid4().hex}")

    def stored(df: DataFrame, tag: str) -> DataFrame:
        df.write.parquet(os.path.join(folder, tag))
        return spark.read.schema(df.schema).parquet(os.path.join(folder, tag))

    rows = stored(train.select("bins", "y", "weight", F.lit(0.0).alias("margin")), "start")
    trees: list[Tree] = []
    for r in range(rounds):
        trees.append(grow(gradients(rows), depth, eta))
        rows = rows.withColumn("margin", F.col("margin") + trees[-1].margin())
        if r % REFRESH == REFRESH - 1 and r + 1 < rounds:
            rows = stored(rows, f"round-{r}")
    return trees


def scored(rows: DataFrame, trees: Sequence[Tree], out: str) -> DataFrame:
    """Adds margin and the probability ``out`` to rows with ``bins``."""
    margin = F.lit(0.0)
    for tree in trees:
        margin = margin + tree.margin()
    return rows.withColumn("margin", margin).withColumn(out, 1.0 / (1.0 + F.exp(-F.col("margin"))))


def gains(trees: Sequence[Tree], features: Sequence[str]) -> dict[str, float]:
    """Total gain of every feature's splits."""
    total = {f: 0.0 for f in features}
    for tree in trees:
        for s in tree.splits.values():
            total[features[s.feature]] += s.gain
    return total
