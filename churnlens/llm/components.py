"""Connected components of a large edge table (alternating large-star and small-star)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.store import written

EDGE = "u long, v long"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find within one Arrow batch: every node keeps one edge to its batch root.

    The roots are the smallest ids, so the output is never longer than the input.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        u, v = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 1))
        nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
        parent = list(range(len(nodes)))
        half = len(u)
        for a, b in zip(at[:half].tolist(), at[half:].tolist()):
            while parent[a] != a:
                parent[a] = parent[parent[a]]
                a = parent[a]
            while parent[b] != b:
                parent[b] = parent[parent[b]]
                b = parent[b]
            if a < b:
                parent[b] = a
            elif b < a:
                parent[a] = b
        root = np.asarray(parent)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        inner = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[inner]), pa.array(nodes[root[inner]])], ["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation.  ``edges`` holds (u, v) with u > v.

    Large star: each node's larger neighbours move to the smallest id around it.
    Small star: each node and its smaller neighbours move to the smallest of them.
    The minimum is a map-side aggregate and comes back by a join, so no
    neighbour list is ever gathered.
    """
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        near = edges.join(low, "u")
        moved = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(u, v) edges -> (node, component): the smallest id reachable from each node.

    Nodes without an edge do not appear; self-loops and repeated edges are
    ignored; NULL ends are dropped.  Each round is written to the shared
    folder.  The loop ends when a round leaves the edge set as it was, after
    about log(n) rounds; only two numbers a round reach the driver.
    """
    now = (edges.where("u is not null and v is not null and u <> v")
           .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
           .mapInArrow(_forest, EDGE))
    now = written(now, tag)
    digest = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = now.agg(digest).head()[0]
    while before[0]:
        now = written(_star(_star(now, large=True), large=False), tag)
        after = now.agg(digest).head()[0]
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
