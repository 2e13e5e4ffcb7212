"""Global-order operators without a single-task window.

A window with ``orderBy`` and no ``partitionBy`` runs in one task.  Running
totals over a whole table (Lorenz curve, PR/ROC curves, exact ranks) and exact
quantiles are built here the distributed way instead:

1. A hash-binned sample of the order keys, combined inside the map tasks, gives
   evenly spaced cuts: one small array, whatever the size of the table.
2. Every row finds its slice by a binary search in that array.  The slice is a
   function of the row alone, so each pass over the table cuts it alike.
3. Running totals: per-slice sums (combined before their shuffle) become offsets,
   and one exchange by slice with a window inside each slice does the rest.
4. Quantiles: a sketch brackets every wanted rank, counts tell which slice between
   the brackets' edges holds it, and only the values of those slices are shuffled
   and ranked exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .joins import has_at_most

SLICES_PER_PARTITION = 4      # slices meet in a task by hash, so several small ones even out
SAMPLE_PER_SLICE = 16
SKETCH_ACCURACY = 20_000      # a quantile's bracket holds about four parts in this many
BRACKET = 2.0 / SKETCH_ACCURACY
GROUP_BROADCAST_LIMIT = 100_000


def _slices(df: DataFrame, partitions: int | None) -> int:
    return SLICES_PER_PARTITION * (partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _cuts(rows: DataFrame, groups: Sequence[str], key: Column, n: int) -> DataFrame:
    """At most ``n - 1`` ascending ``_cuts`` of ``key`` per group, from one row per hash bin.

    Rows hash by all columns of ``rows``; a task sends at most one row per group and bin.
    """
    h = F.xxhash64(*rows.columns)
    sample = (rows.groupBy(*groups, F.pmod(h, F.lit(n * SAMPLE_PER_SLICE)).alias("_bin"))
              .agg(F.min_by(key, h).alias("_key")))
    held = sample.groupBy(*groups).agg(F.sort_array(F.collect_list("_key")).alias("_held"))
    evenly = F.transform(F.sequence(F.lit(1), F.lit(max(n - 1, 1))), lambda i: F.get(
        "_held", F.floor(i * F.size("_held") / n).cast("int")))
    return held.select(*groups, F.array_distinct(evenly).alias("_cuts"))


def _slice_of(key: Column, n: int) -> Column:
    """Number of ``_cuts`` at or below ``key``: a binary search from the largest power of two down."""
    steps = F.array(*[F.lit(2 ** b) for b in reversed(range(n.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        F.get("_cuts", low + step - 1) <= key, low + step).otherwise(low))


def descending(score: str) -> Column:
    """Ascending order key that puts the highest ``score`` first (NaN counts as the highest)."""
    return -F.nanvl(score, F.lit(float("inf")))


def prefix_sums(df: DataFrame, order_by: Sequence[Column | str], sums: dict[str, Column],
                pos_col: str = "pos", partitions: int | None = None) -> DataFrame:
    """Add the 1-based global position ``pos_col`` and inclusive running sums.

    ``order_by`` holds ascending keys and must be a total order (include a unique key) for
    positions to be deterministic.  Each entry of ``sums`` becomes a column of that name.
    ``df`` is read three times (cuts, slice totals, rows) but shuffled once.
    """
    n = _slices(df, partitions)
    keys = {f"_k{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order_by)}
    values = {f"_v_{k}": c for k, c in sums.items()}
    base = df.withColumns({**keys, **values})
    cuts = _cuts(base.select(*keys, *values), [], F.struct(*keys), n)
    # one row of cuts, bounded by the slice count
    sliced = (base.withColumn("_one", F.lit(1)).join(F.broadcast(cuts.withColumn("_one", F.lit(1))), "_one")
              .withColumn("_slice", _slice_of(F.struct(*keys), n)).drop("_cuts", "_one"))
    totals = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(v) for v in values])
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)   # one row per slice
    offsets = totals.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o_pos"), *[
        F.coalesce(F.sum(f"_v_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
    inside = Window.partitionBy("_slice").orderBy(*keys)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumns({"_l_pos": F.row_number().over(inside),
                                **{f"_l_{k}": F.sum(f"_v_{k}").over(running) for k in sums}})
    out = local.join(F.broadcast(offsets), "_slice")
    return out.select(*df.columns, (F.col("_l_pos") + F.col("_o_pos")).alias(pos_col),
                      *[(F.col(f"_l_{k}") + F.col(f"_o_{k}")).alias(k) for k in sums])


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float],
                    group_cols: Sequence[str] = (), few_groups: bool | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/pandas 'linear').

    A sketch's brackets and the counts of the slices between their edges narrow every wanted rank down
    to one slice of its group; only the values of those slices are shuffled, as distinct values with
    counts.  The result is exact however good the sketch is.  Returns one row
    per group with a column per entry of ``probs`` and the group size ``n``.
    NULL and NaN are no values; a group without values gives no row.  ``few_groups`` says whether
    the groups are few enough to broadcast a row of each; None checks it by a bounded job.
    """
    groups, dropped = list(group_cols), []
    if not groups:  # a single group: its one row of cuts joins on a constant key
        df, groups, dropped = df.withColumn("_all", F.lit(1)), ["_all"], ["_all"]
    real = F.col(value).isNotNull()
    if isinstance(df.schema[value].dataType, (DoubleType, FloatType)):
        real = real & ~F.isnan(value)
    rows = df.where(real).select(*groups, value)
    # bracket every wanted rank between two values of a sketch; the counts below decide, not the sketch
    edges = [e for q in sorted(set(probs.values())) for e in (max(q - BRACKET, 0.0), min(q + BRACKET, 1.0))]
    cuts = rows.groupBy(*groups).agg(F.percentile_approx(
        F.col(value).cast("double"), edges, SKETCH_ACCURACY).alias("_cuts"))
    # one short row per group: broadcast when the groups are few, so a group holding most of the values
    # never funnels through one join task
    if few_groups is None:
        few_groups = bool(dropped) or has_at_most(rows.select(*groups).distinct(), GROUP_BROADCAST_LIMIT)
    small = F.broadcast if few_groups else (lambda side: side)
    v = F.col(value).cast("double")
    # both edges of a bracket belong to it, so a value that repeats often has a slice of its own
    passed = [F.get("_cuts", F.lit(i)) <= v if i % 2 == 0 else F.get("_cuts", F.lit(i)) < v for i in range(len(edges))]
    sliced = rows.join(small(cuts.select(*groups, F.sort_array("_cuts").alias("_cuts"))), groups).select(
        *groups, value, reduce(add, [p.cast("int") for p in passed]).alias("_slice"))
    counts = sliced.groupBy(*groups, "_slice").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.select(*groups, "_slice", "_c", F.sum("_c").over(upto).alias("_end"),
                         F.sum("_c").over(whole).alias("n"))
    rank = {name: (F.col("n") - 1) * F.lit(q) + 1 for name, q in probs.items()}
    ranks = F.array(*[r for h in rank.values() for r in (F.floor(h), F.ceil(h))])
    start = F.col("_end") - F.col("_c")
    wanted = (ends.withColumn("_start", start)
              .where(F.exists(ranks, lambda r: (r > F.col("_start")) & (r <= F.col("_end"))))
              .select(*groups, "_slice", "_start", "n"))   # at most two slices per quantile and group
    near = (sliced.join(small(wanted), [*groups, "_slice"])
            .groupBy(*groups, "_slice", "_start", "n", value).agg(F.count(F.lit(1)).alias("_c")))
    w = (Window.partitionBy(*groups, "_slice").orderBy(value)
         .rowsBetween(Window.unboundedPreceding, 0))
    near = near.withColumn("_upto", F.col("_start") + F.sum("_c").over(w))
    aggs = [F.first("n").alias("n")]
    for name, h in rank.items():
        lo, hi = F.floor(h), F.ceil(h)
        held = [(F.col("_upto") - F.col("_c") < r) & (r <= F.col("_upto")) for r in (lo, hi)]
        aggs += [F.max(F.when(held[0], F.col(value))).alias(f"_lo_{name}"),
                 F.max(F.when(held[1], F.col(value))).alias(f"_hi_{name}"),
                 F.first(h - lo).alias(f"_fr_{name}")]
    res = near.groupBy(*groups).agg(*aggs)
    cols = [*groups, "n"]
    for name in probs:
        lo_v, hi_v, fr = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_fr_{name}")
        cols.append((lo_v + fr * (hi_v - lo_v)).alias(name))
    return res.select(*cols).drop(*dropped)


def exact_median(df: DataFrame, value: str) -> float | None:
    """Scalar exact median (even count -> mean of the middle two)."""
    row = exact_quantiles(df, value, {"median": 0.5}).first()
    return None if row is None else row["median"]
