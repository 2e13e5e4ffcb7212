"""Portfolio profiling.

Everything is an aggregate or a distributed running total; nothing is pulled
to the driver.  The figures of the reference are replaced by the numbers
behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from .joins import has_at_most
from .ordering import GROUP_BROADCAST_LIMIT, exact_quantiles, prefix_sums

SEGMENTS = ["industry", "client_size", "contract_type", "region"]
# Names and order of the reference's columns
BOX_METRICS = ["sla_breaches_last_90_days", "avg_ticket_satisfaction", "product_usage_score",
               "payment_delay_days_avg"]
# Names and order of the reference's columns
CORR_COLUMNS = [
    "is_churned_numeric", "monthly_recurring_revenue", "tenure_months",
    "support_tickets_last_90_days", "avg_ticket_satisfaction", "sla_breaches_last_90_days",
    "payment_delay_days_avg", "product_usage_score", "nps_score", "contract_type_num",
    "size_num",
]


def _one_row(df: DataFrame, *aggs) -> DataFrame:
    """A one-row aggregate with a constant key, to be joined back (broadcast:
    exactly one row)."""
    return F.broadcast(df.agg(*aggs).withColumn("_one", F.lit(1)))


def segment_churn_rate(clients: DataFrame, segments: Sequence[str] = SEGMENTS) -> DataFrame:
    """A3: churn rate (%) for each value of each segment column, in one pass.

    The rows are fanned out once per segment column (a fixed factor) and one
    grouped aggregate with map-side combine does all four breakdowns."""
    fan = F.explode(F.array(*[
        F.struct(F.lit(s).alias("segment"), F.col(s).cast("string").alias("segment_value"))
        for s in segments]))
    return (clients.select(fan.alias("s"), F.col("is_churned").cast("int").alias("_y"))
            .groupBy("s.segment", "s.segment_value")
            .agg((F.avg("_y") * 100).alias("churn_rate"), F.count(F.lit(1)).alias("clients")))


def tenure_churn(clients: DataFrame) -> DataFrame:
    """A6 + F9: churn rate per right-closed tenure bin; empty bins kept (NULL rate)."""
    spark = clients.sparkSession
    bins = F.broadcast(spark.createDataFrame(
        [(lab, i) for i, lab in enumerate(X.TENURE_LABELS)], "tenure_bin string, bin_order int"))
    agg = (clients.select(X.tenure_bin("tenure_months").alias("tenure_bin"),
                          F.col("is_churned").cast("int").alias("_y"))
           .where(F.col("tenure_bin").isNotNull())
           .groupBy("tenure_bin")
           .agg((F.avg("_y") * 100).alias("churn_rate"), F.count(F.lit(1)).alias("clients")))
    return (bins.join(agg, "tenure_bin", "left")
            .select("tenure_bin", "bin_order", "churn_rate",
                    F.coalesce("clients", F.lit(0)).alias("clients")))


def monthly_revenue_by_status(panel: DataFrame, value: str = "invoiced_amt") -> DataFrame:
    """A4 + A5 as one rollup: per month, total and split by churn status."""
    r = (panel.rollup("year_month", "is_churned")
         .agg(F.sum(value).alias("revenue"), F.grouping_id().alias("_g")))
    return (r.where(F.col("year_month").isNotNull())
            .select("year_month",
                    F.when(F.col("_g") == 1, "all")
                     .when(F.col("is_churned"), "churned").otherwise("active")
                     .alias("churn_status"),
                    "revenue"))


def box_summary(clients: DataFrame, metrics: Sequence[str] = BOX_METRICS,
                by: str = "is_churned") -> DataFrame:
    """Five-number box statistics per metric and status.

    Quartiles are exact (linear interpolation); whiskers are the most extreme
    values within 1.5 IQR of the quartiles; outliers lie beyond them."""
    long = clients.select(by, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in metrics])).alias("m")).select(by, "m.metric", "m.value")
    # one row per (metric, status): broadcast behind a check of the number of statuses
    few = has_at_most(clients.select(by).distinct(), GROUP_BROADCAST_LIMIT // max(len(metrics), 1))
    q = exact_quantiles(long, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["metric", by], few)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = long.where(F.col("value").isNotNull()).join(F.broadcast(q) if few else q, ["metric", by])
    lo_fence = F.col("q1") - 1.5 * F.col("iqr")
    hi_fence = F.col("q3") + 1.5 * F.col("iqr")
    return (j.groupBy("metric", by)
            .agg(F.first("n").alias("n"), F.first("q1").alias("q1"),
                 F.first("median").alias("median"), F.first("q3").alias("q3"),
                 F.first("iqr").alias("iqr"),
                 F.min(F.when(F.col("value") >= lo_fence, F.col("value"))).alias("whisker_low"),
                 F.max(F.when(F.col("value") <= hi_fence, F.col("value"))).alias("whisker_high"),
                 F.count_if((F.col("value") < lo_fence) | (F.col("value") > hi_fence))
                  .alias("outliers")))


def corr_inputs(clients: DataFrame) -> DataFrame:
    return clients.select(
        "*",
        F.col("is_churned").cast("int").alias("is_churned_numeric"),
        X.ordinal("contract_type", X.CONTRACT_ORDINAL).alias("contract_type_num"),
        X.ordinal("client_size", X.SIZE_ORDINAL).alias("size_num"))


def corr_matrix(clients: DataFrame, columns: Sequence[str] = CORR_COLUMNS) -> DataFrame:
    """A8 + A9: pairwise-complete Pearson correlations, lower triangle, long form
    (one aggregate pass computes all pairs)."""
    df = corr_inputs(clients)
    pairs = [(i, j) for i in range(len(columns)) for j in range(i)]
    wide = df.agg(*[F.corr(F.col(columns[i]).cast("double"), F.col(columns[j]).cast("double"))
                    .alias(f"_r{i}_{j}") for i, j in pairs])
    rows = F.explode(F.array(*[
        F.struct(F.lit(columns[i]).alias("col_a"), F.lit(columns[j]).alias("col_b"),
                 F.col(f"_r{i}_{j}").alias("r")) for i, j in pairs]))
    return wide.select(rows.alias("p")).select("p.*")


def lorenz_curve(clients: DataFrame, value: str = "monthly_recurring_revenue",
                 key: str = "client_id") -> DataFrame:
    """Ascending cumulative share of clients and of revenue.

    The running sum is a distributed prefix sum (range slices + offsets), so
    no single task sees the whole table."""
    base = clients.where(F.col(value).isNotNull()).select(key, value)
    cum = prefix_sums(base, [value, key], {"cum_value": F.col(value)}, "pos")
    tot = _one_row(base, F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_t"))
    return (cum.withColumn("_one", F.lit(1)).join(tot, "_one")
            .select(key, value, "pos",
                    (F.col("pos") / F.col("_n")).alias("cum_client_share"),
                    (F.col("cum_value") / F.col("_t")).alias("cum_revenue_share")))


def gini_top_decile(lorenz: DataFrame, value: str = "monthly_recurring_revenue",
                    top_share: float = 0.10) -> DataFrame:
    """W10 + K8 from the Lorenz points.

    Gini = 1 - sum over consecutive points of (y_i + y_(i+1)) / n: the area
    starts at the first point, not the origin, so it equals
    1 - (2 * sum(y) - y_1 - y_n) / n.  The top share sums the sorted positions
    above int((1 - top_share) * n)."""
    y = F.col("cum_revenue_share")
    n_tot = _one_row(lorenz, F.count(F.lit(1)).alias("_n"))
    marked = lorenz.withColumn("_one", F.lit(1)).join(n_tot, "_one")
    top = F.col("pos") > F.floor(F.col("_n") * F.lit(1.0 - top_share))
    return marked.agg(
        F.first("_n").alias("n"),
        (F.lit(1.0) - (2 * F.sum(y) - F.max(F.when(F.col("pos") == 1, y))
                       - F.max(F.when(F.col("pos") == F.col("_n"), y))) / F.first("_n"))
        .alias("gini"),
        (F.sum(F.when(top, F.col(value))) / F.sum(value)).alias("top_decile_share"))


def kde(clients: DataFrame, value: str = "monthly_recurring_revenue", by: str = "is_churned",
        gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per group on a regular grid, Scott bandwidth
    (sample std * n^(-1/5)), grid from min - cut*h to max + cut*h.

    Equal values are counted first; each distinct value then contributes to every grid
    point of its group: a fixed fan-out of ``gridsize``, folded by a map-side
    partial aggregate into gridsize rows per task before the shuffle."""
    base = clients.where(F.col(value).isNotNull()).select(by, F.col(value).alias("_x"))
    st = (base.groupBy(by)
          .agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_s"),
               F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
          .withColumn("_h", F.col("_s") * F.pow(F.col("_n"), F.lit(-0.2)))
          .withColumn("_g0", F.col("_lo") - cut * F.col("_h"))
          .withColumn("_dg", (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_h"))
                      / F.lit(gridsize - 1)))
    # one row per group (the status flag): a bounded side
    j = base.groupBy(by, "_x").agg(F.count(F.lit(1)).alias("_c")).join(F.broadcast(st), by)
    g = j.select(by, "_x", "_c", "_n", "_h", "_g0", "_dg",
                 F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid_index"))
    x = F.col("_g0") + F.col("grid_index") * F.col("_dg")
    z = (x - F.col("_x")) / F.col("_h")
    contrib = F.col("_c") * F.exp(-0.5 * z * z) / (F.col("_n") * F.col("_h") * F.lit((2 * 3.141592653589793)
                                                                        ** 0.5))
    return (g.groupBy(by, "grid_index")
            .agg(F.first(x).alias("x"), F.sum(contrib).alias("density")))
