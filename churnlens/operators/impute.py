"""Imputation.

The reference fits one regression over in-memory arrays; here the MRR model is
a Spark ML ``LinearRegression`` with the normal-equation solver (one pass of
sufficient statistics over the executors) and medians are exact, computed on
distinct values (see ``ordering.exact_quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from .joins import split_hot_join
from .ordering import exact_median
from .panel import DOWNGRADE, INVOICE, PAYMENT, UPDOWN_FILL, UPGRADE


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and rate of every column, in one scan, long form."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_z{i}").alias("null_count"))
        for i, c in enumerate(cols)]))
    return (wide.select("_n", pairs.alias("p"))
            .select("p.column_name", "p.null_count",
                    F.try_divide(F.col("p.null_count"), F.col("_n")).alias("null_rate")))


def fill_median(df: DataFrame, column: str) -> DataFrame:
    """Replace NULLs with the exact median (a no-op when none is missing)."""
    m = exact_median(df, column)
    return df if m is None else df.fillna({column: float(m)})


def mrr_regressors(clients: DataFrame, industry_vocab: Sequence[str]) -> DataFrame:
    """size ordinal, number of services, industry indicators (first level dropped)."""
    return clients.select(
        "*",
        X.ordinal("client_size", X.SIZE_ORDINAL).cast("double").alias("_size_num"),
        X.services_count("services_subscribed").cast("double").alias("_num_services"),
        *[c.cast("double") for c in X.one_hot("industry", industry_vocab, "_ind")],
    )


def fit_mrr_model(clients: DataFrame, industry_vocab: Sequence[str],
                  target: str = "monthly_recurring_revenue"):
    """OLS of MRR on the regressors over rows where MRR is known.

    Returns (fitted model, assembler); ``model.summary.r2`` is the R2 on the
    training rows (computed only when read)."""
    feats = ["_size_num", "_num_services"] + [f"_ind_{v}" for v in industry_vocab]
    data = mrr_regressors(clients, industry_vocab)
    assembler = VectorAssembler(inputCols=feats, outputCol="_x")
    train = assembler.transform(data.where(F.col(target).isNotNull()))
    lr = LinearRegression(featuresCol="_x", labelCol=target, predictionCol="_mrr_pred",
                          solver="normal", regParam=0.0, fitIntercept=True,
                          standardization=False)
    model = lr.fit(train)
    return model, assembler


def mrr_fit_quality(clients: DataFrame, industry_vocab: Sequence[str],
                    target: str = "monthly_recurring_revenue") -> DataFrame:
    """Training-row count and R2 of the MRR regression, one row (the R2 is
    computed by the executors from the model's predictions)."""
    model, assembler = fit_mrr_model(clients, industry_vocab, target)
    train = assembler.transform(mrr_regressors(clients, industry_vocab)
                                .where(F.col(target).isNotNull()))
    pred = model.transform(train)
    mean = pred.agg(F.avg(target).alias("_m")).withColumn("_one", F.lit(1))
    resid = F.col(target) - F.col("_mrr_pred")
    dev = F.col(target) - F.col("_m")
    return (pred.withColumn("_one", F.lit(1)).join(F.broadcast(mean), "_one")   # one row
            .agg(F.count(F.lit(1)).alias("n_train"),
                 (F.lit(1.0) - F.sum(resid * resid) / F.sum(dev * dev)).alias("r2")))


def impute_mrr_ols(clients: DataFrame, industry_vocab: Sequence[str],
                   target: str = "monthly_recurring_revenue") -> DataFrame:
    """Fill missing MRR with the regression prediction; known values stay."""
    if clients.where(F.col(target).isNull()).limit(1).count() == 0:
        return clients  # nothing missing: no-op (a rerun must not fail)
    model, assembler = fit_mrr_model(clients, industry_vocab, target)
    data = assembler.transform(mrr_regressors(clients, industry_vocab))
    scored = model.transform(data)
    helper = [c for c in scored.columns if c.startswith("_")]
    return (scored.withColumn(target, F.coalesce(F.col(target), F.col("_mrr_pred")))
            .drop(*helper))


def clean_clients(clients: DataFrame, industry_vocab: Sequence[str]) -> DataFrame:
    """The chosen strategy: MRR by regression, payment delay by median."""
    out = impute_mrr_ols(clients, industry_vocab)
    return fill_median(out, "payment_delay_days_avg")


def impute_compare(clients: DataFrame, industry_vocab: Sequence[str],
                   column: str = "monthly_recurring_revenue") -> DataFrame:
    """Mean and sample std of the original, median-filled and
    regression-filled column (one row per strategy)."""
    med = exact_median(clients, column)
    reg = impute_mrr_ols(clients, industry_vocab, column).select(
        "client_id", F.col(column).alias("_reg"))
    both = clients.select("client_id", column).join(reg, "client_id")
    med_col = F.coalesce(F.col(column), F.lit(med))
    stats = both.agg(
        F.avg(column).alias("m0"), F.stddev_samp(column).alias("s0"),
        F.avg(med_col).alias("m1"), F.stddev_samp(med_col).alias("s1"),
        F.avg("_reg").alias("m2"), F.stddev_samp("_reg").alias("s2"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("strategy"), F.col(m).alias("mean"), F.col(s).alias("std"))
        for name, m, s in (("original", "m0", "s0"), ("median", "m1", "s1"),
                           ("regression", "m2", "s2"))]))
    return stats.select(rows.alias("r")).select("r.*")


def impute_amounts(transactions: DataFrame, clients: DataFrame,
                   updown_fill: float = UPDOWN_FILL, hot: list | None = None) -> DataFrame:
    """I7/I8 at row level: upgrades/downgrades get a constant, invoices and
    payments the client's MRR; tickets and usage logs stay NULL.

    Row-level output needs the lookup join; an unknown client keeps NULL.
    (The panel does not use this: it applies the same fill after aggregating.)
    ``hot`` names the clients known to hold many rows; without it they are looked for in
    ``transactions``, which evaluates that frame twice more.
    """
    kind = F.col("transaction_type")
    dim = clients.select(F.col("client_id").alias("_cid"), F.col("monthly_recurring_revenue").alias("_mrr"))
    j = split_hot_join(transactions, dim, "client_id", "_cid", "left", hot)   # a hot client stays out of the shuffle
    amount = (F.when(F.col("amount").isNotNull(), F.col("amount"))
              .when(kind.isin(UPGRADE, DOWNGRADE), F.lit(updown_fill))
              .when(kind.isin(INVOICE, PAYMENT), F.col("_mrr")))
    return j.withColumn("amount", amount).select(*transactions.columns)
