"""Revenue forecasting for many series at once.

The reference forecasts one company-wide series.  Here every operator takes a
long frame ``(series_id, year_month, value)`` so that one job forecasts all
regions (and the total) together:

* T1: monthly series with a calendar spine (``sequence``) so gaps become 0.
* T2: additive Holt-Winters (season 12, no trend) as a built-in ``aggregate``
  fold over each series and grid point; a series is at most one row per
  month, so an array is small however large the transaction table is.
* T3/T4: one pooled Spark ML GBT regressor on lags 1-3 of all series, and a
  recursive multi-step forecast where each step scores all series in one
  ``transform``; lineage is cut with ``checkpoint()`` every few steps.
* T5-T11: metrics, model choice, residual bands and the churn adjustment are
  plain aggregates and joins.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from .metrics import rmse_mape

SEASON = 12
HOLDOUT = 6
HORIZON = 12
Z95 = 1.96
# Share of the expected loss applied in forecast months 1, 2, 3; 1.0 after
LOSS_RAMP = [0.0, 0.33, 0.67]
ALL_SERIES = "ALL"


def monthly_series(panel: DataFrame, series_col: str | None = "region",
                   value: str = "invoiced_amt", include_total: bool = True) -> DataFrame:
    """T1 (A4 per series): (series_id, year_month, value) with every month of
    the common calendar present (missing months filled with 0).  All months of
    the panel are kept; see ``complete_months`` for what a model may learn from."""
    key = F.col(series_col).cast("string") if series_col else F.lit(ALL_SERIES)
    parts = panel.groupBy(key.alias("series_id"), "year_month").agg(F.sum(value).alias("value"))
    if include_total and series_col:
        # the total adds up the series, not the panel again
        parts = parts.unionByName(
            parts.groupBy(F.lit(ALL_SERIES).alias("series_id"), "year_month")
            .agg(F.sum("value").alias("value")))
    # calendar spine: every series gets every month between the global first
    # and last month (a per-row sequence, no join of two unrelated tables)
    bounds = parts.agg(F.min("year_month").alias("_lo"), F.max("year_month").alias("_hi"))
    series = parts.select("series_id").distinct().withColumn("_one", F.lit(1))
    spine = (series.join(F.broadcast(bounds.withColumn("_one", F.lit(1))), "_one")
             .select("series_id", F.explode(F.sequence(X.month_start("_lo"), X.month_start("_hi"),
                                                       F.expr("interval 1 month"))).alias("_m"))
             .select("series_id", X.month_key("_m").alias("year_month")))
    return (spine.join(parts, ["series_id", "year_month"], "left")
            .select("series_id", "year_month", F.coalesce("value", F.lit(0.0)).alias("value")))


def last_complete_month(transactions: DataFrame, kind: str = "invoice") -> DataFrame:
    """One row: the month of the last transaction of ``kind`` if that falls on its last day, else
    the month before.  Read from the data, so newer data moves it."""
    last = transactions.where(F.col("transaction_type") == kind).agg(
        F.max("transaction_date").alias("d"))
    return last.select(X.month_key(F.when(F.col("d") == F.last_day("d"), F.col("d"))
                                   .otherwise(F.add_months("d", -1))).alias("as_of"))


def complete_months(series: DataFrame, as_of: DataFrame) -> DataFrame:
    """The months up to ``as_of`` (one row), before backtests and forecasts: a half month is not a
    fall in revenue."""
    return series.where(F.col("year_month") <= as_of.scalar())


def with_index(series: DataFrame) -> DataFrame:
    """Position t (1..n) and n per series, from the end as well (K6, K7)."""
    w = Window.partitionBy("series_id").orderBy("year_month")
    return (series.withColumn("t", F.row_number().over(w))
            .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("series_id"))))


def history_tail(series: DataFrame, months: int = 24) -> DataFrame:
    """K6: the last ``months`` observations of every series (a top-k per group,
    pushed below the window by Spark's group limit)."""
    w = Window.partitionBy("series_id").orderBy(F.desc("year_month"))
    return (series.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= months)
            .drop("_r"))


def lag_features(series: DataFrame, lags=(1, 2, 3)) -> DataFrame:
    """Lags of the value per series (NULL where history is short)."""
    w = Window.partitionBy("series_id").orderBy("year_month")
    out = series
    for k in lags:
        out = out.withColumn(f"lag{k}", F.lag("value", k).over(w))
    return out


# ---------------------------------------------------------------------------
# Holt-Winters (T2) as a built-in fold over (series x grid)
# ---------------------------------------------------------------------------
GRID_STEPS = 19   # alpha and gamma run over 0.05, 0.10, ..., 0.95
_SEASONAL = f"acc.seas[acc.t % {SEASON}]"
_LEVEL = f"(alpha * (obs - {_SEASONAL}) + (1 - alpha) * acc.level)"
_HW_FOLD = f"""aggregate(y,
  named_struct('level', l0, 'seas', transform(slice(y, 1, {SEASON}), x -> x - l0), 't', 0,
               'sse', 0D, 'err', 0D),
  (acc, obs) -> named_struct(
    'level', {_LEVEL},
    'seas', transform(acc.seas, (s, i) -> if(i = acc.t % {SEASON},
                                             gamma * (obs - {_LEVEL}) + (1 - gamma) * s, s)),
    't', acc.t + 1,
    'sse', acc.sse + (acc.level + {_SEASONAL} - obs) * (acc.level + {_SEASONAL} - obs),
    'err', acc.err + (obs - acc.level - {_SEASONAL})))"""


def holt_winters(series: DataFrame, holdout: int = HOLDOUT, horizon: int = HORIZON) -> DataFrame:
    """T2 + T8: per series, the hold-out backtest and the future forecast with
    the population std of the in-sample one-step residuals.

    Additive level and season without trend; (alpha, gamma) by the least in-sample
    squared error over the grid, the smaller pair on a tie.  The recursion is one
    ``aggregate`` expression per series and grid point, so no Python worker
    is needed and series x grid spreads over all tasks.  A fit on ``SEASON`` values or fewer has
    no season to learn: its predictions are NULL and ``status`` says so.
    """
    whole = series.groupBy("series_id").agg(
        F.array_sort(F.collect_list(F.struct("year_month", "value"))).alias("_s")).select(
        "series_id", F.col("_s.year_month").alias("_months"),
        F.transform("_s.value", lambda v: v.cast("double")).alias("_all"))
    fits = whole.select("*", F.explode(F.array(
        F.struct(F.lit("backtest").alias("kind"), F.lit(holdout).alias("held"),
                 F.lit(holdout).alias("steps")),
        F.struct(F.lit("forecast").alias("kind"), F.lit(0).alias("held"),
                 F.lit(horizon).alias("steps")))).alias("_f")).select(
        "series_id", "_months", "_all", "_f.*").where(F.size("_all") > F.col("held"))
    fits = fits.withColumn("y", F.slice("_all", 1, F.size("_all") - F.col("held")))
    fits = fits.withColumn("n", F.size("y"))
    long = fits.where(F.col("n") > SEASON).withColumn("l0", F.expr(
        f"aggregate(slice(y, 1, {SEASON}), 0D, (a, x) -> a + x) / {SEASON}"))
    steps = F.sequence(F.lit(1), F.lit(GRID_STEPS))
    run = (long.select("series_id", "kind", "n", "l0", "y", F.explode(steps).alias("_a"))
           .select("*", F.explode(steps).alias("_g"))
           .withColumn("alpha", F.round(F.col("_a") * 0.05, 2))
           .withColumn("gamma", F.round(F.col("_g") * 0.05, 2))
           .withColumn("_fit", F.expr(_HW_FOLD)))
    best = run.groupBy("series_id", "kind").agg(F.min_by(
        F.struct("alpha", "gamma", F.col("_fit.level").alias("level"), F.col("_fit.seas").alias("seas"),
                 F.sqrt(F.greatest(F.lit(0.0), F.col("_fit.sse") / F.col("n")
                                   - F.pow(F.col("_fit.err") / F.col("n"), 2))).alias("std")),
        F.struct(F.col("_fit.sse"), "alpha", "gamma")).alias("b"))
    out = fits.join(best, ["series_id", "kind"], "left").withColumn(
        "h", F.explode(F.sequence(F.lit(1), F.col("steps"))))
    future = F.col("kind") == "forecast"
    return out.select(
        "series_id", "kind", "h",
        F.when(future, X.month_after(X.month_start(F.element_at("_months", -1)), F.col("h")))
        .otherwise(F.get("_months", F.col("n") + F.col("h") - 1)).alias("year_month"),
        F.when(~future, F.get("_all", F.col("n") + F.col("h") - 1)).alias("actual"),
        (F.col("b.level") + F.get("b.seas", (F.col("n") + F.col("h") - 1) % SEASON)).alias("prediction"),
        F.when(future, F.col("b.std")).alias("resid_std"),
        F.col("b.alpha").alias("alpha"), F.col("b.gamma").alias("gamma"),
        F.when(F.col("b").isNull(), "history too short").otherwise("fitted").alias("status"))


# ---------------------------------------------------------------------------
# Pooled GBT on lags
# ---------------------------------------------------------------------------
def _lag_model(train: DataFrame, seed: int = 42):
    asm = VectorAssembler(inputCols=["lag1", "lag2", "lag3"], outputCol="_x")
    gbt = GBTRegressor(featuresCol="_x", labelCol="value", predictionCol="_pred", maxIter=50,
                       maxDepth=3, stepSize=0.1, seed=seed)
    return asm, gbt.fit(asm.transform(train))


def _recursive(asm, model, start: DataFrame, steps: int, checkpoint_every: int = 4) -> DataFrame:
    """T4: start holds one row per series with lag1..lag3 for the first step.
    Each step predicts all series at once, then shifts the lags."""
    state = start.withColumn("h", F.lit(1))
    preds = []
    for step in range(1, steps + 1):
        scored = model.transform(asm.transform(state)).select(
            "series_id", "h", "lag1", "lag2", "lag3", F.col("_pred").alias("prediction"))
        if step % checkpoint_every == 0:
            scored = scored.checkpoint()
        preds.append(scored.select("series_id", "h", "prediction"))
        state = scored.select("series_id", (F.col("h") + 1).alias("h"),
                              F.col("prediction").alias("lag1"), F.col("lag1").alias("lag2"),
                              F.col("lag2").alias("lag3"))
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out


def gbt_lags(series: DataFrame, holdout: int = HOLDOUT, horizon: int = HORIZON) -> DataFrame:
    """Backtest (fit on all but the last ``holdout`` months of every series) and
    future forecast (fit on everything) with the pooled lag model.  The future
    recursion starts from the last three observed values."""
    idx = with_index(lag_features(series)).checkpoint()   # small: one row per series-month
    rows = idx.where(F.col("lag3").isNotNull())
    # the backtest fit and the full fit are independent: run them together
    with ThreadPoolExecutor(max_workers=2) as pool:
        f_bt = pool.submit(_lag_model, rows.where(F.col("t") <= F.col("n") - holdout))
        f_all = pool.submit(_lag_model, rows)
        (asm, m_bt), (_, m_all) = f_bt.result(), f_all.result()
    # backtest
    first = idx.where(F.col("t") == F.col("n") - holdout + 1).select(
        "series_id", "lag1", "lag2", "lag3")
    bt = _recursive(asm, m_bt, first, holdout)
    actual = idx.where(F.col("t") > F.col("n") - holdout).select(
        "series_id", (F.col("t") - F.col("n") + holdout).alias("h"), "year_month",
        F.col("value").alias("actual"))
    bt = bt.join(actual, ["series_id", "h"]).select(
        "series_id", F.lit("backtest").alias("kind"), "h", "year_month", "actual", "prediction")
    # future
    last = idx.where(F.col("t") == F.col("n")).select(
        "series_id", F.col("value").alias("lag1"), F.col("lag1").alias("lag2"),
        F.col("lag2").alias("lag3"), F.col("year_month").alias("_last"))
    fut = _recursive(asm, m_all, last.drop("_last"), horizon)
    resid = (m_all.transform(asm.transform(rows))
             .groupBy("series_id").agg(F.stddev_pop(F.col("value") - F.col("_pred"))
                                       .alias("resid_std")))
    fut = (fut.join(last.select("series_id", "_last"), "series_id")
           .join(resid, "series_id")
           .select("series_id", F.lit("forecast").alias("kind"), "h",
                   X.month_after(X.month_start("_last"), F.col("h")).alias("year_month"),
                   F.lit(None).cast("double").alias("actual"), "prediction", "resid_std"))
    return bt.withColumn("resid_std", F.lit(None).cast("double")).unionByName(fut)


# ---------------------------------------------------------------------------
# seasonal-naive baseline (SQL-checkable stand-in for a fitted model)
# ---------------------------------------------------------------------------
def seasonal_naive(series: DataFrame, holdout: int = HOLDOUT, horizon: int = HORIZON,
                   season: int = SEASON) -> DataFrame:
    """Prediction = the value one season earlier (for the future: the last
    observed season repeated); residual std over all one-season differences."""
    w = Window.partitionBy("series_id").orderBy("year_month")
    idx = with_index(series).withColumn("_prev", F.lag("value", season).over(w))
    bt = idx.where(F.col("t") > F.col("n") - holdout).select(
        "series_id", F.lit("backtest").alias("kind"),
        (F.col("t") - F.col("n") + holdout).cast("int").alias("h"), "year_month",
        F.col("value").alias("actual"), F.col("_prev").alias("prediction"),
        F.lit(None).cast("double").alias("resid_std"))
    sd = idx.groupBy("series_id").agg(
        F.stddev_pop(F.col("value") - F.col("_prev")).alias("resid_std"),
        F.max("year_month").alias("_last"))
    tail = idx.where(F.col("t") > F.col("n") - season).select(
        "series_id", (F.col("t") - F.col("n") + season).cast("int").alias("_k"), "value")
    fut = (sd.select("series_id", "resid_std", "_last",
                     F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
           .withColumn("_k", ((F.col("h") - 1) % season) + 1)
           .join(tail, ["series_id", "_k"])
           .select("series_id", F.lit("forecast").alias("kind"), "h",
                   X.month_after(X.month_start("_last"), F.col("h")).alias("year_month"),
                   F.lit(None).cast("double").alias("actual"), F.col("value").alias("prediction"),
                   "resid_std"))
    return bt.unionByName(fut)


def backtest_metrics(predictions: DataFrame) -> DataFrame:
    """T5 + T6 per series (and model, when present)."""
    keys = ["series_id"] + (["model"] if "model" in predictions.columns else [])
    return rmse_mape(predictions.where(F.col("kind") == "backtest"), "actual", "prediction", keys)


def choose_model(metrics: DataFrame, other: str = "gbt_lags", short: str = "gbt") -> DataFrame:
    """T7 per series: Holt-Winters when its MAPE is lower, else the ``other`` model."""
    hw = metrics.where(F.col("model") == "holt_winters").select(
        "series_id", F.col("mape").alias("hw_mape"))
    alt = metrics.where(F.col("model") == other).select(
        "series_id", F.col("mape").alias(f"{short}_mape"))
    return hw.join(alt, "series_id", "full").select(
        "series_id", "hw_mape", f"{short}_mape",
        F.when(F.coalesce(F.col("hw_mape") < F.col(f"{short}_mape"),
                          F.col(f"{short}_mape").isNull() & F.col("hw_mape").isNotNull()),
               "holt_winters").otherwise(other).alias("model"))


def both_models(hw: DataFrame, alternative: DataFrame, other: str = "gbt_lags") -> DataFrame:
    """The rows of Holt-Winters and of another model, told apart by ``model``."""
    return (hw.drop("alpha", "gamma", "status").withColumn("model", F.lit("holt_winters"))
            .unionByName(alternative.withColumn("model", F.lit(other))))


def chosen_forecast(hw: DataFrame, alternative: DataFrame, other: str = "gbt_lags") -> DataFrame:
    """T7 -> T8: per series, the rows of the model with the lower backtest MAPE
    (the other model when Holt-Winters had too short a history)."""
    # both fits feed two consumers (metrics, rows): materialise once in the
    # shared checkpoint folder (a few rows per series) instead of refitting
    preds = both_models(hw, alternative, other).checkpoint()
    choice = choose_model(backtest_metrics(preds), other).select("series_id", "model")
    # one row per series on the right: small, joined by key
    return preds.join(choice, ["series_id", "model"], "inner")


def expected_loss(ranking: DataFrame, clients: DataFrame, series_col: str | None = "region",
                  include_total: bool = True) -> DataFrame:
    """A11 per series: sum of MRR x p over active clients."""
    act = ranking.where(~F.col("is_churned")).select(
        "client_id", (F.col("monthly_recurring_revenue")
                      * F.col("predicted_churn_probability")).alias("_l"))
    if series_col:
        act = act.join(clients.select("client_id", series_col), "client_id")
        per = act.groupBy(F.col(series_col).cast("string").alias("series_id")).agg(
            F.sum("_l").alias("expected_loss"))
    else:
        per = act.agg(F.sum("_l").alias("expected_loss")).select(
            F.lit(ALL_SERIES).alias("series_id"), "expected_loss")
    if include_total and series_col:
        per = per.unionByName(act.agg(F.sum("_l").alias("expected_loss")).select(
            F.lit(ALL_SERIES).alias("series_id"), "expected_loss"))
    return per


def loss_ramp(h) -> F.Column:
    out = None
    for i, v in enumerate(LOSS_RAMP, start=1):
        out = F.when(h == i, F.lit(v)) if out is None else out.when(h == i, F.lit(v))
    return out.otherwise(F.lit(1.0))


def churn_adjusted(forecast: DataFrame, losses: DataFrame, z: float = Z95) -> DataFrame:
    """Band +- z * s * sqrt(h); the loss phased in by the ramp."""
    f = forecast.where(F.col("kind") == "forecast").join(losses, "series_id", "left")
    band = F.lit(z) * F.col("resid_std") * F.sqrt(F.col("h").cast("double"))
    loss = F.coalesce(F.col("expected_loss"), F.lit(0.0)) * loss_ramp(F.col("h"))
    extra = ["model"] if "model" in forecast.columns else []
    return f.select(
        "series_id", "year_month", *extra, F.col("prediction").alias("baseline_forecast"),
        (F.col("prediction") - band).alias("ci_lower"),
        (F.col("prediction") + band).alias("ci_upper"),
        (F.col("prediction") - loss).alias("churn_adjusted_forecast"),
        loss.alias("expected_mrr_loss"))


def horizon_total(adjusted: DataFrame) -> DataFrame:
    """Next-12-month churn-adjusted revenue per series."""
    return adjusted.groupBy("series_id").agg(
        F.sum("churn_adjusted_forecast").alias("next_12m_revenue"),
        F.max("expected_mrr_loss").alias("peak_monthly_loss"))
