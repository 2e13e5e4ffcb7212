"""Evaluation metrics.

ROC-AUC and PR-AUC are computed from the distinct score values: one grouped
aggregate folds the scored rows to (score, positives, negatives), a
distributed prefix sum gives the cumulative counts per threshold, and each
threshold adds its own trapezoid (the previous point is the cumulative count
minus the threshold's own counts, so no lag across slices is needed).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import descending, prefix_sums


def _curve(df: DataFrame, label: str, score: str) -> DataFrame:
    counts = (df.where(F.col(score).isNotNull())
              .groupBy(F.col(score).alias("_s"))
              .agg(F.sum(F.col(label).cast("long")).alias("_pos"),
                   F.sum((1 - F.col(label)).cast("long")).alias("_neg")))
    cum = prefix_sums(counts, [descending("_s")], {"_tp": F.col("_pos"), "_fp": F.col("_neg")},
                      "_k")
    tot = F.broadcast(counts.agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
                      .withColumn("_one", F.lit(1)))
    return cum.withColumn("_one", F.lit(1)).join(tot, "_one")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """M8: area under the ROC curve (ties count one half), one row."""
    c = _curve(df, label, score)
    tpr = F.col("_tp") / F.col("_P")
    fpr = F.col("_fp") / F.col("_N")
    tpr0 = (F.col("_tp") - F.col("_pos")) / F.col("_P")
    fpr0 = (F.col("_fp") - F.col("_neg")) / F.col("_N")
    return c.agg(F.sum((fpr - fpr0) * (tpr + tpr0) / 2).alias("roc_auc"))


def pr_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """M9: trapezoid area under precision-recall, anchored at recall 0 with
    precision 1 (scikit-learn's curve), one row."""
    c = _curve(df, label, score)
    tp, fp = F.col("_tp"), F.col("_fp")
    tp0, fp0 = tp - F.col("_pos"), fp - F.col("_neg")
    prec = tp / (tp + fp)
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(F.lit(1.0))
    rec, rec0 = tp / F.col("_P"), tp0 / F.col("_P")
    return c.agg(F.sum((rec - rec0) * (prec + prec0) / 2).alias("pr_auc"))


def confusion(df: DataFrame, label: str = "label", score: str = "score",
              threshold: float = 0.5) -> DataFrame:
    """TN, FP, FN, TP at ``score >= threshold``."""
    yhat = F.col(score) >= threshold
    y = F.col(label) == 1
    return df.agg(F.count_if(~y & ~yhat).alias("tn"), F.count_if(~y & yhat).alias("fp"),
                  F.count_if(y & ~yhat).alias("fn"), F.count_if(y & yhat).alias("tp"))


def _div0(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def class_report(conf: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Precision / recall / F1 per class, macro F1 and accuracy; a zero
    denominator gives 0.  ``keep``: columns of ``conf`` to carry along."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    f1 = _div0(2 * p1 * r1, p1 + r1)
    f0 = _div0(2 * p0 * r0, p0 + r0)
    return conf.select(
        *keep, p1.alias("precision_1"), r1.alias("recall_1"), f1.alias("f1_1"),
        p0.alias("precision_0"), r0.alias("recall_0"), f0.alias("f1_0"),
        ((f1 + f0) / 2).alias("macro_f1"),
        _div0(tp + tn, tp + tn + fp + fn).alias("accuracy"))


EVALUATION = ["roc_auc", "pr_auc", "tn", "fp", "fn", "tp", "precision_1", "recall_1", "f1_1",
              "precision_0", "recall_0", "f1_0", "macro_f1", "accuracy"]


def evaluate_groups(df: DataFrame, group: str, label: str = "label", score: str = "score",
                    threshold: float = 0.5) -> DataFrame:
    """AUCs, confusion counts and class report per group (one row per model).

    One aggregate folds the rows to (group, score, positives, negatives); one prefix sum over
    all groups gives the running counts, and both AUCs and the confusion counts come
    from those same rows."""
    counts = (df.where(F.col(score).isNotNull()).groupBy(group, F.col(score).alias("_s"))
              .agg(F.sum(F.col(label).cast("long")).alias("_pos"),
                   F.sum((1 - F.col(label)).cast("long")).alias("_neg")))
    cum = prefix_sums(counts, [F.col(group), descending("_s")],
                      {"_tp": F.col("_pos"), "_fp": F.col("_neg")}, "_k")
    totals = cum.groupBy(group).agg(
        F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"),
        F.min(F.col("_tp") - F.col("_pos")).alias("_tp0"), F.min(F.col("_fp") - F.col("_neg")).alias("_fp0"))
    c = cum.join(F.broadcast(totals), group)   # one row per model
    tp, fp = F.col("_tp") - F.col("_tp0"), F.col("_fp") - F.col("_fp0")
    tp0, fp0 = tp - F.col("_pos"), fp - F.col("_neg")
    # a class without rows leaves its rates undefined (NULL), as the single-model curves do
    rate = F.try_divide
    rec, rec0, fpr, fpr0 = (rate(tp, F.col("_P")), rate(tp0, F.col("_P")),
                            rate(fp, F.col("_N")), rate(fp0, F.col("_N")))
    prec = tp / (tp + fp)
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(F.lit(1.0))
    yhat = F.col("_s") >= threshold
    summed = c.groupBy(group).agg(
        F.sum((fpr - fpr0) * (rec + rec0) / 2).alias("roc_auc"),
        F.sum((rec - rec0) * (prec + prec0) / 2).alias("pr_auc"),
        *[F.coalesce(F.sum(F.when(when, F.col(n))), F.lit(0)).alias(name) for name, when, n in (
            ("tn", ~yhat, "_neg"), ("fp", yhat, "_neg"), ("fn", ~yhat, "_pos"), ("tp", yhat, "_pos"))])
    return class_report(summed, [group, "roc_auc", "pr_auc", "tn", "fp", "fn", "tp"])


def rmse_mape(df: DataFrame, actual: str, predicted: str, group_cols=()) -> DataFrame:
    """T5 + T6: RMSE and MAPE (%) per group; a zero actual contributes no MAPE term."""
    err = F.col(actual) - F.col(predicted)
    return df.groupBy(*group_cols).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(err, F.col(actual)))) * 100).alias("mape"))
