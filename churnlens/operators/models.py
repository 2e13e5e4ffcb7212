"""Churn classifiers with Spark ML.

* The training rows are standardised (population deviation) and assembled once; each saved ``PipelineModel``
  holds that scaling, the assembler and the model together.
* Class balance (M4) for the fits: by default instance weights (``weightCol``), the positives weighing n_neg / n_pos;
  or the rows of ``smote.balanced``, which adds synthetic churners up to 1:1.
* Fitting is distributed (L-BFGS / tree aggregation over the executors);
  scoring is a ``transform`` on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import metrics as MT
from . import trees as TR
from .smote import scaling

LABEL = "target_churn_3m"
SCORE = "predicted_churn_probability"
FOREST = "Random Forest"
MODEL_ORDER = ["Logistic Regression", FOREST, "Gradient Boosted Trees"]

# Business labels of the base features
FEATURE_LABELS = {
    "monthly_recurring_revenue": "Monthly Recurring Revenue ($)",
    "nps_score": "NPS Score",
    "tenure_months": "Client Tenure (Months)",
    "services_count": "Number of Services Subscribed",
    "revenue_trend_3mo": "Revenue Trend (3 Months)",
    "usage_trend_3mo": "Product Usage Trend (3 Months)",
    "late_payment_rate": "Late Payment Rate",
    "sla_breach_rate": "SLA Breach Rate",
    "months_since_last_upgrade": "Months Since Last Upgrade",
    "is_declining_engagement_flag": "Declining Engagement Indicator",
    "ticket_count": "Support Ticket Volume",
    "escalated_ticket_count": "Escalated Ticket Volume",
    "total_usage": "Total Product Usage Volume",
    "usage_infra": "Infrastructure Usage Volume",
    "usage_cloud": "Cloud Service Usage Volume",
    "usage_security": "Security Service Usage Volume",
    "size_num": "Client Size Tier",
    "contract_type_num": "Contract Duration Tier",
}


def business_label(feature: str) -> str:
    """Label of a feature; an indicator reads as its group and level, anything else as its name."""
    for group in ("industry", "region"):
        if feature.startswith(group + "_"):
            return f"{group.capitalize()}: {feature[len(group) + 1:]}"
    return FEATURE_LABELS.get(feature, feature)


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """M4 by weights: weight column that balances the two classes exactly."""
    c = train.agg(F.count_if(F.col(label) == 1).alias("pos"),
                  F.count_if(F.col(label) == 0).alias("neg")).first()
    w_pos = float(c["neg"]) / c["pos"] if c["pos"] else 1.0
    return train.withColumn("_w", F.when(F.col(label) == 1, F.lit(w_pos)).otherwise(F.lit(1.0)))


def _estimators(n_train: float, seed: int = 42) -> dict:
    common, binned = dict(featuresCol="scaled", labelCol=LABEL, weightCol="_w"), TR.Binned()
    return {
        # sklearn's L2 with C = 1 on the summed loss = regParam 1/n on Spark's mean loss
        "Logistic Regression": LogisticRegression(maxIter=1000, regParam=1.0 / max(n_train, 1.0),
                                                  elasticNetParam=0.0, standardization=False,
                                                  **common),
        FOREST: TR.Fit(RandomForestClassifier(numTrees=100, maxDepth=8, seed=seed, **common), binned),
        "Gradient Boosted Trees": TR.Fit(GBTClassifier(maxIter=100, maxDepth=5, stepSize=0.05,
                                                       seed=seed, **common), binned),
    }


def pipeline(features: Sequence[str], estimator) -> Pipeline:
    """Assemble, standardise with Spark's own scaler (sample deviation) and fit any estimator in one ``fit``."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        estimator,
    ])


def scaled_stages(scale: dict[str, tuple[float, float]]) -> list:
    """M3: transformers that standardise with the given means and population deviations and assemble ``scaled``."""
    z = ", ".join(f"(`{f}` - {m!r}D) / {s!r}D AS `_z_{f}`" for f, (m, s) in scale.items())
    return [SQLTransformer(statement=f"SELECT *, {z} FROM __THIS__"),
            VectorAssembler(inputCols=[f"_z_{f}" for f in scale], outputCol="scaled", handleInvalid="keep")]


def prepare(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Missing feature values become 0 (the model-ready table has none)."""
    return df.fillna(0.0, subset=list(features))


def fit_models(labelled: DataFrame, features: Sequence[str], models: Sequence[str] = tuple(MODEL_ORDER),
               smote: DataFrame | None = None) -> dict[str, PipelineModel]:
    """One fitted pipeline per model name, on the rows of split ``train``, balanced by weights; or on ``smote``
    (label and standardised features of the same training rows, already balanced)."""
    train = prepare(labelled.where(F.col("split") == "train"), features)
    scale = scaled_stages(scaling(train, features))
    if smote is None:
        rows = class_weights(train)
        for stage in scale:
            rows = stage.transform(rows)
    else:
        assemble = VectorAssembler(inputCols=list(features), outputCol="scaled", handleInvalid="keep")
        rows = assemble.transform(smote.withColumn("_w", F.lit(1.0)))
    rows = rows.select(LABEL, "scaled", "_w")
    n = rows.agg(F.sum("_w")).first()[0] or 0.0
    est = _estimators(n)
    # the forest is fitted after the other two, which share the executors: its tables take most of their time and memory
    fitted = {}
    try:
        for together in ([m for m in models if m != FOREST], [m for m in models if m == FOREST]):
            with ThreadPoolExecutor(max_workers=max(len(together), 1)) as pool:
                futures = {m: pool.submit(est[m].fit, rows) for m in together}
                fitted |= {m: PipelineModel([*scale, f.result()]) for m, f in futures.items()}
    finally:
        for e in est.values():
            if isinstance(e, TR.Fit):
                e.data.free()
    return {m: fitted[m] for m in models}


def score(model: PipelineModel, df: DataFrame, features: Sequence[str],
          out: str = SCORE) -> DataFrame:
    """Probability of class 1 as a double column."""
    pred = model.transform(prepare(df, features))
    keep = [c for c in df.columns] + [out]
    return pred.withColumn(out, vector_to_array("probability")[1]).select(*keep)


def compare(fitted: dict[str, PipelineModel], labelled: DataFrame,
            features: Sequence[str]) -> DataFrame:
    """One evaluation row per model on the test clients.

    The test rows are read once and pass through all models in a row; what
    goes on is one count per (model, score)."""
    rows = prepare(labelled.where(F.col("split") == "test"), features).select(LABEL, *features)
    scores = []
    for i, m in enumerate(fitted.values()):
        rows = m.transform(rows).withColumn(f"_p{i}", vector_to_array("probability")[1]).drop(
            "scaled", "rawPrediction", "probability", "prediction", *[f"_z_{f}" for f in features])
        scores.append(F.struct(F.lit(i).alias("model_order"), F.col(f"_p{i}").alias("score")))
    long = rows.select(F.col(LABEL).alias("label"), F.explode(F.array(*scores)).alias("_s")).select(
        "label", "_s.*")
    names = F.element_at(F.array(*[F.lit(n) for n in fitted]), F.col("model_order") + 1)
    return MT.evaluate_groups(long, "model_order").select(
        names.alias("model"), "model_order", *MT.EVALUATION)


def best_model(comparison: DataFrame) -> str:
    """Highest PR-AUC; on a tie the earlier model wins."""
    return comparison.orderBy(F.desc("pr_auc"), "model_order").first()["model"]


def importances(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """M14 + W12 + F18: tree importances or |coefficients|, normalised to sum 1,
    with business labels.  One row per feature (a bounded, small frame)."""
    est = model.stages[-1]
    if hasattr(est, "featureImportances"):
        raw = [float(v) for v in est.featureImportances.toArray()]
    else:
        raw = [abs(float(v)) for v in est.coefficients.toArray()]
    return shares(dict(zip(features, raw)), SparkSession.getActiveSession())


def shares(weights: dict[str, float], session: SparkSession) -> DataFrame:
    """W12 + F18: feature, business label and its share of all weights; one row per feature."""
    df = session.createDataFrame([(f, business_label(f), float(w)) for f, w in weights.items()],
                                 "feature string, business_feature string, weight double")
    total = F.sum("weight").over(Window.partitionBy())
    return df.select(
        "feature", "business_feature",
        F.coalesce(F.try_divide(F.col("weight"), total), F.lit(0.0)).alias("importance"))


def save(model: PipelineModel, path: str) -> None:
    """Scaler, feature list and model saved as one directory."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
