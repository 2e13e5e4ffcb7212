"""Fitted-model queries: one-pass evaluation and what-if through a saved pipeline, recomputed by hand."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from churnlens.operators import decisions as DE
from churnlens.operators import metrics as MT
from churnlens.operators import models as MD

from .test_brute_force import _brute_pr, _brute_roc

FEATURES = ["sla_breach_rate", "escalated_ticket_count", "product_usage_score", "nps_score", "total_usage",
            "usage_infra", "usage_cloud", "usage_security", "usage_trend_3mo", "is_declining_engagement_flag"]


def test_evaluate_groups_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for g in range(3):
        s = [float(v) for v in np.round(rng.random(150), 2)]
        y = [int(v) for v in rng.integers(0, 2, 150)]
        rows += [(g, a, b) for a, b in zip(s, y)]
        yhat = [a >= 0.5 for a in s]
        want[g] = (_brute_roc(s, y), _brute_pr(s, y), sum(h and b for h, b in zip(yhat, y)),
                   sum(not h and not b for h, b in zip(yhat, y)), np.mean([h == bool(b) for h, b in zip(yhat, y)]))
    df = spark.createDataFrame(rows, "model_order int, score double, label int")
    got = {r["model_order"]: r for r in MT.evaluate_groups(df, "model_order").collect()}
    for g, (roc, pr, tp, tn, acc) in want.items():
        assert got[g]["roc_auc"] == pytest.approx(roc) and got[g]["pr_auc"] == pytest.approx(pr)
        assert (got[g]["tp"], got[g]["tn"]) == (tp, tn) and got[g]["accuracy"] == pytest.approx(acc)
    one = df.where("model_order = 1")
    assert MT.roc_auc(one).first()[0] == pytest.approx(got[1]["roc_auc"])


def _edited(row, sla, use, nps):
    """The scenario edits, one client at a time."""
    r = dict(row)
    r["sla_breach_rate"] *= 1 - sla / 100
    r["escalated_ticket_count"] = float(np.round(r["escalated_ticket_count"] * (1 - sla / 100)))  # half to even
    r["product_usage_score"] = float(np.clip(r["product_usage_score"] * (1 + use / 100), 0, 100))
    r["nps_score"] = float(np.clip(r["nps_score"] + nps, -100, 100))
    for c in ("total_usage", "usage_infra", "usage_cloud", "usage_security"):
        r[c] *= 1 + use / 100
    if use >= 10 or sla >= 10:
        if r["usage_trend_3mo"] < 1:
            r["usage_trend_3mo"] *= 1.10
        if r["usage_trend_3mo"] > 0.95:
            r["is_declining_engagement_flag"] = 0.0
    return r


def test_what_if_through_a_saved_pipeline(spark, tmp_path):
    rng = np.random.default_rng(8)
    n = 200
    data = {c: rng.random(n) for c in FEATURES}
    data["escalated_ticket_count"] = rng.integers(0, 8, n).astype(float)
    data["product_usage_score"] = rng.uniform(40, 100, n)
    data["nps_score"] = rng.integers(-100, 101, n).astype(float)
    data["usage_trend_3mo"] = rng.uniform(0.5, 1.5, n)
    data["is_declining_engagement_flag"] = rng.integers(0, 2, n).astype(float)
    mrr = rng.uniform(100, 900, n)
    label = (data["sla_breach_rate"] + rng.random(n) > 1).astype(int)
    rows = [(i, float(mrr[i]), int(label[i]), *(float(data[c][i]) for c in FEATURES)) for i in range(n)]
    df = spark.createDataFrame(rows, "client_id long, monthly_recurring_revenue double, target_churn_3m int, "
                               + ", ".join(f"{c} double" for c in FEATURES))
    fitted = MD.pipeline(FEATURES, LogisticRegression(featuresCol="scaled", labelCol="target_churn_3m",
                                                      regParam=0.01)).fit(df)
    MD.save(fitted, f"{tmp_path}/pipeline")
    pipe = MD.load(f"{tmp_path}/pipeline")
    base = MD.score(pipe, df, FEATURES, "base_p")
    out = {r["scenario"]: r for r in DE.what_if_summary(
        MD.score(pipe, DE.apply_scenarios(base), FEATURES, "mod_p")).collect()}
    scaler, model = pipe.stages[1], pipe.stages[2]
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    w, b = model.coefficients.toArray(), model.intercept

    def p(r):
        x = (np.array([r[c] for c in FEATURES]) - mean) / std
        return 1 / (1 + np.exp(-(x @ w + b)))

    clients = [{c: float(data[c][i]) for c in FEATURES} for i in range(n)]
    before = np.array([p(r) for r in clients])
    assert len(out) == len(DE.SCENARIOS)
    for name, sla, use, nps in DE.SCENARIOS:
        after = np.array([p(_edited(r, sla, use, nps)) for r in clients])
        r = out[name]
        assert r["num_active_clients"] == n
        assert r["base_avg_prob"] == pytest.approx(before.mean()) and r["mod_avg_prob"] == pytest.approx(after.mean())
        assert r["mod_expected_mrr_loss"] == pytest.approx((mrr * after).sum())
        assert r["mod_at_risk_count"] == (after >= 0.5).sum()


def test_business_labels(spark):
    assert MD.business_label("industry_Retail") == "Industry: Retail"
    assert MD.business_label("region_West") == "Region: West"
    assert MD.business_label("nps_score") == "NPS Score" and MD.business_label("x") == "x"


def test_hot_client_join_is_the_plain_join(spark):
    from churnlens.operators import impute as IM
    tx = spark.createDataFrame([(k, 7 if k % 3 else k, "invoice", None if k % 2 else 5.0) for k in range(300)],
                               "transaction_id long, client_id long, transaction_type string, amount double")
    clients = spark.range(0, 300, 2).select(F.col("id").alias("client_id"), (F.col("id") + 0.5).alias(
        "monthly_recurring_revenue")).unionByName(spark.createDataFrame([(7, 70.0)], "client_id long, "
                                                                        "monthly_recurring_revenue double"))
    got = {r["transaction_id"]: r["amount"] for r in IM.impute_amounts(tx, clients).collect()}
    mrr = {r[0]: r[1] for r in clients.collect()}
    assert len(got) == 300
    for r in tx.collect():
        assert got[r[0]] == (5.0 if r[3] is not None else mrr.get(r[1]))


def test_population_scaling_and_both_balances(spark):
    """The saved scaling is the population's, and weights and synthetic rows give models that agree."""
    from churnlens.operators import smote as SM
    rng = np.random.default_rng(4)
    a, b = rng.normal(10, 4, 400), rng.normal(-3, 2, 400)
    y = (rng.random(400) < 1 / (1 + np.exp(4 - (a - 10) / 2 + (b + 3)))).astype(int)
    rows = [(i, "2020-01", float(a[i]), float(b[i]), int(y[i]), "train" if i < 300 else "test") for i in range(400)]
    df = spark.createDataFrame(rows, "client_id long, year_month string, a double, b double, target_churn_3m int, split string")
    train = df.where("split = 'train'")
    grid = SM.on_grid(train, SM.scaling(train, ["a", "b"]))
    keys = ["client_id", "year_month"]
    more = SM.balanced(grid, SM.nearest(grid.where("target_churn_3m = 1"), keys), ["a", "b"], keys, "target_churn_3m")
    name = "Logistic Regression"
    weighed = MD.fit_models(df, ["a", "b"], [name])[name]
    added = MD.fit_models(df, ["a", "b"], [name], smote=more)[name]
    p = [np.array([r.p for r in MD.score(m, df, ["a", "b"], "p").orderBy("client_id").collect()]) for m in (weighed, added)]
    w, c = weighed.stages[-1].coefficients.toArray(), weighed.stages[-1].intercept
    z = np.stack([(v - v[:300].mean()) / v[:300].std() for v in (a, b)], axis=1)
    assert np.allclose(p[0], 1 / (1 + np.exp(-(z @ w + c))), atol=1e-5)
    assert np.corrcoef(*p)[0, 1] > 0.98 and abs(p[0] - p[1]).mean() < 0.1


def test_forest_is_fitted_after_the_others_on_rows_not_held(spark, monkeypatch):
    """The fits hold their own copies of the rows: no third copy lies beside them, nor the forest's beside the others."""
    events = []

    class Fit:
        def __init__(self, name):
            self.name = name

        def fit(self, rows):
            events.append(("begin", self.name, rows.is_cached))
            rows.count()
            events.append(("end", self.name, rows.is_cached))
            return self.name

    monkeypatch.setattr(MD, "_estimators", lambda n: {m: Fit(m) for m in MD.MODEL_ORDER})
    df = spark.createDataFrame([(float(i), i % 2, "train") for i in range(20)], "a double, target_churn_3m int, split string")
    fitted = MD.fit_models(df, ["a"])
    assert list(fitted) == MD.MODEL_ORDER and [m.stages[-1] for m in fitted.values()] == MD.MODEL_ORDER
    assert [(what, name) for what, name, _ in events[-2:]] == [("begin", "Random Forest"), ("end", "Random Forest")]
    assert not any(held for _, _, held in events)
