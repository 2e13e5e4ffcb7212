"""Hand-made frames for the semantic traps (empty-ish input, zero
denominators, gaps, ties, unknown clients, NULL keys)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnlens.functions import expr as X
from churnlens.operators import decisions as DE
from churnlens.operators import features as FE
from churnlens.operators import impute as IM
from churnlens.operators import labels as LB
from churnlens.operators import metrics as MT
from churnlens.operators import panel as PA
from churnlens.operators import profile as PR
from churnlens.operators.ordering import exact_median, exact_quantiles

D = dt.date


def panel_rows(spark, rows):
    """rows: (client, ym, invoiced, usage, late, pays, esc, tickets, upgrade)."""
    schema = ("client_id long, year_month string, invoiced_amt double, total_usage double, "
              "late_pay_count long, total_pay_count long, escalated_ticket_count long, "
              "ticket_count long, upgrade_amt double")
    return spark.createDataFrame(rows, schema).withColumn("churn_date", F.lit(None).cast("date"))


def test_even_count_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert exact_median(df, "x") == 2.5


def test_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float(v) for v in np.random.default_rng(7).integers(0, 50, 301)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)], "x double, g int")
    q = exact_quantiles(df, "x", {"q1": .25, "q3": .75}, ["g"])
    got = {r["g"]: r for r in q.collect()}
    for g in range(3):
        sub = np.array(vals[g::3])
        assert got[g]["n"] == len(sub)
        assert got[g]["q1"] == pytest.approx(np.percentile(sub, 25))
        assert got[g]["q3"] == pytest.approx(np.percentile(sub, 75))


def test_quantiles_of_distinct_tied_and_infinite_values(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    n = 60_000
    cases = {"distinct": rng.permutation(n) * 1.5 - 3000,
             "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(7, 3, n)),
             "one": np.full(n, 2.0)}
    rows = spark.createDataFrame([(g, float(v)) for g, vs in cases.items() for v in vs]
                                 + [("inf", float("inf")), ("inf", 1.0), ("inf", 2.0), ("nan", float("nan")),
                                    ("null", None)], "g string, x double").repartition(5)
    probs = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p50b": 0.50005, "p99": 0.99, "p100": 1.0}
    for few in (True, False):
        got = {r["g"]: r for r in exact_quantiles(rows, "x", probs, ["g"], few).collect()}
        assert set(got) == {*cases, "inf"}
        assert (got["inf"]["n"], got["inf"]["p50"]) == (3, 2.0)
        for g, vs in cases.items():
            assert got[g]["n"] == n
            for name, q in probs.items():
                assert got[g][name] == pytest.approx(np.quantile(vs, q), rel=1e-12), (g, name, few)


def test_zero_denominators_and_short_history(spark):
    rows = [(1, f"2024-0{m}", 0.0, 0.0, 0, 0, 0, 0, 0.0) for m in range(1, 5)]
    out = FE.rate_features(FE.trend_features(panel_rows(spark, rows))).collect()
    assert all(r["revenue_trend_3mo"] == 1.0 and r["usage_trend_3mo"] == 1.0 for r in out)
    assert all(r["late_payment_rate"] == 0.0 and r["sla_breach_rate"] == 0.0 for r in out)


def test_month_gap_frames_count_rows(spark):
    months = ["2024-01", "2024-02", "2024-05", "2024-06"]
    rows = [(1, m, 0.0, 0.0, 1, 1, 0, 0, 0.0) for m in months]
    rows[0] = (1, "2024-01", 0.0, 0.0, 1, 4, 0, 0, 0.0)
    out = {r["year_month"]: r for r in FE.rate_features(panel_rows(spark, rows)).collect()}
    # 2024-05 looks back two *rows* (01, 02), not two calendar months
    assert out["2024-05"]["late_payment_rate"] == pytest.approx(3 / 6)


def test_upgrade_islands(spark):
    ups = [0, 0, 10, 0, 10, 0]
    rows = [(1, f"2024-0{m + 1}", 0.0, 0.0, 0, 0, 0, 0, float(u)) for m, u in enumerate(ups)]
    out = FE.months_since_upgrade(panel_rows(spark, rows)).orderBy("year_month").collect()
    assert [r["months_since_last_upgrade"] for r in out] == [0, 1, 0, 1, 0, 1]


def test_churn_month_kept_next_dropped(spark):
    df = spark.createDataFrame([("2026-01", D(2026, 1, 20)), ("2026-02", D(2026, 1, 20))],
                               "year_month string, churn_date date")
    assert [r[0] for r in FE.truncate_after_churn(df).collect()] == ["2026-01"]


def test_label_edges(spark):
    rows = [("2024-01", True, D(2024, 1, 5)), ("2024-01", True, D(2024, 4, 1)),
            ("2024-01", True, D(2024, 5, 1)), ("2024-01", False, None)]
    df = spark.createDataFrame(rows, "year_month string, is_churned boolean, churn_date date")
    assert [r["target_churn_3m"] for r in LB.churn_label(df).collect()] == [1, 1, 0, 0]


TX = ("transaction_id string, client_id long, transaction_date date, transaction_type string, "
      "amount double, service_line string, payment_status string, usage_units double, "
      "notes_flag int")


def test_null_amount_fill(spark):
    d = D(2024, 1, 3)
    tx = spark.createDataFrame([
        ("a", 1, d, "invoice", None, None, None, None, 0),
        ("b", 1, d, "payment", None, None, "late", None, 0),
        ("c", 1, d, "service-upgrade", None, "Cloud", None, None, 0),
        ("d", 1, d, "service-downgrade", None, "Cloud", None, None, 0),
        ("e", 1, d, "support-ticket", None, "Cloud", None, None, 1),
        ("f", 9, d, "invoice", None, None, None, None, 0),
    ], TX)
    clients = spark.createDataFrame([(1, 100.0)], "client_id long, monthly_recurring_revenue double")
    filled = {r["transaction_id"]: r["amount"] for r in IM.impute_amounts(tx, clients).collect()}
    assert filled == {"a": 100.0, "b": 100.0, "c": 1500.0, "d": 1500.0, "e": None, "f": None}
    p = {r["client_id"]: r for r in PA.client_month_panel(tx, clients).collect()}
    assert p[1]["invoiced_amt"] == 100.0 and p[1]["paid_amt"] == 100.0
    assert p[1]["upgrade_amt"] == 1500.0 and p[1]["downgrade_amt"] == 1500.0
    assert p[1]["ticket_count"] == 1 and p[1]["escalated_ticket_count"] == 1
    assert p[1]["late_pay_count"] == 1 and p[1]["total_pay_count"] == 1
    assert p[9]["invoiced_amt"] == 0.0          # unknown client: nothing to fill with


def test_kindless_month_and_null_key(spark):
    tx = spark.createDataFrame([
        ("a", 1, D(2024, 1, 3), "mystery", 5.0, None, None, None, 0),
        ("b", None, D(2024, 2, 3), "invoice", 5.0, None, None, None, 0),
        ("c", 1, D(2024, 3, 3), "invoice", 5.0, None, None, None, 0),
    ], TX)
    rows = PA.client_month_panel(tx).collect()
    assert [(r["client_id"], r["year_month"]) for r in rows] == [(1, "2024-03")]


def test_tenure_and_tier_edges(spark):
    df = spark.createDataFrame([(0,), (6,), (7,), (48,), (49,)], "t int")
    assert [r[0] for r in df.select(X.tenure_bin("t")).collect()] == [
        None, "0-6m", "6-12m", "30m+", None]
    p = spark.createDataFrame([(0.70,), (0.30,), (0.2999,), (None,)], "p double")
    assert [r[0] for r in p.select(X.risk_tier("p")).collect()] == ["High", "Medium", "Low", None]


def test_gini_fixture(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 2.0)],
                               "client_id long, monthly_recurring_revenue double")
    lor = PR.lorenz_curve(df)
    ys = [r["cum_revenue_share"] for r in lor.orderBy("pos").collect()]
    assert ys == pytest.approx([0.25, 0.5, 1.0])
    assert PR.gini_top_decile(lor).first()["gini"] == pytest.approx(0.25)


def test_pr_auc_tie(spark):
    df = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.3, 0)], "score double, label int")
    assert MT.pr_auc(df).first()["pr_auc"] == pytest.approx(0.75)
    assert MT.roc_auc(df).first()["roc_auc"] == pytest.approx(0.75)


def test_probability_ties_order_by_client(spark):
    clients = spark.createDataFrame(
        [(3, "c", "m", 1.0, "Annual", False), (1, "a", "m", 1.0, "Annual", False),
         (2, "b", "m", 1.0, "Annual", False)],
        "client_id long, client_name string, account_manager string, "
        "monthly_recurring_revenue double, contract_type string, is_churned boolean")
    scored = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, 0.9)],
                                   "client_id long, predicted_churn_probability double")
    order = [r["client_id"] for r in DE.risk_ranking(scored, clients).collect()]
    assert order == [3, 1, 2]


def test_nothing_missing_is_noop(spark):
    df = spark.createDataFrame([(1, "Small", "Cloud", "X", 5.0)],
                               "client_id long, client_size string, services_subscribed string, "
                               "industry string, monthly_recurring_revenue double")
    assert IM.impute_mrr_ols(df, ["Y"]).collect() == df.collect()


def test_rule_overlap_sla_wins(spark):
    ranking = spark.createDataFrame(
        [(1, "a", "Mgr", 100.0, "Annual", False, 0.5, "Medium")],
        "client_id long, client_name string, account_manager string, "
        "monthly_recurring_revenue double, contract_type string, is_churned boolean, "
        "predicted_churn_probability double, risk_tier string")
    feats = spark.createDataFrame([(1, 0.2, 500.0, 0.0, -5)],
                                  "client_id long, sla_breach_rate double, total_usage double, "
                                  "late_payment_rate double, nps_score int")
    r = DE.recommendations(ranking, feats).first()
    assert r["primary_issue"] == DE.ISSUE_SLA and "(20.0% escalated" in r["action_item"]
    assert r["priority"] == 1 and r["expected_revenue_saved"] == pytest.approx(50.0)


def test_zero_baseline_relative_reduction(spark):
    ranking = spark.createDataFrame([(1, False, 0.0, 10.0), (2, False, 0.0, 20.0)],
                                    "client_id long, is_churned boolean, "
                                    "predicted_churn_probability double, "
                                    "monthly_recurring_revenue double")
    r = DE.retention_impact(ranking).first()
    assert r["relative_churn_reduction"] == 0.0 and r["target_achieved"] is False


def test_kpi_block_with_forecast(spark):
    ranking = spark.createDataFrame(
        [(1, False, 0.5, 100.0, "Medium"), (2, False, 0.1, 300.0, "Low"),
         (3, True, 0.9, 50.0, "High")],
        "client_id long, is_churned boolean, predicted_churn_probability double, "
        "monthly_recurring_revenue double, risk_tier string")
    fc = spark.createDataFrame([(1000.0,), (900.0,)], "churn_adjusted_forecast double")
    r = DE.kpi_block(ranking, fc).first()
    assert (r["total_clients"], r["active_clients"], r["historical_churned"]) == (3, 2, 1)
    assert r["total_active_mrr"] == 400.0 and r["mrr_at_risk"] == pytest.approx(80.0)
    assert r["mrr_at_risk_pct"] == pytest.approx(20.0)
    assert (r["medium_risk_clients"], r["low_risk_clients"], r["high_risk_clients"]) == (1, 1, 0)
    assert r["next_12m_revenue"] == 1900.0
