"""Decision and reporting operators.

Row loops of the reference (rule chain, membership tests, what-if edits)
become column expressions evaluated by the executors; the priority order of
the recommendation list is a distributed running count, not a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from .ordering import descending, prefix_sums

P = "predicted_churn_probability"

# ---------------------------------------------------------------------------
# Rule thresholds, texts and constants of the reference
# ---------------------------------------------------------------------------
SLA_LIMIT = 0.15
USAGE_FLOOR = 300.0
LATE_LIMIT = 0.25
NPS_FLOOR = 0
TARGET_PROBABILITY = 0.30
MITIGATION = 0.60
TARGET_RELATIVE_REDUCTION = 0.05
AT_RISK_PROBABILITY = 0.5
ISSUE_SLA = "High SLA Breach Rate"
ISSUE_USAGE = "Low Product Usage Score"
ISSUE_LATE = "Chronic Late Payments"
ISSUE_NPS = "Detractor NPS Score"
ISSUE_DEFAULT = "Declining Engagement"
ISSUE_NO_FEATURES = "High Score Profile"
ACTION_SLA = ("Schedule immediate technical service review with operations to address SLA "
              "breaches ({rate} escalated support tickets).")
ACTION_USAGE = ("Initiate user enablement training session. Product usage has dropped below "
                "active benchmarks.")
ACTION_LATE = ("Contact client accounts payable to transition from {contract} invoicing to "
               "auto-pay or offer a 2% discount for annual contract conversion.")
ACTION_NPS = ("Account Manager {manager} to conduct direct executive check-in. NPS is currently "
              "in detractor zone ({nps}).")
ACTION_DEFAULT = ("Proactive account management review. Schedule quarterly business review "
                  "(QBR) to pitch a migration or upgrade path.")
ACTION_NO_FEATURES = "Executive check-in to secure contract renewal."
LEDGER_NAMES = {
    "client_id": "Client ID", "client_name": "Client Name", "account_manager": "Account Manager",
    "contract_type": "Contract Type", "monthly_recurring_revenue": "MRR ($)",
    P: "Churn Probability", "risk_tier": "Risk Tier",
}
ALERT_NAMES = {
    "priority": "Priority", "client_id": "Client ID", "client_name": "Client Name",
    "predicted_probability": "Churn Prob", "risk_tier": "Risk Tier",
    "account_manager": "Account Manager", "primary_issue": "Identified Trigger",
    "action_item": "Recommended Retention Action",
}
FORECAST_NAMES = {
    "year_month": "Month", "baseline_forecast": "Baseline ($)", "ci_lower": "Lower CI ($)",
    "ci_upper": "Upper CI ($)", "churn_adjusted_forecast": "Churn-Adjusted ($)",
    "expected_mrr_loss": "Expected Loss ($)",
}


def latest_per_client(df: DataFrame, key: str = "client_id",
                      order: str = "year_month") -> DataFrame:
    """The latest row per client.

    A row_number window over the client partitioning; on the model-ready table
    the rows are already partitioned by client, so this adds a sort but no
    shuffle, and Spark pushes the rank-1 limit below the window.
    """
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def risk_ranking(scored_latest: DataFrame, clients: DataFrame) -> DataFrame:
    """M13 tail: clients (all of them, J4 left join) with their latest score,
    tier (F10), sorted by probability descending, NULLs last, then client id."""
    s = scored_latest.select("client_id", P)
    r = clients.select("client_id", "client_name", "account_manager",
                       "monthly_recurring_revenue", "contract_type", "is_churned").join(
        s, "client_id", "left")
    return (r.withColumn("risk_tier", X.risk_tier(P))
            .orderBy(F.desc_nulls_last(P), "client_id"))


def tier_counts(ranking: DataFrame) -> DataFrame:
    """Clients per (churn status, tier)."""
    return ranking.groupBy("is_churned", "risk_tier").agg(F.count(F.lit(1)).alias("clients"))


def _action(issue: Column) -> Column:
    rate = X.fmt_percent("sla_breach_rate")
    return (F.when(issue == ISSUE_SLA,
                   F.concat(F.lit(ACTION_SLA.split("{rate}")[0]), rate,
                            F.lit(ACTION_SLA.split("{rate}")[1])))
            .when(issue == ISSUE_USAGE, F.lit(ACTION_USAGE))
            .when(issue == ISSUE_LATE,
                  F.concat(F.lit(ACTION_LATE.split("{contract}")[0]), F.col("contract_type"),
                           F.lit(ACTION_LATE.split("{contract}")[1])))
            .when(issue == ISSUE_NPS,
                  F.concat(F.lit(ACTION_NPS.split("{manager}")[0]), F.col("account_manager"),
                           F.lit(ACTION_NPS.split("{manager}")[1].split("{nps}")[0]),
                           F.col("nps_score").cast("string"),
                           F.lit(ACTION_NPS.split("{nps}")[1])))
            .when(issue == ISSUE_DEFAULT, F.lit(ACTION_DEFAULT))
            .otherwise(F.lit(ACTION_NO_FEATURES)))


def recommendations(ranking: DataFrame, latest_features: DataFrame,
                    usage_floor: float = USAGE_FLOOR,
                    threshold: float = TARGET_PROBABILITY) -> DataFrame:
    """Active clients with p >= threshold, first matching rule wins, a
    priority (1 = highest probability, ties by client id) and the expected
    revenue saved (MRR x p)."""
    feats = latest_features.select(
        "client_id", "sla_breach_rate", "total_usage", "late_payment_rate", "nps_score",
        F.lit(True).alias("_has"))
    r = (ranking.where(~F.col("is_churned") & (F.col(P) >= threshold))
         .join(feats, "client_id", "left"))
    issue = (F.when(F.col("_has").isNull(), ISSUE_NO_FEATURES)
             .when(F.col("sla_breach_rate") > SLA_LIMIT, ISSUE_SLA)
             .when(F.col("total_usage") < usage_floor, ISSUE_USAGE)
             .when(F.col("late_payment_rate") > LATE_LIMIT, ISSUE_LATE)
             .when(F.col("nps_score") < NPS_FLOOR, ISSUE_NPS)
             .otherwise(ISSUE_DEFAULT))
    r = r.withColumn("primary_issue", issue).withColumn("action_item", _action(F.col("primary_issue")))
    ranked = prefix_sums(r, [descending(P), F.col("client_id")], {}, "priority")
    return ranked.select(
        "priority", "client_id", "client_name", F.col(P).alias("predicted_probability"),
        "risk_tier", "monthly_recurring_revenue", "account_manager", "contract_type",
        "primary_issue", "action_item",
        (F.col("monthly_recurring_revenue") * F.col(P)).alias("expected_revenue_saved"))


def retention_impact(ranking: DataFrame, threshold: float = TARGET_PROBABILITY,
                     mitigation: float = MITIGATION,
                     target: float = TARGET_RELATIVE_REDUCTION) -> DataFrame:
    """R4 in one aggregate over the active clients.  A targeted client is an
    active one with p >= threshold (the recommendation set, J6)."""
    active = ranking.where(~F.col("is_churned"))
    hit = F.col(P) >= threshold
    new_p = F.when(hit, F.col(P) * (1.0 - mitigation)).otherwise(F.col(P))
    a = active.agg(
        F.count_if(hit).alias("total_clients_targeted"),
        F.sum(F.when(hit, F.col("monthly_recurring_revenue"))).alias("_mrr"),
        F.sum(F.when(hit, F.col("monthly_recurring_revenue") * F.col(P))).alias("_saved"),
        F.avg(P).alias("_base"), F.avg(new_p).alias("_new"))
    rel = F.when(F.col("_base") > 0, (F.col("_base") - F.col("_new")) / F.col("_base")).otherwise(
        F.lit(0.0))
    return a.select(
        "total_clients_targeted",
        F.coalesce(F.col("_mrr"), F.lit(0.0)).alias("total_mrr_at_risk"),
        (F.coalesce(F.col("_saved"), F.lit(0.0)) * mitigation).alias("projected_mrr_saved"),
        (F.col("_base") * 100).alias("baseline_churn_rate"),
        (F.col("_new") * 100).alias("new_churn_rate"),
        ((F.col("_base") - F.col("_new")) * 100).alias("absolute_churn_reduction"),
        (rel * 100).alias("relative_churn_reduction"),
        (rel >= target).alias("target_achieved"))


def kpi_block(ranking: DataFrame, forecast: DataFrame | None = None) -> DataFrame:
    """Executive KPIs in one aggregate (A10-A12, A15); with a churn-adjusted
    forecast of one series, also the next-12-month revenue (T12)."""
    out = _kpis(ranking)
    if forecast is None:
        return out
    nxt = forecast.agg(F.sum("churn_adjusted_forecast").alias("next_12m_revenue"))
    # two one-row aggregates side by side
    return (out.withColumn("_one", F.lit(1))
            .join(F.broadcast(nxt.withColumn("_one", F.lit(1))), "_one").drop("_one"))


def _kpis(ranking: DataFrame) -> DataFrame:
    act = ~F.col("is_churned")
    mrr, p = F.col("monthly_recurring_revenue"), F.col(P)
    a = ranking.agg(
        F.count(F.lit(1)).alias("total_clients"),
        F.count_if(act).alias("active_clients"),
        F.avg(F.when(act, p)).alias("_risk"),
        F.sum(F.when(act, mrr)).alias("total_active_mrr"),
        F.sum(F.when(act, mrr * p)).alias("mrr_at_risk"),
        F.count_if(act & (F.col("risk_tier") == "High")).alias("high_risk_clients"),
        F.count_if(act & (F.col("risk_tier") == "Medium")).alias("medium_risk_clients"),
        F.count_if(act & (F.col("risk_tier") == "Low")).alias("low_risk_clients"))
    return a.select(
        "total_clients", "active_clients",
        (F.col("total_clients") - F.col("active_clients")).alias("historical_churned"),
        (F.try_divide(F.col("total_clients") - F.col("active_clients"), F.col("total_clients"))
         * 100).alias("historical_churn_pct"),
        (F.col("_risk") * 100).alias("active_avg_risk_pct"),
        "total_active_mrr", "mrr_at_risk",
        (F.try_divide(F.col("mrr_at_risk"), F.col("total_active_mrr")) * 100)
        .alias("mrr_at_risk_pct"),
        "high_risk_clients", "medium_risk_clients", "low_risk_clients")


def risk_ledger(ranking: DataFrame, search: str | None = None,
                tiers: Sequence[str] = (), managers: Sequence[str] = ()) -> DataFrame:
    """R7 (P11, P12, F16, P3): active clients, optional case-insensitive regex
    search over name and id, tier and manager filters (empty = no filter),
    formatted for display."""
    df = ranking.where(~F.col("is_churned"))
    if search:
        pat = "(?i)" + search
        df = df.where(F.col("client_name").rlike(pat)
                      | F.col("client_id").cast("string").rlike(pat))
    if tiers:
        df = df.where(F.col("risk_tier").isin(list(tiers)))
    if managers:
        df = df.where(F.col("account_manager").isin(list(managers)))
    out = df.select(
        "client_id", "client_name", "account_manager", "contract_type",
        X.fmt_currency("monthly_recurring_revenue").alias("monthly_recurring_revenue"),
        X.fmt_percent(P).alias(P), "risk_tier")
    return out.withColumnsRenamed(LEDGER_NAMES)


def alert_table(recs: DataFrame, top: int | None = None) -> DataFrame:
    """The alert list formatted for display; ``top`` keeps the first cards
    (K5: a top-N is the feature here)."""
    df = recs
    if top is not None:
        df = df.where(F.col("priority") <= top)
    out = df.select("priority", "client_id", "client_name",
                    X.fmt_percent("predicted_probability").alias("predicted_probability"),
                    "risk_tier", "account_manager", "primary_issue", "action_item")
    return out.withColumnsRenamed(ALERT_NAMES)


def format_forecast(forecast: DataFrame) -> DataFrame:
    """Currency-formatted forecast table."""
    money = ["baseline_forecast", "ci_lower", "ci_upper", "churn_adjusted_forecast",
             "expected_mrr_loss"]
    keys = [c for c in ("series_id", "year_month") if c in forecast.columns]
    out = forecast.select(*keys, *[X.fmt_currency(c).alias(c) for c in money])
    return out.withColumnsRenamed(FORECAST_NAMES)


# ---------------------------------------------------------------------------
# What-if scoring
# ---------------------------------------------------------------------------
SCENARIOS = [
    # name, SLA reduction %, usage increase %, NPS points
    ("baseline", 0.0, 0.0, 0),
    ("sla_minus_25", 25.0, 0.0, 0),
    ("usage_plus_20", 0.0, 20.0, 0),
    ("nps_plus_15", 0.0, 0.0, 15),
    ("combined", 25.0, 20.0, 15),
    ("light_touch", 5.0, 5.0, 5),
]
USAGE_FIELDS = ["total_usage", "usage_infra", "usage_cloud", "usage_security"]


def latest_active(model_ready: DataFrame, clients: DataFrame) -> DataFrame:
    """Latest row of each active client with MRR and usage score."""
    active = clients.where(~F.col("is_churned")).select(
        "client_id", "monthly_recurring_revenue", "product_usage_score")
    rows = model_ready.join(active, "client_id", "inner")   # semi join + lookup in one
    return latest_per_client(rows)


def apply_scenarios(df: DataFrame, scenarios=SCENARIOS) -> DataFrame:
    """Fan each row out once per scenario (a fixed, small factor) and apply the
    edits in the reference's order: SLA, usage, NPS, then trend and flag."""
    lit_rows = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(float(s)).alias("sla_pct"),
                                  F.lit(float(u)).alias("usage_pct"),
                                  F.lit(int(p)).alias("nps_points"))
                         for n, s, u, p in scenarios])
    d = df.withColumn("_sc", F.explode(lit_rows)).select("*", "_sc.*").drop("_sc")
    sla = F.lit(1.0) - F.col("sla_pct") / 100.0
    use = F.lit(1.0) + F.col("usage_pct") / 100.0
    d = d.withColumns({
        "sla_breach_rate": F.col("sla_breach_rate") * sla,
        "escalated_ticket_count": X.round_half_even(F.col("escalated_ticket_count") * sla),
        "product_usage_score": X.clip(F.col("product_usage_score") * use, 0, 100),
        "nps_score": X.clip(F.col("nps_score") + F.col("nps_points"), -100, 100),
        **{c: F.col(c) * use for c in USAGE_FIELDS},
    })
    strong = (F.col("usage_pct") >= 10.0) | (F.col("sla_pct") >= 10.0)
    d = d.withColumn("usage_trend_3mo",
                     F.when(strong & (F.col("usage_trend_3mo") < 1.0),
                            F.col("usage_trend_3mo") * 1.10).otherwise(F.col("usage_trend_3mo")))
    return d.withColumn("is_declining_engagement_flag",
                        F.when(strong & (F.col("usage_trend_3mo") > 0.95), F.lit(0))
                        .otherwise(F.col("is_declining_engagement_flag")))


def what_if_summary(j: DataFrame,
                    target: float = TARGET_RELATIVE_REDUCTION) -> DataFrame:
    """Aggregate per scenario (A11-A13) and the R8 progress figures.

    ``j``: one row per (scenario, client) with the client's MRR, ``base_p`` (scored before
    the scenarios fanned the rows out) and ``mod_p``."""
    mrr = F.col("monthly_recurring_revenue")
    a = j.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("num_active_clients"),
        F.avg("base_p").alias("base_avg_prob"), F.avg("mod_p").alias("mod_avg_prob"),
        F.sum(mrr * F.col("base_p")).alias("base_expected_mrr_loss"),
        F.sum(mrr * F.col("mod_p")).alias("mod_expected_mrr_loss"),
        F.count_if(F.col("base_p") >= AT_RISK_PROBABILITY).alias("base_at_risk_count"),
        F.count_if(F.col("mod_p") >= AT_RISK_PROBABILITY).alias("mod_at_risk_count"))
    rel = F.when(F.col("base_avg_prob") > 0,
                 (F.col("base_avg_prob") - F.col("mod_avg_prob")) / F.col("base_avg_prob") * 100
                 ).otherwise(F.lit(0.0))
    return a.select(
        "scenario", "num_active_clients", "base_avg_prob", "mod_avg_prob",
        ((F.col("base_avg_prob") - F.col("mod_avg_prob")) * 100).alias("churn_rate_reduction_pct"),
        "base_expected_mrr_loss", "mod_expected_mrr_loss",
        (F.col("base_expected_mrr_loss") - F.col("mod_expected_mrr_loss")).alias("mrr_retained"),
        "base_at_risk_count", "mod_at_risk_count",
        rel.alias("relative_reduction_pct"),
        X.clip(rel / (target * 100), 0.0, 1.0).alias("target_progress"),
        ((F.col("base_expected_mrr_loss") - F.col("mod_expected_mrr_loss")) * 12)
        .alias("annual_mrr_retained"))
