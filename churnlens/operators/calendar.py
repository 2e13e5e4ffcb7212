"""Client rules and billing calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X


def client_rules(clients: DataFrame, window_start: str, window_end: str) -> DataFrame:
    """F19-F23 per client: padded code, service list, contract value, rule risk score, active
    period and months active.  A start after the end moves back to 30 days before the end; a
    client without a start has no active period."""
    start = F.when(F.col("contract_start_date").isNotNull(),
                   F.greatest(F.col("contract_start_date"), F.lit(window_start).cast("date")))
    end = F.coalesce(F.col("churn_date"), F.lit(window_end).cast("date"))
    start = F.when(start > end, F.date_sub(end, 30)).otherwise(start)
    return clients.select(
        "client_id", X.padded_id("CL-", "client_id").alias("client_code"), "contract_type",
        "services_subscribed",
        X.join_list(F.array_sort(F.split("services_subscribed", ";")), ", ").alias("service_list"),
        "contract_value",
        X.rule_risk_score("contract_type", "services_subscribed").alias("rule_risk_score"),
        X.tenure_months("contract_start_date", "churn_date", window_end).alias("tenure_months"),
        start.alias("active_start"), end.alias("active_end"),
        (X.month_diff(end, start) + 1).alias("months_active"))


def billing_calendar(rules: DataFrame) -> DataFrame:
    """one row per client and active month (first day of the month)."""
    return rules.where(F.col("active_start").isNotNull()).select(
        "client_id",
        F.explode(F.sequence(F.trunc("active_start", "MM"), F.col("active_end"),
                             F.expr("interval 1 month"))).alias("billing_month"))


def top_k_by(df: DataFrame, score: str, k: int, key: str = "client_id") -> DataFrame:
    """K9: the k highest scores (ties by key): each task keeps its k best rows, and the window
    numbers the k that remain."""
    best = df.orderBy(F.desc(score), key).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), key)).cast("long"))
