"""Trailing-window features and the model-ready table.

Frames count panel rows, not calendar months (a client with a missing month
has a wider calendar frame), exactly as the reference's shift/rolling does.

The churn truncation (keep months up to the churn month) is applied *before*
the windows: it keeps a prefix of each client's months and every frame looks
backward, so the surviving rows see the same frames.  Catalyst would not push
an order-key filter below a Window by itself.

All windows are partitioned by client: after the panel join the rows are
already hash-partitioned on client_id, so the windows add a sort, no shuffle.
A client has at most one row per month, so window partitions stay small even
for a client that owns a large share of the transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from .panel import KEYS, PANEL_COLUMNS, client_month_panel

# Names and order of the reference's columns
STATIC_COLUMNS = [
    "client_name", "industry", "client_size", "contract_start_date", "contract_type",
    "account_manager", "region", "nps_score", "is_churned", "churn_date", "tenure_months",
]
FEATURE_COLUMNS = [
    "revenue_trend_3mo", "usage_trend_3mo", "late_payment_rate", "sla_breach_rate",
    "months_since_last_upgrade", "is_declining_engagement_flag", "services_count",
]
MODEL_READY_COLUMNS = KEYS + PANEL_COLUMNS + FEATURE_COLUMNS + STATIC_COLUMNS


def truncate_after_churn(df: DataFrame) -> DataFrame:
    """Keep a month when there is no churn date or it starts on/before it."""
    return df.where(F.col("churn_date").isNull()
                    | (X.month_start("year_month") <= F.col("churn_date")))


def trend_features(df: DataFrame) -> DataFrame:
    """Mean of the previous 3 rows over the mean of rows 4-6 back."""
    w = Window.partitionBy("client_id").orderBy("year_month")
    out = df
    for src, name in (("invoiced_amt", "revenue_trend_3mo"), ("total_usage", "usage_trend_3mo")):
        recent = F.avg(src).over(w.rowsBetween(-3, -1))
        prior = F.avg(src).over(w.rowsBetween(-6, -4))
        out = out.withColumn(name, X.safe_ratio(recent, prior, 1.0))
    return out


def rate_features(df: DataFrame) -> DataFrame:
    """3-row sums including the current row, as rates (0 when undefined)."""
    w = Window.partitionBy("client_id").orderBy("year_month").rowsBetween(-2, 0)
    return (df
            .withColumn("late_payment_rate",
                        X.safe_ratio(F.sum("late_pay_count").over(w),
                                     F.sum("total_pay_count").over(w), 0.0))
            .withColumn("sla_breach_rate",
                        X.safe_ratio(F.sum("escalated_ticket_count").over(w),
                                     F.sum("ticket_count").over(w), 0.0)))


def months_since_upgrade(df: DataFrame) -> DataFrame:
    """Rows since the client's last upgrade month; before the first upgrade, since the first row.
    The last upgrade's row number is a running maximum, so the rows keep the one order of the other windows."""
    w = Window.partitionBy("client_id").orderBy("year_month")
    last = F.max(F.when(F.col("upgrade_amt") > 0, F.col("_row"))).over(
        w.rowsBetween(Window.unboundedPreceding, 0))
    return (df.withColumn("_row", F.row_number().over(w))
            .withColumn("months_since_last_upgrade",
                        (F.col("_row") - F.coalesce(last, F.lit(1))).cast("long"))
            .drop("_row"))


def engineer_features(panel: DataFrame, ticket_ceiling: float = 5,
                      trend_floor: float = 0.90) -> DataFrame:
    """Panel (with ``churn_date`` and ``services_subscribed`` carried) -> features."""
    df = truncate_after_churn(panel)
    df = trend_features(df)
    df = rate_features(df)
    df = months_since_upgrade(df)
    return (df
            .withColumn("is_declining_engagement_flag",
                        X.engagement_flag("usage_trend_3mo", "ticket_count",
                                          trend_floor, ticket_ceiling))
            .withColumn("services_count", X.services_count("services_subscribed")))


def model_ready(transactions: DataFrame, clients: DataFrame, ticket_ceiling: float = 5,
                trend_floor: float = 0.90, updown_fill: float = 1500.0) -> DataFrame:
    """Transactions + clean clients -> the 33-column model-ready table.

    One join with clients serves the MRR fill (I8), the static attributes (J1)
    and the churn truncation (P9).
    """
    panel = client_month_panel(transactions, clients, updown_fill,
                               carry=STATIC_COLUMNS + ["services_subscribed"])
    feats = engineer_features(panel, ticket_ceiling, trend_floor)
    return feats.select(*MODEL_READY_COLUMNS)


def model_ready_from_panel(panel: DataFrame, clients: DataFrame, ticket_ceiling: float = 5,
                           trend_floor: float = 0.90) -> DataFrame:
    """Same result from a panel, materialised or not; a panel that carries ``churn_date`` is not joined for it.

    Only the churn date joins before the windows, so the sort and the window
    buffers carry the narrow numeric panel; the wide static attributes join
    after the windows, onto rows already partitioned by client.  The joins hash the clients' side, so
    the panel is sorted once, for the windows."""
    if "churn_date" not in panel.columns:
        churn = clients.select("client_id", "churn_date").hint("shuffle_hash")
        panel = panel.join(churn, "client_id", "left")
    df = truncate_after_churn(panel)
    df = months_since_upgrade(rate_features(trend_features(df))).drop("churn_date")
    static = clients.select("client_id", *STATIC_COLUMNS, "services_subscribed").hint("shuffle_hash")
    out = (df.join(static, "client_id", "left")
           .withColumn("is_declining_engagement_flag",
                       X.engagement_flag("usage_trend_3mo", "ticket_count", trend_floor,
                                         ticket_ceiling))
           .withColumn("services_count", X.services_count("services_subscribed")))
    return out.select(*MODEL_READY_COLUMNS)
