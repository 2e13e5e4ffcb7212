"""Declared schemas of the data products (no inference on read)."""

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType,
)


def _schema(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


CLIENTS = _schema(
    ("client_id", StringType(), False),
    ("client_name", StringType(), False),
    ("industry", StringType(), False),
    ("client_size", StringType(), False),
    ("contract_start_date", DateType(), True),
    ("contract_type", StringType(), False),
    ("services_subscribed", StringType(), False),
    ("monthly_recurring_revenue", DoubleType(), True),
    ("contract_value", DoubleType(), True),
    ("account_manager", StringType(), False),
    ("region", StringType(), False),
    ("support_tickets_last_90_days", IntegerType(), False),
    ("avg_ticket_satisfaction", DoubleType(), False),
    ("sla_breaches_last_90_days", IntegerType(), False),
    ("payment_delay_days_avg", DoubleType(), True),
    ("product_usage_score", DoubleType(), False),
    ("nps_score", IntegerType(), False),
    ("is_churned", BooleanType(), False),
    ("churn_date", DateType(), True),
    ("tenure_months", IntegerType(), True),
)

TRANSACTIONS = _schema(
    ("transaction_id", StringType(), True),
    ("client_id", StringType(), True),
    ("transaction_date", DateType(), True),
    ("transaction_type", StringType(), True),
    ("amount", DoubleType(), True),
    ("service_line", StringType(), True),
    ("payment_status", StringType(), True),
    ("usage_units", DoubleType(), True),
    ("notes_flag", IntegerType(), True),
)

PANEL_MEASURES_DOUBLE = [
    "invoiced_amt", "paid_amt", "total_usage", "usage_infra", "usage_cloud",
    "usage_security", "upgrade_amt", "downgrade_amt",
]
PANEL_MEASURES_LONG = [
    "late_pay_count", "failed_pay_count", "total_pay_count", "ticket_count",
    "escalated_ticket_count",
]
PANEL_MEASURES = [
    "invoiced_amt", "paid_amt", "late_pay_count", "failed_pay_count", "total_pay_count",
    "ticket_count", "escalated_ticket_count", "total_usage", "usage_infra", "usage_cloud",
    "usage_security", "upgrade_amt", "downgrade_amt",
]

RISK_RANKING = _schema(
    ("client_id", StringType(), False),
    ("client_name", StringType(), True),
    ("account_manager", StringType(), True),
    ("monthly_recurring_revenue", DoubleType(), True),
    ("contract_type", StringType(), True),
    ("is_churned", BooleanType(), True),
    ("predicted_churn_probability", DoubleType(), True),
    ("risk_tier", StringType(), True),
)

FORECAST = _schema(
    ("year_month", StringType(), False),
    ("baseline_forecast", DoubleType(), True),
    ("ci_lower", DoubleType(), True),
    ("ci_upper", DoubleType(), True),
    ("churn_adjusted_forecast", DoubleType(), True),
    ("expected_mrr_loss", DoubleType(), True),
)

EVENTS = _schema(
    ("event_id", LongType(), True),
    ("ts", TimestampNTZType(), True),
    ("user_id", LongType(), True),
    ("event_type", StringType(), True),
    ("value", DoubleType(), True),
    ("props", StringType(), True),
)
