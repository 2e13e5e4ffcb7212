"""DuckDB SQL text for the correctness oracle.

The SQL is written independently of the Spark code and, where it helps the
check, the brute-force way (row-level MRR fill before the aggregate, exact
window frames, closed-form OLS).  Every fragment below is a named CTE; a query
lists the CTEs it needs and its final SELECT.
"""

from __future__ import annotations

from ..functions import expr as X
from ..sources import adapters as A

_MGR = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(A.ACCOUNT_MANAGERS))
_SERV = " ".join(f"WHEN {n - 1} THEN '{';'.join(X.SERVICES[:n])}'"
                 for n in range(1, len(X.SERVICES) + 1))


def _safe(num: str, den: str, default: float) -> str:
    return (f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 OR ({num}) IS NULL "
            f"THEN {default} ELSE ({num}) / ({den}) END)")


def _onehot(col: str, vocab, prefix: str) -> str:
    return ", ".join(f"CAST(COALESCE({col} = '{v}', FALSE) AS INTEGER) AS \"{prefix}_{v}\""
                     for v in vocab)


CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTE[name] = (deps, body)


cte("order_span", [], """
SELECT o_custkey AS client_id, MIN(CAST(o_orderdate AS DATE)) AS first_order,
       MAX(CAST(o_orderdate AS DATE)) AS last_order
FROM orders GROUP BY o_custkey""")

cte("clients", ["order_span"], f"""
SELECT c.c_custkey AS client_id, c.c_name AS client_name, c.c_mktsegment AS industry,
  CASE WHEN c.c_acctbal < 3000 THEN 'Small' WHEN c.c_acctbal < 7000 THEN 'Medium'
       ELSE 'Enterprise' END AS client_size,
  s.first_order AS contract_start_date,
  CASE c.c_custkey % 3 WHEN 0 THEN 'Monthly' WHEN 1 THEN 'Annual' ELSE 'Multi-year' END
    AS contract_type,
  CASE c.c_custkey % 4 {_SERV} END AS services_subscribed,
  CASE WHEN c.c_custkey % 8 = 0 THEN NULL ELSE c.c_acctbal + 1000.0 END
    AS monthly_recurring_revenue,
  (c.c_acctbal + 1000.0) * CASE c.c_custkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 12.0 ELSE 36.0 END
    AS contract_value,
  CASE c.c_custkey % 5 {_MGR} END AS account_manager,
  g.r_name AS region,
  CAST(c.c_custkey % 30 AS INTEGER) AS support_tickets_last_90_days,
  1.5 + CAST(c.c_custkey % 36 AS DOUBLE) / 10.0 AS avg_ticket_satisfaction,
  CAST(c.c_custkey % 6 AS INTEGER) AS sla_breaches_last_90_days,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE CAST(c.c_custkey % 21 AS DOUBLE) END
    AS payment_delay_days_avg,
  CAST((c.c_custkey * 53) % 101 AS DOUBLE) AS product_usage_score,
  CAST((c.c_custkey * 37) % 201 - 100 AS INTEGER) AS nps_score,
  COALESCE(s.last_order < DATE '{A.CHURN_CUTOFF}', FALSE) AS is_churned,
  CASE WHEN s.last_order < DATE '{A.CHURN_CUTOFF}' THEN s.last_order END AS churn_date,
  CAST(CASE WHEN s.first_order IS NOT NULL THEN GREATEST(1,
    (year(COALESCE(CASE WHEN s.last_order < DATE '{A.CHURN_CUTOFF}' THEN s.last_order END,
                   DATE '{A.WINDOW_END}')) - year(s.first_order)) * 12
    + month(COALESCE(CASE WHEN s.last_order < DATE '{A.CHURN_CUTOFF}' THEN s.last_order END,
                     DATE '{A.WINDOW_END}')) - month(s.first_order)) END AS INTEGER) AS tenure_months
FROM customer c
LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) g
  ON c.c_nationkey = g.n_nationkey
LEFT JOIN order_span s ON c.c_custkey = s.client_id""")

cte("transactions", [], """
SELECT CASE WHEN k.kind = 'invoice' THEN 'INV-' ELSE 'PAY-' END || CAST(o_orderkey AS VARCHAR)
         AS transaction_id,
       o_custkey AS client_id, CAST(o_orderdate AS DATE) AS transaction_date,
       k.kind AS transaction_type,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice END AS amount,
       CAST(NULL AS VARCHAR) AS service_line,
       CASE WHEN k.kind = 'payment' THEN CASE o_orderstatus WHEN 'F' THEN 'on-time'
            WHEN 'O' THEN 'late' WHEN 'P' THEN 'failed' END END AS payment_status,
       CAST(NULL AS DOUBLE) AS usage_units, 0 AS notes_flag
FROM orders, (VALUES ('invoice'), ('payment')) k(kind)
UNION ALL
SELECT 'LIN-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR),
       o_custkey, CAST(l_shipdate AS DATE),
       CASE WHEN l_linestatus = 'F' THEN 'usage-log' WHEN l_returnflag = 'R' THEN 'support-ticket'
            WHEN l_returnflag = 'A' THEN 'service-upgrade' ELSE 'service-downgrade' END,
       CASE WHEN l_linestatus = 'F' OR l_returnflag = 'R' THEN NULL
            WHEN l_returnflag = 'A' THEN l_extendedprice * l_discount
            ELSE -(l_extendedprice * l_discount) END,
       CASE l_returnflag WHEN 'A' THEN 'Infrastructure' WHEN 'N' THEN 'Cloud'
            WHEN 'R' THEN 'Security' END,
       CAST(NULL AS VARCHAR),
       CASE WHEN l_linestatus = 'F' THEN l_quantity END,
       CAST(l_quantity > 40 AS INTEGER)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

# Closed-form OLS with industry fixed effects (Frisch-Waugh-Lovell): the same
# column space as an intercept plus drop-first industry indicators.
cte("mrr_train", ["clients"], """
SELECT client_id, industry, monthly_recurring_revenue AS y,
  CAST(CASE client_size WHEN 'Small' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Enterprise' THEN 3 END
       AS DOUBLE) AS x1,
  CAST(len(string_split(services_subscribed, ';')) AS DOUBLE) AS x2
FROM clients WHERE monthly_recurring_revenue IS NOT NULL""")
cte("mrr_ind", ["mrr_train"], """
SELECT industry, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2 FROM mrr_train GROUP BY industry""")
cte("mrr_coef", ["mrr_train", "mrr_ind"], """
SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
       (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2
FROM (SELECT sum((x1 - m1) * (x1 - m1)) AS s11, sum((x1 - m1) * (x2 - m2)) AS s12,
             sum((x2 - m2) * (x2 - m2)) AS s22, sum((x1 - m1) * (y - my)) AS s1y,
             sum((x2 - m2) * (y - my)) AS s2y
      FROM mrr_train JOIN mrr_ind USING (industry))""")
cte("mrr_fit", ["clients", "mrr_ind", "mrr_coef"], """
SELECT c.client_id,
  i.my + b.b1 * (CASE c.client_size WHEN 'Small' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END - i.m1)
       + b.b2 * (len(string_split(c.services_subscribed, ';')) - i.m2) AS mrr_pred
FROM clients c JOIN mrr_ind i USING (industry), mrr_coef b""")
cte("clients_clean", ["clients", "mrr_fit"], """
SELECT * REPLACE (
  COALESCE(c.monthly_recurring_revenue, f.mrr_pred) AS monthly_recurring_revenue,
  COALESCE(c.payment_delay_days_avg,
           (SELECT median(payment_delay_days_avg) FROM clients)) AS payment_delay_days_avg)
FROM clients c JOIN mrr_fit f USING (client_id)""")

cte("tx_filled", ["transactions", "clients_clean"], """
SELECT t.* REPLACE (
  CASE WHEN t.amount IS NOT NULL THEN t.amount
       WHEN t.transaction_type IN ('service-upgrade', 'service-downgrade') THEN 1500.0
       WHEN t.transaction_type IN ('invoice', 'payment') THEN c.monthly_recurring_revenue
  END AS amount)
FROM transactions t LEFT JOIN clients_clean c USING (client_id)""")

cte("panel", ["tx_filled"], """
SELECT client_id, strftime(transaction_date, '%Y-%m') AS year_month,
  COALESCE(sum(CASE WHEN transaction_type = 'invoice' THEN amount END), 0.0) AS invoiced_amt,
  COALESCE(sum(CASE WHEN transaction_type = 'payment' THEN amount END), 0.0) AS paid_amt,
  CAST(count(*) FILTER (WHERE transaction_type = 'payment' AND payment_status = 'late')
       AS BIGINT) AS late_pay_count,
  CAST(count(*) FILTER (WHERE transaction_type = 'payment' AND payment_status = 'failed')
       AS BIGINT) AS failed_pay_count,
  CAST(count(CASE WHEN transaction_type = 'payment' THEN payment_status END) AS BIGINT)
    AS total_pay_count,
  CAST(count(CASE WHEN transaction_type = 'support-ticket' THEN transaction_id END) AS BIGINT)
    AS ticket_count,
  CAST(COALESCE(sum(CASE WHEN transaction_type = 'support-ticket' THEN notes_flag END), 0)
       AS BIGINT) AS escalated_ticket_count,
  COALESCE(sum(CASE WHEN transaction_type = 'usage-log' THEN usage_units END), 0.0)
    AS total_usage,
  COALESCE(sum(CASE WHEN transaction_type = 'usage-log' AND service_line = 'Infrastructure'
                    THEN usage_units END), 0.0) AS usage_infra,
  COALESCE(sum(CASE WHEN transaction_type = 'usage-log' AND service_line = 'Cloud'
                    THEN usage_units END), 0.0) AS usage_cloud,
  COALESCE(sum(CASE WHEN transaction_type = 'usage-log' AND service_line = 'Security'
                    THEN usage_units END), 0.0) AS usage_security,
  COALESCE(sum(CASE WHEN transaction_type = 'service-upgrade' THEN amount END), 0.0)
    AS upgrade_amt,
  COALESCE(sum(CASE WHEN transaction_type = 'service-downgrade' THEN amount END), 0.0)
    AS downgrade_amt
FROM tx_filled
WHERE client_id IS NOT NULL AND transaction_date IS NOT NULL
  AND transaction_type IN ('invoice', 'payment', 'support-ticket', 'service-upgrade',
                           'service-downgrade', 'usage-log')
GROUP BY 1, 2""")

# windows computed on the full panel, truncation applied after (as the reference)
cte("feat_all", ["panel", "clients_clean"], f"""
SELECT p.*,
  {_safe("avg(invoiced_amt) OVER (PARTITION BY client_id ORDER BY year_month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)",
         "avg(invoiced_amt) OVER (PARTITION BY client_id ORDER BY year_month ROWS BETWEEN 6 PRECEDING AND 4 PRECEDING)", 1.0)} AS revenue_trend_3mo,
  {_safe("avg(total_usage) OVER (PARTITION BY client_id ORDER BY year_month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)",
         "avg(total_usage) OVER (PARTITION BY client_id ORDER BY year_month ROWS BETWEEN 6 PRECEDING AND 4 PRECEDING)", 1.0)} AS usage_trend_3mo,
  {_safe("sum(late_pay_count) OVER (PARTITION BY client_id ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
         "sum(total_pay_count) OVER (PARTITION BY client_id ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", 0.0)} AS late_payment_rate,
  {_safe("sum(escalated_ticket_count) OVER (PARTITION BY client_id ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)",
         "sum(ticket_count) OVER (PARTITION BY client_id ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", 0.0)} AS sla_breach_rate,
  sum(CASE WHEN upgrade_amt > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY client_id
      ORDER BY year_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upgrade_group
FROM panel p""")

cte("model_ready", ["feat_all", "clients_clean"], """
SELECT f.client_id, f.year_month, invoiced_amt, paid_amt, late_pay_count, failed_pay_count,
  total_pay_count, ticket_count, escalated_ticket_count, total_usage, usage_infra, usage_cloud,
  usage_security, upgrade_amt, downgrade_amt, revenue_trend_3mo, usage_trend_3mo,
  late_payment_rate, sla_breach_rate,
  CAST(row_number() OVER (PARTITION BY f.client_id, upgrade_group ORDER BY f.year_month) - 1
       AS BIGINT) AS months_since_last_upgrade,
  CAST((usage_trend_3mo < 0.90 OR ticket_count > 1) AS INTEGER) AS is_declining_engagement_flag,
  CAST(len(string_split(c.services_subscribed, ';')) AS INTEGER) AS services_count,
  c.client_name, c.industry, c.client_size, c.contract_start_date, c.contract_type,
  c.account_manager, c.region, c.nps_score, c.is_churned, c.churn_date, c.tenure_months
FROM feat_all f LEFT JOIN clients_clean c USING (client_id)
QUALIFY c.churn_date IS NULL OR CAST(f.year_month || '-01' AS DATE) <= c.churn_date""")


def sql(final: str, needs: list[str] = ()) -> str:
    """Prefix ``final`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTE[n][1]}\n)" for n in order)
    return f"WITH RECURSIVE {body}\n{final}" if order else final
