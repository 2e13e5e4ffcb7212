"""Client x month panel.

One conditional aggregate replaces the reference's six per-kind group-bys and
five full outer joins.  Spark plans it as partial (map-side) + final hash
aggregate, so the shuffle carries client-month partials, not transactions: a
client that owns a third of all rows is collapsed inside every map task.

Amounts missing on invoices and payments are filled with the client's MRR.
Because sum(coalesce(amount, mrr)) = sum(amount) + missing * mrr, the fill is
applied after the aggregate: the transactions are never joined to clients,
only the (much smaller) panel is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import month_key

# The six transaction kinds and the service lines split out
INVOICE, PAYMENT, TICKET = "invoice", "payment", "support-ticket"
UPGRADE, DOWNGRADE, USAGE = "service-upgrade", "service-downgrade", "usage-log"
KINDS = [INVOICE, PAYMENT, TICKET, UPGRADE, DOWNGRADE, USAGE]
USAGE_SPLITS = {"usage_infra": "Infrastructure", "usage_cloud": "Cloud",
                "usage_security": "Security"}
UPDOWN_FILL = 1500.0

KEYS = ["client_id", "year_month"]


def _sum_if(cond, value):
    return F.sum(F.when(cond, value))


def partial_panel(transactions: DataFrame, updown_fill: float = UPDOWN_FILL) -> DataFrame:
    """Aggregate transactions to client-months.

    Rows with a NULL key or an unknown kind never form a panel row (pandas
    drops NULL group keys; a key exists only if one of the six kinds occurs).
    Invoice/payment amounts stay unfilled here; ``_inv_missing`` and
    ``_pay_missing`` count the rows still to be filled with MRR.
    """
    kind = F.col("transaction_type")
    amt = F.col("amount")
    t = transactions.where(F.col("client_id").isNotNull()
                           & F.col("transaction_date").isNotNull()
                           & kind.isin(KINDS))
    usage = kind == USAGE
    aggs = [
        _sum_if(kind == INVOICE, amt).alias("_inv_known"),
        F.count_if((kind == INVOICE) & amt.isNull()).alias("_inv_missing"),
        _sum_if(kind == PAYMENT, amt).alias("_pay_known"),
        F.count_if((kind == PAYMENT) & amt.isNull()).alias("_pay_missing"),
        F.count_if((kind == PAYMENT) & (F.col("payment_status") == "late")).alias("late_pay_count"),
        F.count_if((kind == PAYMENT) & (F.col("payment_status") == "failed"))
         .alias("failed_pay_count"),
        F.count(F.when(kind == PAYMENT, F.col("payment_status"))).alias("total_pay_count"),
        F.count(F.when(kind == TICKET, F.col("transaction_id"))).alias("ticket_count"),
        _sum_if(kind == TICKET, F.col("notes_flag").cast("long")).alias("escalated_ticket_count"),
        _sum_if(usage, F.col("usage_units")).alias("total_usage"),
        *[_sum_if(usage & (F.col("service_line") == line), F.col("usage_units")).alias(name)
          for name, line in USAGE_SPLITS.items()],
        _sum_if(kind == UPGRADE, F.coalesce(amt, F.lit(updown_fill))).alias("upgrade_amt"),
        _sum_if(kind == DOWNGRADE, F.coalesce(amt, F.lit(updown_fill))).alias("downgrade_amt"),
    ]
    # group on the month's first day (a 4-byte date) and format the label once
    # per client-month after the aggregate instead of once per transaction
    out = t.groupBy("client_id", F.trunc("transaction_date", "MM").alias("_month")).agg(*aggs)
    return out.select("client_id", month_key("_month").alias("year_month"),
                      *[c for c in out.columns if c not in ("client_id", "_month")])


# Names and order of the reference's columns
PANEL_COLUMNS = [
    "invoiced_amt", "paid_amt", "late_pay_count", "failed_pay_count", "total_pay_count",
    "ticket_count", "escalated_ticket_count", "total_usage", "usage_infra", "usage_cloud",
    "usage_security", "upgrade_amt", "downgrade_amt",
]
_LONGS = {"late_pay_count", "failed_pay_count", "total_pay_count", "ticket_count",
          "escalated_ticket_count"}


def client_month_panel(transactions: DataFrame, clients: DataFrame | None = None,
                       updown_fill: float = UPDOWN_FILL,
                       carry: Sequence[str] = ()) -> DataFrame:
    """The 15-column panel; ``carry`` adds client columns from the same join.

    With ``clients`` = None no MRR fill happens (missing amounts add 0).  An
    unknown client or a NULL MRR also adds 0, as a failed dict lookup does.
    """
    return finish_panel(partial_panel(transactions, updown_fill), clients, carry)


def finish_panel(p: DataFrame, clients: DataFrame | None = None,
                 carry: Sequence[str] = ()) -> DataFrame:
    """MRR fill (one join of client-month partials to clients) and zero fill."""
    if clients is not None:
        dim = clients.select("client_id", F.col("monthly_recurring_revenue").alias("_mrr"),
                             *carry)
        # the clients' side is hashed: the much larger panel need not be sorted for the join
        p = p.join(dim.hint("shuffle_hash"), "client_id", "left")
        mrr = F.coalesce(F.col("_mrr"), F.lit(0.0))
    else:
        mrr = F.lit(0.0)
    filled = {
        "invoiced_amt": F.coalesce(F.col("_inv_known"), F.lit(0.0)) + F.col("_inv_missing") * mrr,
        "paid_amt": F.coalesce(F.col("_pay_known"), F.lit(0.0)) + F.col("_pay_missing") * mrr,
    }
    out = []
    for c in PANEL_COLUMNS:
        e = filled.get(c, F.col(c))
        zero = F.lit(0).cast("long") if c in _LONGS else F.lit(0.0)
        out.append(F.coalesce(e, zero).cast("long" if c in _LONGS else "double").alias(c))
    return p.select(*KEYS, *out, *carry)


def merge_partials(partials: DataFrame) -> DataFrame:
    """A2: sum partials that share a key (chunk / micro-batch merge).  Works on
    finished panels and on ``partial_panel`` output (its fill counters are sums
    too, so the MRR fill can run once after the merge)."""
    cols = [c for c in partials.columns if c not in KEYS]
    return partials.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in cols])
