"""Views that present the driver's TPC-H-style tables as the reference's two
inputs: a ``clients`` dimension and a tall ``transactions`` fact table.

The mapping is a fixed rule of the keys; the DuckDB oracle text in
``plans/oracle.py`` spells out the same rule in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators.joins import hot_keys, split_hot_join
from .io import read_table

# ---------------------------------------------------------------------------
# Fixed values of the adapter
# ---------------------------------------------------------------------------
WINDOW_START = "1995-01-01"
WINDOW_END = "2001-08-31"
CHURN_CUTOFF = "2000-07-01"      # last order before this day -> churned on that day
ACCOUNT_MANAGERS = ["Avery Cole", "Blake Moreno", "Casey Lin", "Devon Shah", "Emery Novak"]
CONTRACT_BY_KEY = ["Monthly", "Annual", "Multi-year"]
SERVICE_LINE_BY_FLAG = {"A": "Infrastructure", "N": "Cloud", "R": "Security"}
PAYMENT_STATUS_BY_ORDER_STATUS = {"F": "on-time", "O": "late", "P": "failed"}
# one-hot vocabularies of the adapter data, first level (alphabetical) dropped
INDUSTRY_VOCAB = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGION_VOCAB = ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
INDUSTRIES = ["AUTOMOBILE"] + INDUSTRY_VOCAB
REGIONS = ["AFRICA"] + REGION_VOCAB


def _pick(key: Column, values: list[str]) -> Column:
    """values[key % len(values)] as a CASE expression."""
    m = key % len(values)
    out = None
    for i, v in enumerate(values):
        out = F.when(m == i, v) if out is None else out.when(m == i, v)
    return out


def _map(c: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def order_span(orders: DataFrame) -> DataFrame:
    """First and last order date per customer (partial aggregate map-side)."""
    return (orders.groupBy(F.col("o_custkey").alias("client_id"))
            .agg(F.min(F.to_date("o_orderdate")).alias("first_order"),
                 F.max(F.to_date("o_orderdate")).alias("last_order")))


def clients_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    orders = read_table(spark, sf_dir, "orders")
    return build_clients(customer, nation, region, orders)


def build_clients(customer: DataFrame, nation: DataFrame, region: DataFrame,
                  orders: DataFrame) -> DataFrame:
    # nation x region is a fixed 25-row dimension: Spark broadcasts it from the
    # scan statistics (autoBroadcastJoinThreshold); no hint or extra job needed
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("region"))
    k = F.col("c_custkey")
    span = order_span(orders)
    c = (customer.join(geo, customer.c_nationkey == geo.n_nationkey, "left")
         .join(span, customer.c_custkey == span.client_id, "left"))
    churned = F.coalesce(F.col("last_order") < F.lit(CHURN_CUTOFF).cast("date"), F.lit(False))
    churn_date = F.when(churned, F.col("last_order"))
    services = None
    for n in range(1, len(X.SERVICES) + 1):
        txt = ";".join(X.SERVICES[:n])
        cond = (k % len(X.SERVICES)) == (n - 1)
        services = F.when(cond, txt) if services is None else services.when(cond, txt)
    base_mrr = F.col("c_acctbal") + F.lit(1000.0)
    contract = _pick(k, CONTRACT_BY_KEY)
    return c.select(
        k.alias("client_id"),
        F.col("c_name").alias("client_name"),
        F.col("c_mktsegment").alias("industry"),
        F.when(F.col("c_acctbal") < 3000, "Small").when(F.col("c_acctbal") < 7000, "Medium")
         .otherwise("Enterprise").alias("client_size"),
        F.col("first_order").alias("contract_start_date"),
        contract.alias("contract_type"),
        services.alias("services_subscribed"),
        F.when(k % 8 == 0, F.lit(None).cast("double")).otherwise(base_mrr)
         .alias("monthly_recurring_revenue"),
        X.contract_value(base_mrr, contract).alias("contract_value"),
        _pick(k, ACCOUNT_MANAGERS).alias("account_manager"),
        F.col("region"),
        (k % 30).cast("int").alias("support_tickets_last_90_days"),
        (F.lit(1.5) + (k % 36) / F.lit(10.0)).alias("avg_ticket_satisfaction"),
        (k % 6).cast("int").alias("sla_breaches_last_90_days"),
        F.when(k % 9 == 0, F.lit(None).cast("double")).otherwise((k % 21).cast("double"))
         .alias("payment_delay_days_avg"),
        ((k * 53) % 101).cast("double").alias("product_usage_score"),
        ((k * 37) % 201 - 100).cast("int").alias("nps_score"),
        churned.alias("is_churned"),
        churn_date.alias("churn_date"),
        X.tenure_months("first_order", churn_date, WINDOW_END).cast("int").alias("tenure_months"),
    )


def transactions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")
    return build_transactions(orders, lineitem)


def build_transactions(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Union of order-derived rows (invoice + payment) and line-derived rows."""
    return order_transactions(orders).unionByName(line_transactions(orders, lineitem))


def order_transactions(orders: DataFrame) -> DataFrame:
    """Each order is one invoice and one payment."""
    ok = F.col("o_orderkey")
    amount = F.when(ok % 8 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice"))
    kind = F.explode(F.array(F.lit("invoice"), F.lit("payment"))).alias("transaction_type")
    order_rows = orders.select(ok, "o_custkey", "o_orderdate", "o_orderstatus", amount.alias("a"),
                               kind)
    return order_rows.select(
        F.concat(F.when(F.col("transaction_type") == "invoice", "INV-").otherwise("PAY-"),
                 ok.cast("string")).alias("transaction_id"),
        F.col("o_custkey").alias("client_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
        "transaction_type",
        F.col("a").alias("amount"),
        F.lit(None).cast("string").alias("service_line"),
        F.when(F.col("transaction_type") == "payment",
               _map(F.col("o_orderstatus"), PAYMENT_STATUS_BY_ORDER_STATUS))
         .alias("payment_status"),
        F.lit(None).cast("double").alias("usage_units"),
        F.lit(0).alias("notes_flag"),
    )


def line_transactions(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Each line is a usage log, ticket, upgrade or downgrade of its order's client.

    Order keys that hold a large share of the lines are split out and joined
    against the broadcast order rows of just those keys; all other lines take
    the ordinary equi-join (sort-merge at scale, broadcast when AQE measures
    orders small)."""
    li = split_hot_join(lineitem, orders.select("o_orderkey", "o_custkey"),
                        "l_orderkey", "o_orderkey")
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    line_kind = (F.when(status == "F", "usage-log").when(flag == "R", "support-ticket")
                 .when(flag == "A", "service-upgrade").otherwise("service-downgrade"))
    fee = F.col("l_extendedprice") * F.col("l_discount")
    line_rows = li.select(
        F.concat(F.lit("LIN-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_custkey").alias("client_id"),
        F.to_date("l_shipdate").alias("transaction_date"),
        line_kind.alias("transaction_type"),
        F.when(status == "F", F.lit(None).cast("double"))
         .when(flag == "R", F.lit(None).cast("double"))
         .when(flag == "A", fee).otherwise(-fee).alias("amount"),
        _map(flag, SERVICE_LINE_BY_FLAG).alias("service_line"),
        F.lit(None).cast("string").alias("payment_status"),
        F.when(status == "F", F.col("l_quantity")).alias("usage_units"),
        (F.col("l_quantity") > 40).cast("int").alias("notes_flag"),
    )
    return line_rows


def hot_clients(spark: SparkSession, sf_dir: str) -> list:
    """Clients with a large share of the transactions, from bounded samples of the raw key columns:
    those with many orders and those of orders with many lines."""
    orders, lineitem = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    clients, large = hot_keys(orders, "o_custkey"), hot_keys(lineitem, "l_orderkey")
    if large:   # at most 100 orders
        owners = orders.where(F.col("o_orderkey").isin(large)).select("o_custkey").distinct().collect()
        clients = list({*clients, *(r["o_custkey"] for r in owners)} - {None})
    return clients
