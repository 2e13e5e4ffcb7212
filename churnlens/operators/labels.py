"""Churn label, client-grouped split, feature encoding and a fixed-formula
score (M1, M2, F7, F8, J2).

The formula score is a logistic function of the model features with fixed
weights: a deterministic stand-in for a fitted model, so that ranking, tiers,
metrics and decisions can be checked against SQL.  The fitted models live in
``models.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import expr as X

# Names and order of the reference's columns
BASE_FEATURES = [
    "monthly_recurring_revenue", "nps_score", "tenure_months", "services_count",
    "revenue_trend_3mo", "usage_trend_3mo", "late_payment_rate", "sla_breach_rate",
    "months_since_last_upgrade", "is_declining_engagement_flag", "ticket_count",
    "escalated_ticket_count", "total_usage", "usage_infra", "usage_cloud", "usage_security",
    "size_num", "contract_type_num",
]
HORIZON_MONTHS = 3
TEST_PERCENT = 25
SPLIT_SEED = 42

# Fixed weights of the formula score (logit = intercept + sum w * x)
FORMULA_INTERCEPT = 1.5
FORMULA_WEIGHTS = {
    "sla_breach_rate": 2.0,
    "late_payment_rate": 1.5,
    "is_declining_engagement_flag": 0.8,
    "nps_score": -0.01,
    "tenure_months": -0.03,
    "months_since_last_upgrade": 0.02,
    "contract_type_num": -0.4,
    "services_count": -0.3,
}


def feature_names(industry_vocab: Sequence[str], region_vocab: Sequence[str]) -> list[str]:
    return (BASE_FEATURES + [f"industry_{v}" for v in industry_vocab]
            + [f"region_{v}" for v in region_vocab])


def churn_label(df: DataFrame, horizon: int = HORIZON_MONTHS) -> DataFrame:
    """M1: 1 when the client churns within ``horizon`` whole months of the row's
    month (0..horizon), else 0; NULL churn date -> 0."""
    m = X.month_diff("churn_date", X.month_start("year_month"))
    hit = F.col("is_churned") & (m >= 0) & (m <= horizon)
    return df.withColumn("target_churn_3m", F.coalesce(hit, F.lit(False)).cast("int"))


def _mixed(key: str, seed: int) -> Column:
    """(key * 7919 + seed) mod 10007; the key is reduced first, so that no key overflows."""
    small = F.pmod(F.col(key), F.lit(10007)).cast("long")
    return F.pmod(small * 7919 + F.lit(seed).cast("long"), F.lit(10007))


def split_bucket(key: str | Column, seed: int = SPLIT_SEED) -> Column:
    """0..99 from the client key: an arithmetic hash for integer keys (SQL can
    repeat it), xxhash64 otherwise."""
    return _mixed(key, seed) % 100


def group_split(df: DataFrame, key: str = "client_id", test_percent: int = TEST_PERCENT,
                seed: int = SPLIT_SEED) -> DataFrame:
    """M2: every row of a client lands in the same split (no leakage)."""
    is_num = isinstance(df.schema[key].dataType, NumericType)
    bucket = split_bucket(key, seed) if is_num else F.pmod(F.xxhash64(key, F.lit(seed)), 100)
    return df.withColumn("split", F.when(bucket < test_percent, "test").otherwise("train"))


def group_split_exact(df: DataFrame, key: str = "client_id",
                      test_share: float = TEST_PERCENT / 100.0,
                      seed: int = SPLIT_SEED) -> DataFrame:
    """M2, exact-count variant: of the n distinct clients, exactly
    ceil(test_share * n) go to test (as a group shuffle split does), chosen by
    their hash order.  The rank is a distributed running count over the
    distinct clients, and the per-client split joins back on the key."""
    from .ordering import prefix_sums
    is_num = isinstance(df.schema[key].dataType, NumericType)
    h = (_mixed(key, seed) if is_num
         else F.xxhash64(key, F.lit(seed)))
    keys = df.select(key).distinct().withColumn("_h", h)
    ranked = prefix_sums(keys, [F.col("_h"), F.col(key)], {}, "_rank")
    n = keys.agg(F.count(F.lit(1)).alias("_n")).withColumn("_one", F.lit(1))
    split = (ranked.withColumn("_one", F.lit(1)).join(F.broadcast(n), "_one")   # one row
             .select(key, F.when(F.col("_rank") <= F.ceil(F.col("_n") * test_share), "test")
                     .otherwise("train").alias("split")))
    return df.join(split, key, "left")


def encode_features(df: DataFrame, clients: DataFrame, industry_vocab: Sequence[str],
                    region_vocab: Sequence[str]) -> DataFrame:
    """J2 + F7 + F8: the client's MRR, ordinal size/contract, one-hot industry and
    region over fixed vocabularies, all features as double."""
    if "monthly_recurring_revenue" not in df.columns:
        df = df.join(clients.select("client_id", "monthly_recurring_revenue"), "client_id", "left")
    out = df.select(
        "*",
        X.ordinal("client_size", X.SIZE_ORDINAL).alias("size_num"),
        X.ordinal("contract_type", X.CONTRACT_ORDINAL).alias("contract_type_num"),
        *X.one_hot("industry", industry_vocab, "industry"),
        *X.one_hot("region", region_vocab, "region"),
    )
    return out.withColumns({c: F.col(c).cast("double")
                            for c in feature_names(industry_vocab, region_vocab)})


def formula_logit(weights: dict[str, float] | None = None,
                  intercept: float = FORMULA_INTERCEPT) -> Column:
    weights = weights or FORMULA_WEIGHTS
    z = F.lit(intercept)
    for c, w in weights.items():
        z = z + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return z


SCORE_DIGITS = 9   # scores are reported to 9 decimals, so ties do not hinge on the last ulp


def formula_score(df: DataFrame, out: str = "predicted_churn_probability") -> DataFrame:
    """p = 1 / (1 + exp(-logit)) with the fixed weights, to SCORE_DIGITS decimals."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-formula_logit()))
    return df.withColumn(out, F.round(p, SCORE_DIGITS))


def formula_sql(columns: dict[str, str] | None = None) -> str:
    """The same score as SQL text; ``columns`` maps a feature to another SQL
    expression (used for edited what-if features)."""
    columns = columns or {}
    terms = " + ".join(f"({w!r}) * COALESCE(CAST({columns.get(c, c)} AS DOUBLE), 0.0)"
                       for c, w in FORMULA_WEIGHTS.items())
    return (f"round(1.0 / (1.0 + exp(-(({FORMULA_INTERCEPT!r}) + {terms}))), "
            f"{SCORE_DIGITS})")

