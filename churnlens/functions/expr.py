"""Scalar column functions (F1-F26).  All are built-in expressions: they stay
inside whole-stage codegen and never leave the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's vocabularies and cut points)
# ---------------------------------------------------------------------------
SIZE_ORDINAL = {"Small": 1, "Medium": 2, "Enterprise": 3}
CONTRACT_ORDINAL = {"Monthly": 1, "Annual": 2, "Multi-year": 3}
CONTRACT_VALUE_FACTOR = {"Monthly": 1.0, "Annual": 12.0, "Multi-year": 36.0}
SERVICES = ["Infrastructure", "Cloud", "Security", "Support"]
# Right-closed tenure bins (0,6], (6,12], (12,18], (18,24], (24,30], (30,48]
TENURE_EDGES = [0, 6, 12, 18, 24, 30, 48]
TENURE_LABELS = ["0-6m", "6-12m", "12-18m", "18-24m", "24-30m", "30m+"]
# Risk tiers: p >= 0.70 High, p >= 0.30 Medium, otherwise Low
TIER_HIGH = 0.70
TIER_MEDIUM = 0.30
# Contract / services rule score
CONTRACT_RISK = {"Monthly": 4.0, "Annual": 1.0}
SERVICES_RISK = {1: 3.0, 2: 1.5}
LATE_PAYMENT_DAYS = 5


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 / F4 / F5 / F6 --------------------------------------------------------
def month_key(d: str | Column) -> Column:
    """Date -> 'yyyy-MM'."""
    return F.date_format(col_(d), "yyyy-MM")


def month_start(ym: str | Column) -> Column:
    """'yyyy-MM' -> first day of the month (NULL on a bad string)."""
    return F.try_to_date(F.concat(col_(ym), F.lit("-01")), "yyyy-MM-dd")


def month_diff(later: str | Column, earlier: str | Column) -> Column:
    """Whole calendar months between two dates (not months_between)."""
    a, b = col_(later), col_(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def month_after(d: str | Column, h: str | Column | int) -> Column:
    """'yyyy-MM' of d plus h months."""
    return F.date_format(F.add_months(col_(d), h if not isinstance(h, str) else F.col(h)),
                         "yyyy-MM")


# F2 / F3 --------------------------------------------------------------------
def services_count(s: str | Column, sep: str = ";") -> Column:
    return F.size(F.split(col_(s), sep, -1))


def join_list(arr: str | Column, sep: str = ";") -> Column:
    return F.array_join(col_(arr), sep)


# F7 / F8 / F11 ----------------------------------------------------------------
def ordinal(c: str | Column, mapping: dict) -> Column:
    """Category -> number; values outside the mapping give NULL."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col_(c) == k, F.lit(v)) if expr is None
                else expr.when(col_(c) == k, F.lit(v)))
    return expr


def one_hot(c: str | Column, vocabulary: Sequence[str], prefix: str) -> list[Column]:
    """Indicator columns over a fixed vocabulary (the dropped level is simply
    not listed)."""
    return [F.coalesce((col_(c) == v).cast("int"), F.lit(0)).alias(f"{prefix}_{v}")
            for v in vocabulary]


# F9 / F10 -----------------------------------------------------------------------
def tenure_bin(t: str | Column) -> Column:
    """Right-closed bins; outside (0, 48] -> NULL."""
    expr = None
    for lo, hi, label in zip(TENURE_EDGES[:-1], TENURE_EDGES[1:], TENURE_LABELS):
        cond = (col_(t) > lo) & (col_(t) <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def risk_tier(p: str | Column) -> Column:
    """NULL probability stays NULL."""
    return (F.when(col_(p) >= TIER_HIGH, "High")
            .when(col_(p) >= TIER_MEDIUM, "Medium")
            .when(col_(p).isNotNull(), "Low"))


# F12 / F13 / F14 -------------------------------------------------------------------
def safe_ratio(num: str | Column, den: str | Column, default: float) -> Column:
    """num / den with division by zero, NULL and NaN all mapped to ``default``."""
    r = F.try_divide(col_(num), col_(den))
    return F.when(r.isNull() | F.isnan(r), F.lit(default)).otherwise(r)


def clip(c: str | Column, lo: float, hi: float) -> Column:
    """Bounded value; NULL stays NULL (least and greatest alone would skip it)."""
    return F.when(col_(c).isNotNull(), F.least(F.greatest(col_(c), F.lit(lo)), F.lit(hi)))


def round_half_even(c: str | Column, scale: int = 0) -> Column:
    return F.bround(col_(c), scale)


# F16 / F17 ---------------------------------------------------------------------------
def fmt_percent(frac: str | Column, digits: int = 1) -> Column:
    """NULL stays NULL (no formatted placeholder)."""
    return F.when(col_(frac).isNotNull(), F.format_string(f"%.{digits}f%%", col_(frac) * 100))


def fmt_currency(x: str | Column, digits: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(col_(x), digits))


# F19 - F26 ----------------------------------------------------------------------------
def padded_id(prefix: str, n: str | Column, width: int = 8) -> Column:
    return F.concat(F.lit(prefix), F.lpad(col_(n).cast("string"), width, "0"))


def contract_value(mrr: str | Column, contract_type: str | Column) -> Column:
    return col_(mrr) * ordinal(contract_type, CONTRACT_VALUE_FACTOR)


def rule_risk_score(contract_type: str | Column, services: str | Column) -> Column:
    n = services_count(services)
    c = ordinal(contract_type, CONTRACT_RISK)
    s = ordinal(n, SERVICES_RISK)
    return F.coalesce(c, F.lit(0.0)) + F.coalesce(s, F.lit(0.0))


def tenure_months(start: str | Column, churn_date: str | Column, window_end) -> Column:
    """max(1, whole months from contract start to churn date or window end); NULL without a start."""
    end = F.coalesce(col_(churn_date), F.lit(window_end).cast("date"))
    return F.when(col_(start).isNotNull(), F.greatest(F.lit(1), month_diff(end, start)))


def late_status(due: str | Column, paid: str | Column) -> Column:
    return F.when(F.datediff(col_(paid), col_(due)) > LATE_PAYMENT_DAYS, "late").otherwise(
        "on-time")


def engagement_flag(usage_trend: str | Column, tickets: str | Column,
                    trend_floor: float = 0.90, ticket_ceiling: float = 5) -> Column:
    """1 when usage trend < floor OR tickets > ceiling (NULL compares as false)."""
    cond = (col_(usage_trend) < trend_floor) | (col_(tickets) > ticket_ceiling)
    return F.coalesce(cond, F.lit(False)).cast("int")
