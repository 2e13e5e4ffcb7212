"""Data-quality report.

Every check is one aggregate; the report is a frame of
(rule, observed, expected, passed) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_SCHEMA = "rule string, observed double, expected string, passed boolean"


def _row(df: DataFrame, rule: str, observed, expected: str, passed) -> DataFrame:
    return df.agg(observed.cast("double").alias("observed"), passed.alias("passed")).select(
        F.lit(rule).alias("rule"), "observed", F.lit(expected).alias("expected"), "passed")


def row_count_equals(df: DataFrame, other: DataFrame, rule: str) -> DataFrame:
    """Q1: two counts agree (both sides aggregate, no data moves)."""
    a = df.agg(F.count(F.lit(1)).alias("_a")).withColumn("_one", F.lit(1))
    b = other.agg(F.count(F.lit(1)).alias("_b")).withColumn("_one", F.lit(1))
    j = a.join(b, "_one")   # two one-row frames
    return j.select(F.lit(rule).alias("rule"), F.col("_a").cast("double").alias("observed"),
                    F.col("_b").cast("string").alias("expected"),
                    (F.col("_a") == F.col("_b")).alias("passed"))


def rate_within(df: DataFrame, flag: str, expected: float, tol: float, rule: str) -> DataFrame:
    """Q2: mean of a boolean within +-tol of the expected rate."""
    r = F.avg(F.col(flag).cast("double"))
    return _row(df, rule, r, f"{expected} +- {tol}", F.abs(r - expected) <= tol)


def no_nulls(df: DataFrame, exempt: Sequence[str], rule: str) -> DataFrame:
    """Q3 (A18): no NULL outside the exempt columns."""
    cols = [c for c in df.columns if c not in set(exempt)]
    n = sum((F.col(c).isNull().cast("long") for c in cols), F.lit(0).cast("long"))
    total = F.coalesce(F.sum(n), F.lit(0))
    return _row(df, rule, total, "0", total == 0)


def has_columns(df: DataFrame, required: Sequence[str], rows_per_group: int,
                group_col: str, rule: str) -> DataFrame:
    """Q4 (U3 + count): required columns present (metadata) and every group has
    exactly ``rows_per_group`` rows."""
    missing = sorted(set(required) - set(df.columns))
    per = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_c"))
    bad = F.count_if(F.col("_c") != rows_per_group)
    return _row(per, rule, bad + len(missing), f"0 missing columns, {rows_per_group} rows each",
                (bad == 0) & F.lit(not missing))


def in_range(df: DataFrame, col: str, lo: float, hi: float, rule: str) -> DataFrame:
    """Q5 (A14): min >= lo and max <= hi."""
    out_of = F.count_if((F.col(col) < lo) | (F.col(col) > hi))
    return _row(df, rule, out_of, f"all in [{lo}, {hi}]",
                (F.min(col) >= lo) & (F.max(col) <= hi))


def separates(df: DataFrame, flag: str, score: str, rule: str) -> DataFrame:
    """Q6 (A13): mean score of flagged rows above the others."""
    hi = F.avg(F.when(F.col(flag), F.col(score)))
    lo = F.avg(F.when(~F.col(flag), F.col(score)))
    return _row(df, rule, hi - lo, "> 0", F.coalesce(hi > lo, F.lit(False)))


def report(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
