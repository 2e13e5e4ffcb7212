"""Join helpers (J1-J10): broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when it holds at most ``max_rows`` rows.

    The check is a bounded job (``limit(max_rows + 1)``), so a side that turns
    out large is never collected: it is returned unhinted and Spark plans a
    shuffle join (AQE may still convert it from measured sizes).
    """
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows, by a bounded job."""
    return df.limit(max_rows + 1).count() <= max_rows


# ---------------------------------------------------------------------------
# Hot keys: split them out of the shuffle
# ---------------------------------------------------------------------------
HOT_SHARE = 0.01          # a key holding >= 1 % of the rows is hot
SAMPLE_ROWS = 1_000_000   # bound on the rows looked at to find hot keys


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE,
             sample_rows: int = SAMPLE_ROWS, seed: int = 17) -> list:
    """Keys holding at least ``share`` of the rows, estimated from a bounded
    sample of the key column.  At most 1/share keys can qualify, so the list is
    bounded by construction (it only steers the physical split, never which
    rows are kept)."""
    n = df.count()   # parquet scans answer this from footers
    if n == 0:
        return []
    frac = min(1.0, sample_rows / n)
    s = df.select(key).where(F.col(key).isNotNull())
    if frac < 1.0:
        s = s.sample(fraction=frac, seed=seed)
    need = max(2, int(share * n * frac))
    rows = (s.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= need)
            .limit(int(1 / share) + 1).collect())
    return [r[key] for r in rows]


def split_hot_join(big: DataFrame, dim: DataFrame, big_key: str, dim_key: str,
                   how: str = "inner", hot: list | None = None) -> DataFrame:
    """Equi-join a large table to a table with one row per key, keeping hot keys
    out of the shuffle.

    Rows of hot keys join against the broadcast dimension rows of those keys
    (at most one row per hot key, so the broadcast is bounded); the remaining
    rows take the ordinary (sort-merge or AQE-chosen) join.  The union of the
    two parts is the plain join, whichever keys are picked as hot."""
    hot = hot_keys(big, big_key) if hot is None else hot
    cond = lambda b, d: b[big_key] == d[dim_key]
    if not hot:
        return big.join(dim, cond(big, dim), how)
    is_hot = F.coalesce(F.col(big_key).isin(hot), F.lit(False))
    big_hot, big_cold = big.where(is_hot), big.where(~is_hot)
    dim_hot = F.broadcast(dim.where(F.col(dim_key).isin(hot)))
    dim_cold = dim.where(~F.coalesce(F.col(dim_key).isin(hot), F.lit(False)))
    return (big_hot.join(dim_hot, cond(big_hot, dim_hot), how)
            .unionByName(big_cold.join(dim_cold, cond(big_cold, dim_cold), how)))
