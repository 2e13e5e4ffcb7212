"""Driver contract: entry runs, every oracle key is a query, and the
SQL-checkable queries agree with DuckDB on the smallest scale."""

import importlib
import os
import sys

import duckdb
import pytest

from .conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
E = importlib.import_module("__spark_entry__")
sys.path.insert(0, os.path.join(ROOT, "scripts"))
oc = importlib.import_module("oracle_check")


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert df.columns[0] == "client_id"


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


FAST = ["client_month_panel", "model_ready", "segment_churn_rate", "lorenz_curve",
        "recommendations", "churn_adjusted_forecast", "quality_report", "roc_auc"]


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(dcols)
    hs, _ = oc.digest([tuple(r) for r in df.collect()], df.columns)
    hd, _ = oc.digest(res.fetchall(), dcols)
    assert hs == hd


def test_rounded_columns_named_in_sql():
    from churnlens.plans.catalog import REGISTRY
    for name, q in REGISTRY.items():
        if q.sql is None:
            continue
        for col in q._scales():
            assert col in q.sql, (name, col)
