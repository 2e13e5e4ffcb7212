"""Invariants: results independent of partitioning, filter-before-window
equals filter-after, no client in both splits, distributed prefix sums equal
a sequential cumulative sum."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators import features as FE
from churnlens.operators import labels as LB
from churnlens.operators import panel as PA
from churnlens.operators.ordering import prefix_sums
from churnlens.sources import adapters as A

from .conftest import SF_SMALL


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_prefix_sums_match_cumsum(spark):
    rng = np.random.default_rng(3)
    vals = rng.integers(0, 20, 500).astype(float)
    df = spark.createDataFrame([(int(i), float(v)) for i, v in enumerate(vals)], "k long, v double")
    for parts in (1, 3, 7):
        out = prefix_sums(df.repartition(5), ["v", "k"], {"cv": F.col("v")}, "pos", parts)
        got = out.orderBy("pos").collect()
        order = sorted(range(len(vals)), key=lambda i: (vals[i], i))
        assert [r["k"] for r in got] == order
        assert [r["cv"] for r in got] == pytest.approx(np.cumsum(vals[order]).tolist())
        assert [r["pos"] for r in got] == list(range(1, len(vals) + 1))


def test_prefix_sums_shuffle_rows_once_and_keep_nulls_in_order(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"v{i % 3}", i % 7) for i in range(200)],
                               "k long, v string, x int").repartition(4)
    out = prefix_sums(df, ["v", "k"], {"cx": F.col("x")}, "pos", 2)
    assert out.columns == ["k", "v", "x", "pos", "cx"]
    rows = out.orderBy("pos").collect()
    order = sorted(((f"v{i % 3}" if i % 5 else ""), i) for i in range(200))
    assert [r["k"] for r in rows] == [i for _, i in order]
    assert [r["cx"] for r in rows] == np.cumsum([i % 7 for _, i in order]).tolist()
    plan = out._jdf.queryExecution().executedPlan().toString()
    # by slice: the rows, and the sums that the map tasks have combined; no shuffle by range
    assert plan.count("Exchange hashpartitioning(_slice") == 2 and "rangepartitioning" not in plan
    assert prefix_sums(df.where("k < 0"), ["k"], {}, "pos").count() == 0


def test_panel_independent_of_partitioning(spark):
    tx = A.transactions_view(spark, SF_SMALL)
    a = PA.client_month_panel(tx)
    b = PA.client_month_panel(tx.repartition(13, "transaction_id"))
    ra = {(r[0], r[1]): r for r in a.collect()}
    rb = {(r[0], r[1]): r for r in b.collect()}
    assert ra.keys() == rb.keys()
    for k in ra:
        assert tuple(ra[k])[2:] == pytest.approx(tuple(rb[k])[2:])


def test_filter_before_window_equals_after(spark):
    tx = A.transactions_view(spark, SF_SMALL)
    cl = A.clients_view(spark, SF_SMALL)
    panel = PA.client_month_panel(tx, cl, carry=["churn_date", "services_subscribed"])
    before = FE.engineer_features(panel)
    after = FE.truncate_after_churn(
        FE.months_since_upgrade(FE.rate_features(FE.trend_features(panel))))
    cols = ["client_id", "year_month", "revenue_trend_3mo", "usage_trend_3mo",
            "late_payment_rate", "sla_breach_rate", "months_since_last_upgrade"]
    assert _sorted(before.select(*cols)) == _sorted(after.select(*cols))


def test_no_client_in_both_splits(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "client_id")
    s = LB.group_split(df.unionByName(df))
    both = s.groupBy("client_id").agg(F.countDistinct("split").alias("n")).where("n > 1")
    assert both.count() == 0
    share = s.where("split = 'test'").count() / s.count()
    assert 0.2 < share < 0.3


def test_split_hot_join_equals_plain_join(spark):
    from churnlens.operators.joins import hot_keys, split_hot_join
    big = spark.createDataFrame([(1 if i % 3 == 0 else i % 50, i) for i in range(3000)]
                                + [(None, -1)], "k long, v long")
    dim = spark.createDataFrame([(k, k * 10) for k in range(0, 40)], "dk long, w long")
    assert 1 in hot_keys(big, "k", share=0.2)
    for how in ("inner", "left"):
        a = _sorted(split_hot_join(big, dim, "k", "dk", how, hot=[1]))
        b = _sorted(big.join(dim, big.k == dim.dk, how))
        c = _sorted(split_hot_join(big, dim, "k", "dk", how))
        assert a == b == c


def test_exact_split_counts(spark):
    df = spark.range(0, 1001).withColumnRenamed("id", "client_id")
    s = LB.group_split_exact(df.unionByName(df))
    per = s.groupBy("client_id").agg(F.countDistinct("split").alias("n"))
    assert per.where("n > 1").count() == 0
    assert s.select("client_id", "split").distinct().where("split = 'test'").count() == 251
    strs = spark.createDataFrame([(f"C{i:04d}",) for i in range(40)], "client_id string")
    assert LB.group_split_exact(strs).where("split = 'test'").count() == 10
