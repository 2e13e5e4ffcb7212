"""Operators without a SQL twin, checked against brute force on small fixtures."""

import itertools

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators import decisions as DE
from churnlens.operators import forecast as FC
from churnlens.operators import metrics as MT
from churnlens.operators import models as MD
from churnlens.streaming import incremental_panel as ST

from .conftest import SF_SMALL


def _brute_roc(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def _brute_pr(s, y):
    pts = [(0.0, 1.0)]
    P = sum(y)
    for th in sorted(set(s), reverse=True):
        tp = sum(1 for a, b in zip(s, y) if a >= th and b == 1)
        fp = sum(1 for a, b in zip(s, y) if a >= th and b == 0)
        pts.append((tp / P, tp / (tp + fp)))
    return sum((r1 - r0) * (p1 + p0) / 2 for (r0, p0), (r1, p1) in zip(pts, pts[1:]))


def test_auc_against_brute_force(spark):
    rng = np.random.default_rng(11)
    s = [float(v) for v in np.round(rng.random(120), 2)]      # rounding creates ties
    y = [int(v) for v in rng.integers(0, 2, 120)]
    df = spark.createDataFrame(list(zip(s, y)), "score double, label int")
    assert MT.roc_auc(df).first()[0] == pytest.approx(_brute_roc(s, y))
    assert MT.pr_auc(df).first()[0] == pytest.approx(_brute_pr(s, y))


def _loop_holt_winters(y):
    """Least squared error over the grid, one scalar recursion per pair."""
    best = None
    for a in np.round(np.arange(1, 20) * 0.05, 2):
        for g in np.round(np.arange(1, 20) * 0.05, 2):
            lv, se, fit = y[:12].mean(), list(y[:12] - y[:12].mean()), []
            for t, obs in enumerate(y):
                j = t % 12
                fit.append(lv + se[j])
                new = a * (obs - se[j]) + (1 - a) * lv
                se[j] = g * (obs - new) + (1 - g) * se[j]
                lv = new
            sse = ((np.array(fit) - y) ** 2).sum()
            if best is None or sse < best[0]:
                best = (sse, a, g, lv, se, np.std(y - fit))
    return best


def test_holt_winters_fold_equals_loop(spark):
    rng = np.random.default_rng(5)
    y = 100 + 10 * np.sin(np.arange(40) * 2 * np.pi / 12) + rng.normal(0, 1, 40)
    rows = [("A", f"{2000 + m // 12}-{m % 12 + 1:02d}", float(v)) for m, v in enumerate(y)]
    out = FC.holt_winters(spark.createDataFrame(rows, "series_id string, year_month string, value double")).collect()
    for kind, seen in (("backtest", y[:-FC.HOLDOUT]), ("forecast", y)):
        _, a, g, lv, se, std = _loop_holt_winters(seen)
        mine = sorted((r for r in out if r["kind"] == kind), key=lambda r: r["h"])
        assert {(r["alpha"], r["gamma"]) for r in mine} == {(a, g)}
        assert [r["prediction"] for r in mine] == pytest.approx(
            [lv + se[(len(seen) + h) % 12] for h in range(len(mine))])
        if kind == "forecast":
            assert mine[0]["resid_std"] == pytest.approx(std)
        else:
            assert [r["actual"] for r in mine] == pytest.approx(list(y[-FC.HOLDOUT:]))


def test_holt_winters_says_when_history_is_short(spark):
    rows = [("A", f"2000-{m + 1:02d}", 5.0) for m in range(12)]
    out = FC.holt_winters(spark.createDataFrame(rows, "series_id string, year_month string, value double")).collect()
    assert len(out) == FC.HOLDOUT + FC.HORIZON
    assert all(r["prediction"] is None and r["status"] == "history too short" for r in out)


def test_holt_winters_shapes(spark):
    rows = [("A", f"{2000 + m // 12}-{m % 12 + 1:02d}", float(100 + (m % 12))) for m in range(36)]
    s = spark.createDataFrame(rows, "series_id string, year_month string, value double")
    out = FC.holt_winters(s).collect()
    assert sum(r["kind"] == "backtest" for r in out) == FC.HOLDOUT
    fut = [r for r in out if r["kind"] == "forecast"]
    assert len(fut) == FC.HORIZON and fut[0]["year_month"] == "2003-01"
    # a purely seasonal series is forecast exactly
    assert [r["prediction"] for r in fut][:3] == pytest.approx([100.0, 101.0, 102.0], abs=1e-6)


def test_seasonal_naive_future(spark):
    rows = [("A", f"{2000 + m // 12}-{m % 12 + 1:02d}", float(m)) for m in range(30)]
    s = spark.createDataFrame(rows, "series_id string, year_month string, value double")
    fut = (FC.seasonal_naive(s).where("kind = 'forecast'").orderBy("h").collect())
    assert [r["prediction"] for r in fut] == [float(v) for v in range(18, 30)]
    assert fut[0]["year_month"] == "2002-07"


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)] * 12, "target_churn_3m int")
    w = MD.class_weights(df).groupBy("target_churn_3m").agg(F.sum("_w")).collect()
    tot = {r[0]: r[1] for r in w}
    assert tot[1] == pytest.approx(tot[0])


def test_incremental_panel_equals_batch(spark):
    streamed = ST.run(spark, SF_SMALL)
    batch = ST.merge(ST.event_partials(spark.read.parquet(f"{SF_SMALL}/events.parquet")))
    a = sorted(tuple(r) for r in streamed.collect())
    b = sorted(tuple(r) for r in batch.collect())
    assert len(a) == len(b) and len(a) > 0
    for x, y in zip(a, b):
        assert x[:2] == y[:2] and x[2:] == pytest.approx(y[2:])


def test_ledger_filters(spark):
    ranking = spark.createDataFrame(
        [(1, "Acme Corp", "Ann", "Annual", 10.0, False, 0.8, "High"),
         (2, "Beta LLC", "Bob", "Monthly", 20.0, False, 0.1, "Low"),
         (3, "acme west", "Bob", "Monthly", 30.0, False, 0.4, "Medium"),
         (4, "Gone Inc", "Ann", "Annual", 40.0, True, 0.9, "High")],
        "client_id long, client_name string, account_manager string, contract_type string, "
        "monthly_recurring_revenue double, is_churned boolean, "
        "predicted_churn_probability double, risk_tier string")
    ids = lambda df: sorted(r["Client ID"] for r in df.collect())
    assert ids(DE.risk_ledger(ranking)) == [1, 2, 3]
    assert ids(DE.risk_ledger(ranking, search="ACME")) == [1, 3]
    assert ids(DE.risk_ledger(ranking, search="ac.e w")) == [3]          # a regex, as pandas
    assert ids(DE.risk_ledger(ranking, tiers=["High", "Medium"], managers=["Bob"])) == [3]
    row = DE.risk_ledger(ranking, search="Acme Corp").first()
    assert row["MRR ($)"] == "$10.00" and row["Churn Probability"] == "80.0%"


def test_streamed_client_panel_equals_batch(spark):
    from churnlens.operators import panel as PA
    from churnlens.sources import adapters as A
    clients = A.clients_view(spark, SF_SMALL)
    streamed = ST.run_client_panel(spark, SF_SMALL, clients)
    batch = PA.client_month_panel(A.transactions_view(spark, SF_SMALL), clients)
    a = sorted(tuple(r) for r in streamed.collect())
    b = sorted(tuple(r) for r in batch.collect())
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        assert x[:2] == y[:2] and x[2:] == pytest.approx(y[2:])


def test_streams_read_part_files_in_many_batches(spark, tmp_path):
    """The same panels from folders of part files, at least three batches each, and after a replay."""
    from churnlens.operators import panel as PA
    from churnlens.sources import adapters as A
    for name, n in (("events", 4), ("orders", 3), ("lineitem", 5)):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").repartition(n).write.parquet(f"{tmp_path}/{name}.parquet")
    close = lambda x, y: [r[:2] for r in x] == [r[:2] for r in y] and all(
        p[2:] == pytest.approx(q[2:]) for p, q in zip(x, y))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    batch = rows(ST.merge(ST.event_partials(spark.read.parquet(f"{SF_SMALL}/events.parquet"))))
    work = f"{tmp_path}/work"
    assert close(rows(ST.run(spark, str(tmp_path), files_per_batch=1, work_dir=work)), batch)
    assert len(list((tmp_path / "work/partials").glob("epoch=*"))) == 4
    # an epoch that runs again replaces its partials
    again = spark.read.parquet(f"{work}/partials/epoch=1")
    again.cache().count()
    again.write.mode("overwrite").parquet(f"{work}/partials/epoch=1")
    assert close(rows(ST.run(spark, str(tmp_path), files_per_batch=1, work_dir=work)), batch)
    clients = A.clients_view(spark, SF_SMALL)
    want = rows(PA.client_month_panel(A.transactions_view(spark, SF_SMALL), clients))
    assert close(rows(ST.run_client_panel(spark, str(tmp_path), clients, files_per_batch=1)), want)


def test_missing_stream_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)not exist|FileNotFound"):
        ST.run(spark, str(tmp_path))


def test_null_faults(spark):
    from churnlens.functions import expr as X
    from churnlens.operators import calendar as CA
    from churnlens.operators import labels as LB
    row = spark.sql("select cast(null as double) as x, 250.0D as y").select(
        X.clip("x", -100, 100).alias("x"), X.clip("y", -100, 100).alias("y")).first()
    assert row["x"] is None and row["y"] == 100
    clients = spark.createDataFrame(
        [(1, "Annual", "Cloud;Backup", None, None, 1.0), (2, "Monthly", "Cloud", dt.date(2000, 3, 5), None, 2.0)],
        "client_id long, contract_type string, services_subscribed string, contract_start_date date, "
        "churn_date date, contract_value double")
    rules = CA.client_rules(clients, "1999-01-01", "2000-06-30")
    got = {r["client_id"]: r for r in rules.collect()}
    assert got[1]["tenure_months"] is None and got[1]["active_start"] is None and got[1]["months_active"] is None
    assert got[2]["tenure_months"] == 3 and got[1]["service_list"] == "Backup, Cloud"
    assert {r["client_id"] for r in CA.billing_calendar(rules).collect()} == {2}
    big = spark.createDataFrame([(2 * 10**15,), (9 * 10**18,), (-5,), (272_000,)], "client_id long")
    assert LB.group_split(big).where("split is null").count() == 0
    ints = spark.createDataFrame([(272_000,)], "client_id int")
    assert LB.group_split(ints).first()["split"] == LB.group_split(big).where("client_id = 272000").first()["split"]


def test_newer_months_are_kept_and_half_months_only_leave_the_models(spark):
    panel = spark.createDataFrame([("EU", "2031-05", 1.0), ("EU", "2031-06", 2.0)],
                                  "region string, year_month string, invoiced_amt double")
    series = FC.monthly_series(panel, "region")
    assert {(r[0], r[1]) for r in series.collect()} == {(s, m) for s in ("EU", "ALL") for m in ("2031-05", "2031-06")}
    tx = lambda day: spark.createDataFrame(
        [("invoice", dt.date(2031, 5, 3)), ("invoice", day), ("usage-log", dt.date(2031, 9, 9))],
        "transaction_type string, transaction_date date")
    half = FC.complete_months(series, FC.last_complete_month(tx(dt.date(2031, 6, 10))))
    whole = FC.complete_months(series, FC.last_complete_month(tx(dt.date(2031, 6, 30))))
    assert {r["year_month"] for r in half.collect()} == {"2031-05"}
    assert {r["year_month"] for r in whole.collect()} == {"2031-05", "2031-06"}


def test_median_of_nan(spark):
    from churnlens.operators.ordering import exact_median
    df = spark.createDataFrame([(3.0,), (float("nan"),), (1.0,), (2.0,), (5.0,), (None,)], "x double")
    assert exact_median(df, "x") == 2.5


def test_rewritten_input_gets_new_products(spark, tmp_path):
    from churnlens.plans import catalog as C
    import time
    spark.range(3).write.parquet(f"{tmp_path}/orders.parquet")
    first = C.input_state(spark, str(tmp_path))
    assert first == C.input_state(spark, str(tmp_path))
    time.sleep(0.01)
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert first != C.input_state(spark, str(tmp_path))
