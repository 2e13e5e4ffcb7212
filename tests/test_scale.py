"""Steps that must not sort, shuffle or send more than they need: plans and rows on small tables."""

from pyspark.sql import functions as F

from churnlens.operators import boosting as BO
from churnlens.operators import features as FE
from churnlens.operators import knn
from churnlens.operators import panel as PA
from churnlens.operators import smote as SM
from churnlens.plans import catalog as C


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_months_since_upgrade_keeps_the_order_of_the_windows(spark):
    rows = [(1, "2020-01", 0.0), (1, "2020-02", 0.0), (1, "2020-03", 5.0), (1, "2020-05", None), (1, "2020-06", 2.0),
            (2, "2020-01", 1.0), (2, "2020-02", 0.0), (3, "2020-04", None)]
    df = spark.createDataFrame(rows, "client_id long, year_month string, upgrade_amt double").repartition(3)
    out = FE.months_since_upgrade(df)
    got = {(r.client_id, r.year_month): r.months_since_last_upgrade for r in out.collect()}
    assert got == {(1, "2020-01"): 0, (1, "2020-02"): 1, (1, "2020-03"): 0, (1, "2020-05"): 1, (1, "2020-06"): 0,
                   (2, "2020-01"): 0, (2, "2020-02"): 1, (3, "2020-04"): 0}
    assert plan(FE.months_since_upgrade(df)).count("Sort [") == 1


def test_panel_carrying_the_churn_date_gives_the_same_table(spark):
    """One join for revenue and churn date instead of two, also where a client id comes twice or is unknown."""
    tx = spark.createDataFrame(
        [(f"t{i}", c, f"2020-0{m}-15", kind, None if i % 3 else 10.0 * i, "Cloud", "late", 1.0 * i, 1)
         for i, (c, m, kind) in enumerate((c, m, k) for c in (1, 2, 3) for m in (1, 2, 3, 4) for k in PA.KINDS)],
        "transaction_id string, client_id long, transaction_date string, transaction_type string, amount double, "
        "service_line string, payment_status string, usage_units double, notes_flag int").withColumn(
        "transaction_date", F.to_date("transaction_date"))
    names = ["client_id", "monthly_recurring_revenue", *FE.STATIC_COLUMNS, "services_subscribed"]
    clients = spark.createDataFrame(
        [(c, 100.0 * c, f"c{c}", "BUILDING", "Small", None, "Annual", "m", "ASIA", 3, churned is not None, churned, 9, "a;b")
         for c, churned in ((1, None), (2, "2020-02-20"), (2, "2020-02-20"))],
        "client_id long, monthly_recurring_revenue double, client_name string, industry string, client_size string, "
        "contract_start_date date, contract_type string, account_manager string, region string, nps_score int, "
        "is_churned boolean, churn_date string, tenure_months int, services_subscribed string").withColumn(
        "churn_date", F.to_date("churn_date")).select(*names)
    two = FE.model_ready_from_panel(PA.client_month_panel(tx, clients), clients)
    dim = clients.select("client_id", "monthly_recurring_revenue").join(clients.select("client_id", "churn_date"), "client_id")
    one = FE.model_ready_from_panel(PA.client_month_panel(tx, dim, carry=["churn_date"]), clients)
    first = plan(one)   # as planned, before it runs
    assert first.count("SortMergeJoin") == 1 and first.count("Sort [client_id") == 3   # clients' two sides, windows
    assert first.count("ShuffledHashJoin") == 2
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(one) == rows(two) and len(rows(two)) == 4 + 2 * 8 + 4


def test_level_sums_are_added_in_the_tasks(spark):
    """A row is not fanned out by feature, and the sums stay exact beyond float64."""
    big = 2 ** 52 + 1
    rows = [(i % 3, [i % 5, 15 - i % 2, 0], (big if i % 2 else -3) + i, 2_000_000 + i) for i in range(60)]
    df = spark.createDataFrame(rows, "node int, bins array<int>, g long, h long").repartition(4)
    held = {}
    for batch in BO._task_sums(iter(df.toArrow().to_batches())):
        held |= {(r["node"], r["feature"], r["bin"]): (r["g"], r["h"]) for r in batch.to_pylist()}
    want = {}
    for node, bins, g, h in rows:
        for feature, b in enumerate(bins):
            a = want.get((node, feature, b), (0, 0))
            want[node, feature, b] = (a[0] + g, a[1] + h)
    assert held == want
    assert {r.node for r in BO.best_splits(df)} == {0, 1, 2}


def test_whole_numbers_round_to_themselves(spark):
    values = [0.0, -3.0, 7.0, 2.0 ** 60, 1e300, 0.1234565, -0.1234565, 1e-9, 123456.7890125, float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    both = df.select(SM.rounded("x").alias("a"), F.round(F.coalesce("x", F.lit(0.0)), SM.DIGITS).alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both]


def test_neighbour_search_sends_no_vectors_back(spark):
    points = [(i, "m", [100 * i, 0]) for i in range(40)]
    df = spark.createDataFrame(points, "client_id long, year_month string, z array<long>")
    join = knn._Join(df, ["client_id", "year_month"], "z", 5)
    assert "near_z" not in join.found_schema and dict(join.points.dtypes)["z"] == "array<int>"
    full = knn.nearest_neighbours(df, ["client_id", "year_month"], "z").where("client_id = 0").first().near
    assert [n.near_z for n in full] == [[100 * i, 0] for i in range(1, 6)]


def test_repeated_keys_double_no_neighbour(spark):
    points = [(i, "m", [100 * i, 0]) for i in range(12)] + [(3, "m", [300, 0]), (4, "m", [410, 0])]
    df = spark.createDataFrame(points, "client_id long, year_month string, z array<long>")
    near = {r.client_id: r.near for r in knn.nearest_neighbours(df, ["client_id", "year_month"], "z").collect()}
    assert {len(n) for n in near.values()} == {5}
    assert [(n.distance, n.near_client_id, n.near_z) for n in near[2]][:4] == [
        (100 ** 2, 1, [100, 0]), (100 ** 2, 3, [300, 0]), (100 ** 2, 3, [300, 0]), (200 ** 2, 0, [0, 0])]


def test_encoded_rows_are_written_once(spark, tmp_path):
    """Fits, grid and evaluation read a table, not the join with the clients."""
    n = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    n([(0, "AFRICA")], "r_regionkey int, r_name string", "region")
    n([(0, "X", 0)], "n_nationkey int, n_name string, n_regionkey int", "nation")
    n([(k, f"c{k}", 0, 100.0 * k, "BUILDING") for k in range(1, 13)],
      "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", "customer")
    day = F.to_timestamp("o_orderdate").alias("o_orderdate")
    spark.createDataFrame([(k, k % 12 + 1, "O", 10.0 * k, f"1998-0{k % 9 + 1}-03") for k in range(1, 49)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string"
                          ).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day).write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, 1, 5.0, 20.0, 0.1, "A", "F", f"1998-0{k % 9 + 1}-13") for k in range(1, 49)],
                          "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_returnflag string, l_linestatus string, l_shipdate string").withColumn(
        "l_shipdate", F.to_timestamp("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = C.labelled_encoded(spark, str(tmp_path))
    assert "Join" not in plan(rows) and rows.count() == C.labelled(spark, str(tmp_path)).count() > 0
    assert not C.written(spark, str(tmp_path), "panel")
