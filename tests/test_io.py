"""Sources and sinks: CSV with quoted commas round-trips, append, guarded read
of a missing path, model save/load."""

import os
import tempfile

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from churnlens.operators import models as MD
from churnlens.sources import io as IO
from churnlens.sources.schemas import RISK_RANKING


def _scratch():
    return tempfile.mkdtemp(prefix="churnlens-io-")


def test_csv_round_trip_with_quotes_and_nulls(spark):
    rows = [("C1", 'Acme, "The" Corp', "Ann", 10.0, "Annual", False, 0.5, "Medium"),
            ("C2", "Plain", "Bob", None, "Monthly", True, None, None)]
    df = spark.createDataFrame(rows, RISK_RANKING)
    path = os.path.join(_scratch(), "ranking")
    IO.write_table(df, path, fmt="csv")
    IO.write_table(df.where("client_id = 'C1'"), path, fmt="csv", mode="append")  # S5
    back = IO.read_csv(spark, path, RISK_RANKING)
    got = sorted(tuple(r) for r in back.where(F.col("client_id") == "C2").collect())
    assert got == [rows[1]]                                             # empty field -> NULL
    names = {r["client_name"] for r in back.collect()}
    assert 'Acme, "The" Corp' in names
    assert back.count() == 3
    assert IO.row_count(back, "client_id") == 3                        # S3


def test_guarded_read_missing_path(spark):
    df = IO.guarded_read(spark, os.path.join(_scratch(), "nothing-here"), RISK_RANKING)
    assert df.count() == 0 and df.schema == RISK_RANKING


def test_model_save_load(spark):
    data = spark.createDataFrame([(float(i), float(i % 2), i % 2) for i in range(40)],
                                 "a double, b double, target_churn_3m int")
    data = data.withColumn("_w", F.lit(1.0))
    est = LogisticRegression(featuresCol="scaled", labelCol="target_churn_3m", weightCol="_w")
    model = MD.pipeline(["a", "b"], est).fit(data)
    path = os.path.join(_scratch(), "model")
    MD.save(model, path)
    again = MD.load(path)
    a = [r[0] for r in MD.score(model, data, ["a", "b"]).select(MD.SCORE).collect()]
    b = [r[0] for r in MD.score(again, data, ["a", "b"]).select(MD.SCORE).collect()]
    assert a == b
