"""Tree fits on binned blocks: the models of Spark ML, exact sums, and few passes over the rows."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from churnlens.operators import models as MD
from churnlens.operators import trees as TR

COMMON = dict(featuresCol="scaled", labelCol=MD.LABEL, weightCol="_w", seed=42)


def rows(spark, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 2, n), rng.integers(0, 5, n) - 2.0, np.full(n, 7.0),
                  np.round(rng.exponential(size=n), 1), rng.normal(size=n) ** 3], axis=1)
    y = (rng.random(n) < 1 / (1 + np.exp(2.5 - x[:, 0] * 1.3 - x[:, 2] * 0.7 + x[:, 1]))).astype(int)
    df = spark.createDataFrame([(int(b), [float(v) for v in a], 3.25 if b else 1.0) for a, b in zip(x, y)],
                               f"{MD.LABEL} int, x array<double>, _w double")
    return df.select(MD.LABEL, array_to_vector("x").alias("scaled"), "_w").repartition(3).cache()


def scores(model, df):
    return np.array([r[0] for r in model.transform(df).select(vector_to_array("probability")[1]).collect()])


def test_boosted_trees_are_spark_mls(spark, monkeypatch):
    """Also where the candidate splits come from a sample, and margins are kept and started again."""
    monkeypatch.setattr(TR, "KEEP", 2)
    monkeypatch.setattr(TR, "REFRESH", 4)
    monkeypatch.setattr(TR, "BLOCK", 300)
    for df in (rows(spark), rows(spark, 14000)):
        est = GBTClassifier(maxIter=6, maxDepth=3, stepSize=0.2, **COMMON)
        data = TR.Binned()
        mine, theirs = TR.Fit(est, data).fit(df), est.fit(df)
        data.free()
        assert mine.getNumTrees == theirs.getNumTrees == 6 and mine.treeWeights == theirs.treeWeights
        assert scores(mine, df) == pytest.approx(scores(theirs, df), abs=1e-8)
        assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-8)


def test_forest_is_as_good_as_spark_mls(spark):
    """Other draws, so other trees; the same depth and about the same scores, again the same on a second fit."""
    df = rows(spark, 6000)
    est = RandomForestClassifier(numTrees=40, maxDepth=4, **COMMON)
    fits = [TR.Fit(est, TR.Binned()).fit(df) for _ in range(2)]
    theirs = est.fit(df)
    a, b, c = (scores(m, df) for m in (*fits, theirs))
    assert (a == b).all() and abs(a - c).mean() < 0.03 and np.corrcoef(a, c)[0, 1] > 0.98
    assert fits[0].getNumTrees == 40 and max(t.depth for t in fits[0].trees) == 4
    assert fits[0].featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.06)


def test_bag_is_poisson():
    n = 400_000
    drawn = TR.bag(42, 1, (0, 0), n)
    assert (drawn == TR.bag(42, 1, (0, 0), n)).all() and (drawn != TR.bag(42, 2, (0, 0), n)).any()
    assert np.bincount(drawn, minlength=4)[:4] / n == pytest.approx(np.exp(-1.0) / np.array([1, 1, 2, 6]), abs=0.004)
    assert drawn.mean() == pytest.approx(1.0, abs=0.01)


def test_level_sums_equal_plain_sums():
    """Joint bins, sub-blocks and their order change nothing: the sums are exact."""
    rng = np.random.default_rng(1)
    packing = TR.Packing([32, 5, 1, 17, 2, 2, 32])
    assert all(sum(packing.bits[f] for f in g) <= TR.JOINT for g in packing.groups) and 2 not in packing.where
    blocks, plain = [], np.zeros((2, 3, 7, 32))
    tree, unit = TR.Tree({0: TR.Split(0, 11, 1.0)}), 2.0 ** -30
    label, weights = np.array([0.0, 1.0]), np.array([1.0, 9.75])
    for at in range(3):
        n = 200 + at
        bins = [rng.integers(0, k, n) for k in packing.bins]
        kind, margin = rng.integers(0, 2, n).astype(np.uint8), rng.normal(size=n)
        blocks.append(TR.Block((0, at), packing.packed(bins, n), kind, margin))
        wr = weights[kind] * TR.residuals(kind, margin, label)
        for f in range(7):
            for i in range(n):
                if packing.bins[f] > 1:
                    plain[int(bins[0][i] > 11), :, f, bins[f][i]] += (weights[kind[i]], wr[i], wr[i] ** 2 / weights[kind[i]])
    got = TR.level_sums(blocks, packing, tree, 1, [1, 2], label, weights, unit)
    assert got == pytest.approx(plain, abs=1e-5)
    again = TR.level_sums(blocks[::-1], packing, tree, 1, [1, 2], label, weights, unit)
    assert (got == again).all()


def test_fits_share_blocks_and_pass_each_level_once(spark):
    """The rows are binned once for both kinds of trees, and only packed blocks are passed over."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = rows(spark, 1200)
    counted = df.select(MD.LABEL, vector_to_array("scaled").alias("x"), "_w").mapInArrow(
        seen, f"{MD.LABEL} int, x array<double>, _w double").select(MD.LABEL, array_to_vector("x").alias("scaled"), "_w")
    data = TR.Binned()
    TR.Fit(GBTClassifier(maxIter=3, maxDepth=3, **COMMON), data).fit(counted)
    TR.Fit(RandomForestClassifier(numTrees=3, maxDepth=3, **COMMON), data).fit(counted)
    data.free()
    assert read.value <= 3 * 1200      # classes, candidate splits, blocks


def test_rows_without_a_split_or_with_many_weights(spark):
    flat = spark.createDataFrame([(i % 2, [1.0, 2.0], 1.0) for i in range(20)], f"{MD.LABEL} int, x array<double>, _w double")
    many = spark.createDataFrame([(i % 2, [float(i), 2.0], 1.0 + i) for i in range(600)],
                                 f"{MD.LABEL} int, x array<double>, _w double")
    for df in (flat, many):
        df = df.select(MD.LABEL, array_to_vector("x").alias("scaled"), "_w")
        est = GBTClassifier(maxIter=2, maxDepth=2, **COMMON)
        assert scores(TR.Fit(est, TR.Binned()).fit(df), df) == pytest.approx(scores(est.fit(df), df))


def test_scaling_and_grid_are_one_pass_and_unchanged(spark):
    """The moments come as one row a task, and equal those of SQL's aggregates."""
    from churnlens.operators import smote as SM
    rng = np.random.default_rng(5)
    names = [f"f{i}" for i in range(26)]
    df = spark.createDataFrame([tuple(None if (i + j) % 11 == 0 else float(v) for j, v in enumerate(r)) for i, r in enumerate(
        np.round(rng.normal(1e4, 3, (400, 26)), 8))], ", ".join(f"{f} double" for f in names)).repartition(4)
    want = df.select(*[F.round(F.avg(SM.rounded(f)), 6).alias(f"m{f}") for f in names],
                     *[F.round(F.stddev_pop(SM.rounded(f)), 6).alias(f"s{f}") for f in names]).first()
    scale = SM.scaling(df, names)
    assert [v for f in names for v in scale[f]] == pytest.approx([v for f in names for v in (want[f"m{f}"], want[f"s{f}"])],
                                                                 abs=2e-6)
    plain = [F.floor((SM.rounded(f) - F.lit(m)) / F.lit(s) * SM.GRID + 0.5) for f, (m, s) in scale.items()]
    both = SM.on_grid(df, scale).select("z", F.array(*plain).alias("p")).collect()
    assert all(list(r.z) == list(r.p) for r in both)


def test_synthetic_rows_are_made_in_several_tasks(spark, monkeypatch):
    """Few seeds make many rows: the tasks are as many as the rows made ask for, and the rows stay the same."""
    from churnlens.operators import smote as SM
    keys = ["client_id", "year_month"]
    df = spark.createDataFrame([(i, "2020-01", int(i < 6), [37 * i, i * i, -i]) for i in range(400)],
                               "client_id long, year_month string, y int, z array<long>")
    near = SM.nearest(df.where("y = 1"), keys)
    few = SM.balanced(df, near, ["a", "b", "c"], keys, "y")
    monkeypatch.setattr(SM, "MADE", 50)
    many = SM.balanced(df, near, ["a", "b", "c"], keys, "y")
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert ", 8), REPARTITION_BY_NUM" in plan, plan
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) and few.count() == 2 * 394
