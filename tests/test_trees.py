"""Regression trees from histograms against Spark ML's, and what they keep."""

import json

import numpy as np
import pytest
from pyspark.ml import regression as reg
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quarry.operators import histograms
from quarry.operators import modeling as mdl
from quarry.operators import trees as hist

INPUTS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """600 values in one column, 7 in another, a constant-free third; a label with steps and noise."""
    df = spark.range(5000).selectExpr(
        "id", "cast(pmod(hash(id, 1), 600) as double) / 8 a", "cast(pmod(hash(id, 2), 7) as double) b",
        "cast(pmod(hash(id, 3), 50000) as double) c", "cast(pmod(hash(id, 4), 3) as int) _fold")
    return df.withColumn("_label", F.col("a") * F.when(F.col("b") > 3, 2.0).otherwise(-1.0)
                         + F.col("c") / 1e4 + F.hash(F.col("id"), F.lit(5)) % 1000 / 1000.0).checkpoint()


@pytest.mark.parametrize("est", [
    reg.DecisionTreeRegressor, reg.GBTRegressor], ids=["tree", "gbt"])
def test_fits_equal_spark_ml_on_each_complement(spark, rows, est):
    more = {"maxIter": 6, "maxDepth": 4} if est is reg.GBTRegressor else {"maxDepth": 6}
    asked = est(featuresCol="v", labelCol="_label", predictionCol="_pred", maxBins=64, seed=42, **more)
    assert hist.fits(asked)
    blocks = hist.blocks_of(rows, INPUTS, "_label", "_fold", 3, 64, 42)
    vectors = VectorAssembler(inputCols=INPUTS, outputCol="v").transform(rows)
    for j, model in enumerate(hist.fit(asked, blocks, INPUTS, 3)):
        own = asked.copy().fit(vectors.filter(F.col("_fold") != j)).transform(vectors).select("id", "_pred").collect()
        got = {r["id"]: r["_pred"] for r in model.transform(rows).select("id", "_pred").collect()}
        assert got == pytest.approx({r["id"]: r["_pred"] for r in own}, rel=1e-9, abs=1e-9)
    blocks.rdd.unpersist()


def test_forest_is_a_mean_of_bootstrapped_trees(spark, rows):
    rows = rows.withColumn("_label", F.col("a") / 5 + F.col("b") * 2 + F.col("c") / 4000).checkpoint()
    asked = reg.RandomForestRegressor(featuresCol="v", labelCol="_label", predictionCol="_pred", maxBins=64, numTrees=20,
                                      maxDepth=6, seed=42)
    blocks = hist.blocks_of(rows, INPUTS, "_label", "_fold", 3, 64, 42)
    models = hist.fit(asked, blocks, INPUTS, 3)
    again = hist.fit(asked, blocks, INPUTS, 3)
    blocks.rdd.unpersist()
    assert [m.getOrDefault(m.trees) for m in models] == [m.getOrDefault(m.trees) for m in again]
    vectors = VectorAssembler(inputCols=INPUTS, outputCol="v").transform(rows)
    theirs = asked.copy().fit(vectors.filter("_fold != 0")).transform(vectors)
    error = lambda df: df.filter("_fold = 0").agg(F.avg((F.col("_pred") - F.col("_label")) ** 2)).first()[0]
    assert error(models[0].transform(rows)) == pytest.approx(error(theirs), rel=0.2)
    trees = json.loads(models[0].getOrDefault(models[0].trees))["trees"]
    assert len(trees) == 20 and len({json.dumps(t) for t in trees}) == 20
    assert {t["feature"][0] for t in trees} == {0, 1, 2}  # one of three features is tried at a node


def test_bootstrap_draws_are_poisson():
    times = histograms.poisson()
    share = np.bincount(times, minlength=4)[:4] / len(times)
    assert share == pytest.approx([np.exp(-1), np.exp(-1), np.exp(-1) / 2, np.exp(-1) / 6], abs=1e-4)


def test_thresholds_of_few_and_many_values():
    assert hist.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 8).tolist() == [1.5, 2.5]
    assert hist.thresholds(np.array([5.0, 5.0]), 8).tolist() == []
    many = hist.thresholds(np.arange(1000.0), 9)
    assert len(many) == 9 and np.diff(many) == pytest.approx(100, abs=1)


def test_regression_members_take_no_pass_of_spark_ml(spark, rows, monkeypatch, tmp_path):
    for kind in (reg.DecisionTreeRegressor, reg.RandomForestRegressor, reg.GBTRegressor):
        monkeypatch.setattr(kind, "fit", None)  # each of its passes would read every row as objects
    pool = mdl.model_pool("regression")
    train, val = rows.select("id", *INPUTS, F.col("_label").alias("y")).filter("id % 5 > 0"), \
        rows.select("id", *INPUTS, F.col("_label").alias("y")).filter("id % 5 = 0")
    t = mdl.run_tournament(train, val, "y", "regression", ["id"], folds=2, pool=pool, exclude=("id",))
    assert list(t.members) == ["linear", "tree", "forest", "gbt"]
    assert [len(m.fold_models) for m in t.members.values()] == [2] * 4
    assert min(t.members[n].score_val for n in ("tree", "forest", "gbt")) > 0.8
    mdl.save(t, str(tmp_path / "m"), spark)
    again = mdl.load(str(tmp_path / "m"), spark)
    a = {r.id: r.prediction for r in mdl.predict(val, t).collect()}
    assert a == pytest.approx({r.id: r.prediction for r in mdl.predict(val, again).collect()})


def test_what_trees_lack_is_left_to_spark_ml():
    assert not hist.fits(reg.GBTRegressor(lossType="absolute")) and not hist.fits(reg.GBTRegressor(subsamplingRate=0.5))
    assert not hist.fits(reg.DecisionTreeRegressor(minInstancesPerNode=5)) and not hist.fits(reg.LinearRegression())
    assert hist.fits(reg.RandomForestRegressor()) and hist.fits(reg.DecisionTreeRegressor())
