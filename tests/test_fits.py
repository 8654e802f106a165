"""Fits of the tournament: which run side by side, and what forests keep between levels."""

import threading
import time

from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from quarry.operators import modeling as mdl


class Probe:
    """A small tree that notes how many of its member's fits run at once."""

    def __init__(self, seen):
        self.seen, self.lock = seen, threading.Lock()

    def __call__(self, features, label):
        self.tree = DecisionTreeRegressor(featuresCol=features, labelCol=label, maxDepth=1)
        return self

    def setPredictionCol(self, name):
        self.tree.setPredictionCol(name)
        return self

    def fit(self, part):
        with self.lock:
            self.seen["now"] = self.seen.get("now", 0) + 1
            self.seen["most"] = max(self.seen.get("most", 0), self.seen["now"])
        time.sleep(0.3)
        try:
            return self.tree.fit(part)
        finally:
            with self.lock:
                self.seen["now"] -= 1


def test_folds_of_a_member_are_fitted_in_turn(spark):
    base = spark.range(60).select((F.col("id") % 3).cast("int").alias("_fold"), F.col("id").cast("double").alias("x"),
                                  (F.col("id") * 2.0).alias("_label"))
    one, two = {}, {}
    members = mdl._fit_pool(base, mdl.FeatureSpec(["x"], [], "_label", "regression"),
                            {"one": (Probe(one), False), "two": (Probe(two), False)}, "regression", 3, 8, None, time.time())
    assert one["most"] == two["most"] == 1
    assert [len(members[n].fold_models) for n in ("one", "two")] == [3, 3]
    assert [members[n].fit_order for n in ("one", "two")] == [1, 2]


def test_forests_keep_node_ids_and_their_trees(spark):
    rows = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("a"),
                                   (F.col("id") % 5).cast("double").alias("b"))
    data = mdl.Pipeline(stages=mdl.vectorizer(mdl.FeatureSpec(["a", "b"], [], "y", "regression"), True, "f")) \
        .fit(rows).transform(rows.withColumn("y", F.col("a") * 3 + F.col("b") * F.col("a")))
    for kind, label in (("regression", F.col("y")), ("binary", (F.col("y") > 30).cast("double"))):
        frame = data.withColumn("y", label)
        forest = mdl.model_pool(kind)["forest"][0]("f", "y")
        assert forest.getCacheNodeIds()
        kept = forest.fit(frame).toDebugString.split("\n", 1)[1]
        assert kept == forest.copy().setCacheNodeIds(False).fit(frame).toDebugString.split("\n", 1)[1]
