"""File-stream scoring produces the same predictions as the batch path."""

import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators import modeling as mdl
from quarry.operators.ordering import chronological_split
from quarry.streaming.scoring import scored_stream, start_scoring


def test_stream_scoring_matches_batch(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    split = chronological_split(li, "l_shipdate", ["l_orderkey", "l_linenumber"]).cache()
    train = split.filter("split = 'train'").drop("split")
    val = split.filter("split = 'val'").drop("split")
    pool = {"linear": mdl.model_pool("regression")["linear"]}
    t = mdl.run_tournament(train, val, "l_extendedprice", "regression",
                           ["l_orderkey", "l_linenumber"], folds=1, pool=pool,
                           exclude=("l_orderkey", "l_shipdate"))
    test = split.filter("split = 'test'").drop("split", "l_shipdate")
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    inbox = os.path.join(root, "in")
    test.write.option("header", True).csv(inbox)
    stream = scored_stream(spark, inbox, test.schema, t)
    q = start_scoring(stream, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(root, "out"))
    batch = mdl.predict(test, t).withColumn("ref", F.bround("prediction", 2))
    # the fixture's (order, line) pairs repeat, so compare the multisets of predictions
    got = sorted(r[0] for r in out.select("Predicted_l_extendedprice").collect())
    ref = sorted(r[0] for r in batch.select("ref").collect())
    assert got == ref and len(got) == test.count()
