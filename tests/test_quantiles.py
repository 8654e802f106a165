"""Exact quantiles (both methods) against numpy's linear interpolation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import profile as prof


@pytest.mark.parametrize("method", ["rank", "bracket"])
def test_exact_quantiles_match_numpy(spark, method):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=4000), np.full(2000, 1.5), rng.integers(0, 5, 1000)])
    groups = ["a" if i % 2 else "b" for i in range(len(vals))]
    df = spark.createDataFrame([(g, float(v)) for g, v in zip(groups, vals)], "g string, value double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = prof.quantiles_long(df, probs, group_cols=["g"], method=method).collect()
    arr = {g: np.array([v for gg, v in zip(groups, vals) if gg == g]) for g in ("a", "b")}
    for r in got:
        assert r["quantile"] == pytest.approx(np.quantile(arr[r["g"]], r["prob"]), abs=1e-12)
    assert len(got) == 2 * len(probs)


def test_iqr_outlier_count(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0, -50.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = prof.iqr_outliers(df, ["x"]).first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert r["n_outliers"] == sum(v < lo or v > hi for v in vals)


def test_box_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 40.0]
    df = spark.createDataFrame([("k", v) for v in vals], "g string, v double")
    r = prof.box_stats(df, "v", ["g"]).first()
    assert r["upper_whisker"] == 5.0 and r["lower_whisker"] == 1.0 and r["n_outliers"] == 1


def test_hash_sample_equals_plain_top_n(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    got = {r["o_orderkey"] for r in prof.hash_sample(o, ["o_orderkey"], 300).collect()}
    h = F.xxhash64("o_orderkey", F.lit(42))
    ref = {r["o_orderkey"] for r in o.orderBy(h, "o_orderkey").limit(300).collect()}
    assert got == ref and len(got) == 300
