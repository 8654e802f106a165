"""Target statistics, least squares from sums, and the time limit."""

import time

import numpy as np
import pytest
from pyspark.ml import regression as reg
from pyspark.sql import functions as F

from quarry.operators import encoding
from quarry.operators import modeling as mdl
from quarry.operators.least_squares import LeastSquares


@pytest.mark.parametrize("values", [300, 3000])
def test_statistics_are_out_of_fold_means(spark, values):
    df = spark.range(9000).selectExpr("id", f"case when id % 50 = 0 then null else concat('v', hash(id) % {values}) end c",
                                      "cast(id % 17 as double) y", "cast(hash(id, 5) & 3 as int) f").checkpoint()
    stats, out = encoding.learn(df, ["c"], [F.col("y")], "f")
    rows = out.collect()
    assert len(rows) == 9000 and stats.columns == ["c"]
    sums, folds = {}, {}
    for r in rows:
        for table, key in ((sums, (r.c, r.f)), (folds, r.f)):
            n, s = table.get(key, (0, 0.0))
            table[key] = (n + 1, s + r.y)
    n_all, s_all = len(rows), sum(r.y for r in rows)
    per = {}
    for (c, _), (n, s) in sums.items():
        a, b = per.get(c, (0, 0.0))
        per[c] = (a + n, b + s)
    for r in rows[::7]:
        n, s = per[r.c][0] - sums[r.c, r.f][0], per[r.c][1] - sums[r.c, r.f][1]
        prior = (s_all - folds[r.f][1]) / (n_all - folds[r.f][0])
        assert r["_ts_c"] == pytest.approx((s + 10 * prior) / (n + 10))
    new = spark.createDataFrame([("never seen",), (None,)], "c string")
    got = {r.c: r["_ts_c"] for r in encoding.apply(new, stats).collect()}
    assert got["never seen"] == pytest.approx(s_all / n_all)
    assert got[None] == pytest.approx((per[None][1] + 10 * s_all / n_all) / (per[None][0] + 10))


def test_wide_categoricals_carry_the_model_through_save_and_load(spark, tmp_path):
    df = spark.range(12000).selectExpr("id", "concat('c', hash(id) % 3000) c", "concat('k', id % 3) k",
                                       "cast((hash(id) % 3000) as double) + (id % 3) * 100 y").checkpoint()
    train, val = df.filter("id % 5 < 4"), df.filter("id % 5 = 4")
    pool = {k: v for k, v in mdl.model_pool("regression").items() if k in ("linear", "tree")}
    t = mdl.run_tournament(train, val, "y", "regression", ["id"], folds=3, pool=pool, exclude=("id",))
    assert t.spec.hashed == [] and t.spec.encoded == ["_ts_c", "_ts_k"]
    assert min(m.score_val for m in t.members.values()) > 0.5  # about three rows a value
    mdl.save(t, str(tmp_path / "m"), spark)
    again = mdl.load(str(tmp_path / "m"), spark)
    a = {r.id: r.prediction for r in mdl.predict(val, t).collect()}
    b = {r.id: r.prediction for r in mdl.predict(val, again).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)
    assert mdl.predict(val, t).columns == [*val.columns, "prediction"]


def test_multiclass_statistics(spark):
    df = spark.range(3000).selectExpr("id", "concat('c', id % 40) c", "cast(id % 3 as string) y").checkpoint()
    pool = {"tree": mdl.model_pool("multiclass", 3)["tree"]}
    t = mdl.run_tournament(df.filter("id % 4 > 0"), df.filter("id % 4 = 0"), "y", "multiclass", ["id"], folds=2,
                           pool=pool, exclude=("id",))
    assert t.spec.encoded == ["_ts_c_0", "_ts_c_1", "_ts_c_2"]
    probs = mdl.predict_proba(df, t).select("prob_0", "prob_1", "prob_2").first()
    assert sum(probs) == pytest.approx(1.0)


def test_least_squares_equals_numpy_on_each_complement(spark):
    rng = np.random.default_rng(0)
    n = 800
    x = rng.normal(size=(n, 4)) * [1, 1e3, 1e-3, 1] + [0, 1e6, 0, 5]
    y = x @ [2, 0.01, 500, -1] + rng.normal(size=n)
    x[rng.random((n, 4)) < [0, 0.2, 0, 0.1]] = np.nan
    fold = rng.integers(0, 3, n)
    rows = [(*[None if np.isnan(v) else float(v) for v in r], 7.0, float(t), int(f)) for r, t, f in zip(x, y, fold, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, y double, f int")
    models = LeastSquares().fit(df, [f"`{c}`" for c in "abcde"], "y", "f", 3)
    probe = df.filter("b is null or a > 1").limit(60).collect()
    for j, model in enumerate(models):
        rest = x[fold != j]
        mean = np.nanmean(rest, axis=0)
        filled = np.where(np.isnan(rest), mean, rest)
        b, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(rest)), filled - mean]), y[fold != j], rcond=None)
        got = model.transform(spark.createDataFrame(probe, df.schema)).collect()
        for r in got:
            own = np.array([mean[k] if r[k] is None else r[k] for k in range(4)])
            assert r["_pred"] == pytest.approx(b[0] + (own - mean) @ b[1:], rel=1e-6, abs=1e-6)


def test_running_fits_end_at_the_time_limit(spark):
    df = spark.range(60000).selectExpr("id", "rand(1) a", "rand(2) b", "rand(3) c", "rand(4) y").checkpoint()
    train, val = df.filter("id % 5 < 4"), df.filter("id % 5 = 4")
    slow = lambda f, l: reg.GBTRegressor(featuresCol=f, labelCol=l, maxIter=400, maxDepth=8)
    pool = {"linear": mdl.model_pool("regression")["linear"], "slow": (slow, False)}
    mdl.run_tournament(train, val, "y", "regression", ["id"], folds=2, pool={"linear": pool["linear"]}, exclude=("id",))
    began = time.time()
    t = mdl.run_tournament(train, val, "y", "regression", ["id"], folds=2, pool=pool, exclude=("id",), budget_s=12)
    assert time.time() - began < 45 and list(t.members) == ["linear"] and t.best in ("linear", "weighted_ensemble")
    assert spark.range(10).count() == 10  # later jobs run
