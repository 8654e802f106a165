"""Stage functions end to end on the small fixture."""

from pyspark.sql import functions as F

from quarry.plans.stages import ingest, prepare, profile_train

SF = "/root/testdata/sf0.001"


def test_ingest_profile_prepare(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    ing = ingest(orders, "o_totalprice", "o_orderdate", ["o_orderkey"])
    rep = ing.report.first()
    assert rep["train_rows"] + rep["val_rows"] + rep["test_rows"] == orders.count()
    assert rep["problem_type"] == "regression"
    train = ing.split.filter("split = 'train'").drop("split")
    prof = profile_train(train, "o_totalprice")
    r = prof.report.first()
    assert r["n_numeric_features"] == 2 and r["target_stats"]["target_mean"] > 0
    assert {"target_histogram", "feature_histograms", "value_counts"} <= set(prof.charts)
    assert prof.charts["target_histogram"].agg(F.sum("n")).first()[0] == train.count()
    report, pruned = prepare(ing.split, "o_totalprice", order_cols=["o_orderdate"],
                             tie_break=["o_orderkey"])
    assert "split" in pruned.columns and report.first()["train_rows"] == rep["train_rows"]


def test_run_all_writes_every_output(spark):
    import os
    import tempfile

    from quarry.plans.stages import run_all
    out = tempfile.mkdtemp(prefix="quarry-run-")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    res = run_all(orders, "o_totalprice", "o_orderdate", ["o_orderkey"], ["o_orderkey"], out,
                  folds=2)
    for name in ("ingestion", "eda", "preparation", "evaluation", "splits", "prepared", "leaderboard", "model",
                 "charts/target_histogram", "charts/target_box", "charts/feature_histograms",
                 "charts/target_corr", "charts/value_counts", "charts/category_vs_target", "charts/missing_counts",
                 "charts/top_outliers", "charts/correlation", "charts/feature_vs_target", "outliers", "template",
                 "evaluation_tables/importance", "evaluation_tables/actual_vs_predicted",
                 "evaluation_tables/residual_histogram", "evaluation_tables/fit_range"):
        assert os.path.exists(os.path.join(out, name)), name
    ev = res["evaluation"].first()
    assert ev["test_rows"] == res["ingestion"].first()["test_rows"]
    assert set(ev["metrics"]) >= {"rmse", "mae", "mse", "r2_score", "adjusted_r2", "mape"}
    assert spark.read.parquet(os.path.join(out, "splits")).filter("split = 'test'").count() \
        == ev["test_rows"]
