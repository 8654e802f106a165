"""Inputs that used to give wrong or size-dependent results."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import coerce
from quarry.operators import columns, curves, metrics, modeling, ordering, profile, quality
from quarry.sources.delimited import bounded_read, read_batch, read_delimited

NAN = float("nan")


def _file(tmp_path, text, enc="utf-8"):
    path = tmp_path / "in.csv"
    path.write_bytes(text.encode(enc))
    return str(path)


def test_encoding_is_judged_on_the_whole_file(spark, tmp_path):
    text = "name,n\n" + "".join(f"plain,{i}\n" for i in range(500)) + "José,500\n"
    rows = read_delimited(spark, _file(tmp_path, text, "latin-1")).collect()
    assert rows[-1]["name"] == "José" and len(rows) == 501


def test_quotes_line_breaks_and_missing_tokens(spark, tmp_path):
    path = _file(tmp_path, 'a,b,c,d\n"he said ""hi"", ok",1,NA,True\n"two\nlines",NA,2.5,False\nx,3,1e3,True\n')
    df = read_delimited(spark, path)
    assert dict(df.dtypes) == {"a": "string", "b": "bigint", "c": "double", "d": "boolean"}
    assert [tuple(r) for r in df.collect()] == [
        ('he said "hi", ok', 1, None, True), ("two\nlines", None, 2.5, False), ("x", 3, 1000.0, True)]
    assert read_batch(spark, path).first()["c"] is None


def test_bounded_read_keeps_null_keys(spark):
    df = spark.range(100).select(F.when(F.col("id") >= 5, F.col("id")).alias("k"), "id")
    assert [r.k for r in bounded_read(df, ["k", "id"], 3).collect()] == [None, None, None]


def test_wide_categoricals_stay_in_the_model(spark):
    df = spark.range(3000).selectExpr("cast(id % 300 as string) c", "cast(id % 300 as double) y", "id")
    spec = modeling.feature_spec(df, "y", "regression", exclude=("id",))
    assert spec.categorical == ["c"] and spec.hashed == ["c"]
    fitted = modeling.Pipeline(stages=modeling.vectorizer(spec, False, "f")).fit(df)
    assert fitted.transform(df).select("f").distinct().count() > 150


def test_blend_score_with_a_large_offset(spark):
    rng = np.random.default_rng(0)
    y = 1e8 + rng.normal(size=4000)
    p = [y + rng.normal(scale=0.4, size=4000), y + rng.normal(scale=0.5, size=4000)]
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(y, *p)], "y double, a double, b double")
    got = modeling.r2_from_gram(modeling.gram_stats(df, "y", ["a", "b"]), [0.5, 0.5])
    want = 1 - ((y - (p[0] + p[1]) / 2) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert got == pytest.approx(want, abs=1e-6)


def test_metrics_cover_one_set_of_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (None, 5.0), (9.0, NAN)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert (r.n, r.rmse, r.mae, r.r2) == (2, 1.0, 1.0, 0.0)
    empty = metrics.regression_metrics(df.limit(0), "y", "p").first()
    assert empty.n == 0 and empty.rmse is None
    assert metrics.classification_metrics(df.limit(0), "y", "p").first().accuracy is None


def test_one_class_gives_null_not_an_error(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, s double")
    assert curves.auc(df, "y", "s").first().auc is None
    assert {r.fpr for r in curves.roc_curve(df, "y", "s").collect()} == {None}
    assert curves.average_precision(df, "y", "s").first().average_precision == 1.0
    points = curves.pr_curve(df, "y", "s").collect()
    assert (points[-1].threshold, points[-1].recall, points[-1].precision) == (None, 0.0, 1.0)
    by_class = curves.pr_curves_by_class(df, "y", {1: "s", 2: "s"})
    assert by_class.filter("threshold is null").count() == 2
    assert curves.roc_curves_by_class(df, "y", {k: "s" for k in range(20)}).select(
        "class_label").distinct().count() == 20


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(5.0, NAN, 1), (NAN, NAN, 2), (None, None, 2)], "a double, b double, k int")
    r = quality.quality_summary(df).first()
    assert r.n_missing == 5 and r.constant_columns == ["a", "b"] and r.n_duplicate_rows == 1
    assert quality.empty_columns(df) == ["b"]
    assert set(columns.column_roles(df).constant) == {"a", "b"}
    assert profile.kpi(df, "a").first().avg_value == 5.0
    assert {r.k: r.avg_value for r in profile.group_avg(df, "k", "a").collect()} == {1: 5.0, 2: None}


def test_duplicates_with_nulls_in_different_columns(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, None), (None, None)], "a int, b int")
    assert quality.duplicate_rows(df) == 1


def test_constant_column_has_no_correlation(spark):
    df = spark.range(1000).selectExpr("cast(id as double) a", "0.1d b", "cast(id * id as double) c")
    got = {(r.column_a, r.column_b): r["corr"] for r in profile.corr_pairs(df, ["a", "b", "c"]).collect()}
    assert got[("b", "a")] is None and got[("c", "b")] is None and got[("c", "a")] > 0.9


def test_coercion_of_odd_cells(spark):
    cells = ["1e30", "inf", "1d", "1f", " 7 ", " 8　", "-2.9", "abc", None, "nan"]
    df = spark.createDataFrame([(c,) for c in cells], "c string").select(
        coerce.to_int_or_zero("c").alias("i"), coerce.to_double_or_null("c").alias("d"),
        coerce.clean_string("c").alias("s"))
    rows = df.collect()
    assert [r.i for r in rows] == [0, 0, 0, 0, 7, 8, -2, 0, 0, 0]
    assert [r.d for r in rows] == [1e30, float("inf"), None, None, 7.0, 8.0, -2.9, None, None, None]
    assert [r.s for r in rows][4:6] == ["7", "8"]


def test_grids_are_complete(spark):
    df = spark.createDataFrame([("a", "x", 0.0), ("a", "x", 0.1), ("b", "y", 10.0)], "r string, c string, v double")
    assert [r.n for r in profile.histogram(df, "v", 4).orderBy("bin").collect()] == [2, 0, 0, 1]
    assert profile.histograms(df, ["v"], 4).count() == 4
    cells = {(r.row_value, r.col_value): (r.n, r.share) for r in profile.crosstab_norm(df, "r", "c").collect()}
    assert cells == {("a", "x"): (2, 1.0), ("a", "y"): (0, 0.0), ("b", "x"): (0, 0.0), ("b", "y"): (1, 1.0)}


@pytest.mark.parametrize("n, dates, small", [(1, 1, 5), (7, 3, 2), (500, 1, 20), (500, 40, 20), (500, 500, 20)])
def test_split_by_boundaries_equals_the_ranks(spark, n, dates, small):
    rows = [(None if i % 11 == 5 else (i * 7919) % dates, (i * 104729) % n) for i in range(n)]
    df = spark.createDataFrame(rows, "d int, k int").repartition(4)
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    for position in {1, n // 2 + 1, n}:
        assert ordering.key_at(df, ["d", "k"], position, small=small) == order[position - 1]
    got = ordering.chronological_split(df, "d", ["k"])
    want = {r: ("train" if i < int(n * 0.7) else "val" if i < int(n * (0.7 + 0.15)) else "test")
            for i, r in enumerate(order)}
    assert {(r.d, r.k): r.split for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("RoundRobin", "") or "rangepartitioning" not in plan
    assert "InMemory" not in plan and "Sort" not in plan


def test_split_of_equal_keys_across_a_cut_is_exact(spark):
    df = spark.range(10).selectExpr("1 d", "2 k")
    counts = {r.split: r["count"] for r in ordering.chronological_split(df, "d", ["k"]).groupBy("split").count().collect()}
    assert counts == {"train": 7, "val": 1, "test": 2}


SESSION = """
import os, sys
sys.path.insert(0, {root!r})
from quarry.session import get_session, ensure_checkpoint_dir, is_local, submitted_settings
{body}
"""


def _run(body, **env):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", SESSION.format(root=root, body=body)], capture_output=True,
                          text=True, timeout=180, env={**os.environ, **env})
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_submitted_settings_win():
    out = _run("""
s = get_session("local[2]")
print(s.conf.get("spark.sql.shuffle.partitions"), s.conf.get("spark.sql.session.timeZone"),
      s.sparkContext.getConf().get("spark.driver.memory"))
""", PYSPARK_SUBMIT_ARGS="--conf spark.sql.shuffle.partitions=333 --conf spark.sql.session.timeZone=Asia/Dubai "
                         "--conf spark.ui.enabled=false --driver-memory 1g pyspark-shell")
    assert out.split()[-3:] == ["333", "Asia/Dubai", "1g"]


def test_no_scratch_checkpoint_folder_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    from quarry.session import ensure_checkpoint_dir, is_local
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    assert is_local("local[*]") and is_local("local") and not is_local("local-cluster[2,1,1024]")
