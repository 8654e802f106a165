"""Explicit ranges, cumulative counts by value and shared sketches."""

import contextlib
import io
import math
import random
import struct

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.numeric import ordered_bits
from quarry.operators import curves, ordering
from quarry.operators import profile as prof
from quarry.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def persisted(spark) -> int:
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_ordered_bits_are_those_of_the_double(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
              1.7976931348623157e308, math.inf, -math.inf, 0.1, 1 - 2**-53, 2 - 2**-52, 4.0, 3.9999999999999996]
    values += [x for _ in range(4000) if not math.isnan(x := struct.unpack("<d", rng.randbytes(8))[0])]
    rows = spark.createDataFrame([(v,) for v in values], "v double").withColumn("b", ordered_bits("v")).collect()
    for r in rows:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.b == (-bits if r.v < 0 else bits)
    odd = spark.createDataFrame([(math.nan,), (None,)], "v double").select(ordered_bits("v").alias("b")).collect()
    assert [r.b for r in odd] == [(1 << 63) - 1, None]


@pytest.mark.parametrize("order, groups", [(["k", "id"], []), (["id"], ["g"]), (["k", "id"], ["g", "h"])])
def test_first_difference_equals_lag(spark, order, groups):
    df = spark.range(6000).selectExpr("id", "case when id % 3 = 0 then null else id % 7 end g", "'one' h",
                                      "cast(hash(id) % 1000 as double) v", "case when id % 3 = 0 then 0 else id % 97 end k")
    window = Window.partitionBy(*groups).orderBy(*order) if groups else Window.orderBy(*order)
    want = df.withColumn("want", F.col("v") - F.lag("v").over(window)).select("id", "want")
    got = ordering.first_difference(df, "v", order, groups, num_partitions=13)
    both = got.join(want, "id")
    assert both.count() == 6000 and both.filter("not (v_diff <=> want)").count() == 0
    assert got.columns == [*df.columns, "v_diff"]


def test_first_difference_steps_over_empty_ranges(spark, monkeypatch):
    df = spark.createDataFrame([(k, float(k * k)) for k in (1, 2, 50, 51, 90)], "k int, v double")
    monkeypatch.setattr(ordering, "splitters", lambda *a, **b: [(-5,), (0,), (10,), (20,), (30,), (60,), (95,)])
    got = {r.k: r.v_diff for r in ordering.first_difference(df, "v", ["k"]).collect()}
    assert got == {1: None, 2: 3.0, 50: 2496.0, 51: 101.0, 90: 5499.0}


def test_first_difference_of_empty_single_and_null_rows(spark):
    empty = spark.createDataFrame([], "k int, v double")
    assert ordering.first_difference(empty, "v", ["k"]).count() == 0
    df = spark.createDataFrame([(1, None), (2, 3.0), (None, 1.0), (3, 5.0)], "k int, v double")
    got = {r.k: r.v_diff for r in ordering.first_difference(df, "v", ["k"], num_partitions=3).collect()}
    assert got == {None: None, 1: None, 2: None, 3: 2.0}


def test_a_hot_group_is_spread_by_its_order(spark):
    df = spark.range(9000).selectExpr("id", "'hot' g", "cast(id as double) v")
    out = ordering.first_difference(df, "v", ["id"], ["g"], num_partitions=8)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 9000 / 8


def test_differences_need_no_single_partition(spark):
    for name in ("first_difference", "first_difference_by_group"):
        plan = plan_of(QUERIES[name](spark, SF))
        for flag in ("SinglePartition", "InMemoryTableScan", "MapInPandas", "MapInArrow"):
            assert flag not in plan, (name, flag)


@pytest.mark.parametrize("values", ["cast(id % 1000 as double)", "rand(3)", "0.5 + id * 1e-17", "case when id % 3 = 0 then 7D else -id end"])
def test_cumulative_counts_equal_a_window(spark, values):
    df = spark.range(20000).selectExpr("id % 3 g", f"{values} v").checkpoint()
    counts = df.groupBy("g", "v").count()
    for groups in ([], ["g"]):
        base = counts if groups else df.groupBy("v").count()
        for down in (False, True):
            way = F.col("v").desc() if down else F.col("v").asc()
            want = base.withColumn("want", F.sum("count").over(Window.partitionBy(*groups).orderBy(way)))
            got = ordering.cumulate_by_key(base, ordered_bits("v"), ["count"], groups, descending=down)
            assert got.join(want, [*groups, "v"]).filter("upto_count = want").count() == want.count()


@pytest.mark.parametrize("name", ["roc_curve", "pr_curve", "roc_auc", "auc_ovr", "average_precision", "box_stats",
                                  "iqr_outliers", "moments"])
def test_curves_and_quantiles_keep_nothing(spark, name):
    before = persisted(spark)
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    for flag in ("MapInPandas", "InMemoryTableScan", "rangepartitioning"):
        assert flag not in plan, flag
    df.write.format("noop").mode("overwrite").save()
    assert persisted(spark) == before


def test_quantiles_share_one_sketch(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice"]
    shared = prof.column_sketches(df, cols)
    a = prof.moments(df, cols, sketches=shared).select("column_name", "median")
    b = prof.quantiles(df, cols, [0.5], sketches=shared).select("column_name", F.col("quantile").alias("median"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert prof.iqr_outliers(df, cols, sketches=shared).count() == 2


def test_a_rank_outside_its_bracket_counts_every_value(spark, monkeypatch):
    monkeypatch.setattr(prof, "BRACKET", -0.2)  # brackets that hold nothing
    df = spark.range(1, 1002).selectExpr("'a' g", "cast(id as double) value")
    got = {r.prob: r.quantile for r in prof.quantiles_long(df, [0.25, 0.5], ["g"]).collect()}
    assert got == {0.25: 251.0, 0.5: 501.0}


def test_cut_of_a_text_key_needs_no_rank(spark, monkeypatch):
    df = spark.range(60000).selectExpr("case when id % 3 = 0 then 'm' else md5(cast(id as string)) end d", "id")
    monkeypatch.setattr(ordering, "global_rank", None)
    got = ordering.chronological_split(df, "d", ["id"])
    want = df.withColumn("r", F.row_number().over(Window.orderBy("d", "id")))
    both = got.join(want, ["d", "id"]).withColumn(
        "want", F.when(F.col("r") <= 42000, "train").when(F.col("r") <= 51000, "val").otherwise("test"))
    assert both.filter("split = want").count() == 60000


def test_curve_of_no_rows(spark):
    none = spark.createDataFrame([], "y int, s double")
    assert curves.roc_curve(none, "y", "s").count() == 0 and curves.pr_curve(none, "y", "s").count() == 0


def test_top_values_are_exact_with_and_without_a_proof(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc") if k % 2 else f"w{rng.randrange(30000)}", f"u{k}", f"g{k % 7}",
             f"z{int(rng.paretovariate(1.1))}", None) for k in range(40000)]
    df = spark.createDataFrame(rows, "some string, unique string, few string, zipf string, none string")
    cols = ["some", "unique", "few", "zipf", "none"]
    for k in (3, 15):
        got = {c: [(r["value"], r["n"]) for r in prof.value_counts(df, cols, k).filter(F.col("column_name") == c)
                   .orderBy("rank").collect()] for c in cols}
        for i, c in enumerate(cols):
            counts: dict = {}
            for row in rows:
                if row[i] is not None:
                    counts[row[i]] = counts.get(row[i], 0) + 1
            assert got[c] == sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k], (c, k)


def test_proved_columns_shuffle_candidates_only(spark):
    df = spark.range(50000).selectExpr("case when id % 2 = 0 then 'hot' when id % 5 = 0 then 'warm' else md5(cast(id as string)) end v")
    out = prof.value_counts(df, ["v"], 2)
    plan = plan_of(out)
    assert "Expand" not in plan and "Generate" not in plan and "md5" not in plan  # the counted candidates alone
    assert [(r["value"], r["n"]) for r in out.orderBy("rank").collect()] == [("hot", 25000), ("warm", 5000)]


def test_cross_tab_stops_at_many_classes(spark):
    df = spark.range(2000).selectExpr("cast(id % 4 as string) r", "cast(id % 16 as string) c", "cast(id % 15 as string) d")
    assert prof.crosstab_norm(df, "r", "c") is None
    assert prof.crosstab_norm(df, "r", "d").count() == 4 * 15


def test_text_target_with_many_classes_is_reported_bounded(spark):
    from quarry.plans.stages import profile_train
    df = spark.range(100_000).selectExpr("md5(cast(id % 99999 as string)) label", "id % 3 a", "cast(rand(1) as double) b",
                                         "concat('c', id % 4) kind")
    out = profile_train(df, "label")
    row = out.report.first()
    assert row["n_classes"] == 99_999 and len(row["class_counts"]) == 15
    assert out.charts["class_counts"].count() == 99_999 and "category_vs_target" not in out.charts
    assert "correlation" in out.charts or row["n_numeric_features"] < 2


def test_correlations_with_gaps_match_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(3000, 4)) + 1e6, columns=list("abcd"))
    pdf["b"] = pdf["a"] * 2 + rng.normal(size=3000)
    pdf.loc[rng.random(3000) < 0.3, "b"] = np.nan
    pdf.loc[rng.random(3000) < 0.5, "c"] = np.nan
    pdf["e"] = np.where(pdf["c"].isna(), 4.0, 3.0)
    got = {(r.column_a, r.column_b): r["corr"] for r in prof.corr_pairs(spark.createDataFrame(pdf), list("abcde")).collect()}
    want = pdf.corr()
    for (a, b), value in got.items():
        if math.isnan(want.loc[a, b]):
            assert value is None
        else:
            assert value == pytest.approx(want.loc[a, b], abs=1e-9)
    assert len(got) == 10
