"""The semantic traps listed in the blueprint, each on a tiny inline frame."""


import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.functions import calendar as cal
from quarry.functions.coerce import clean_string, to_double_or_null, to_int_or_zero
from quarry.functions.numeric import circular_add, circular_diff, label_index, round_half_even
from quarry.operators import metrics as met
from quarry.operators import profile as prof
from quarry.operators import quality as qual


def test_moments_constant_and_short_columns(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 4.0), (1.0, 9.0)], "c double, x double")
    m = {r["column_name"]: r for r in prof.moments(df, ["c", "x"]).collect()}
    assert m["c"]["skewness"] == 0.0 and m["c"]["kurtosis"] == 0.0
    s = pd.Series([1.0, 2.0, 4.0, 9.0])
    assert m["x"]["skewness"] == pytest.approx(round(s.skew(), 4))
    assert m["x"]["kurtosis"] == pytest.approx(round(s.kurt(), 4))
    short = prof.moments(df.limit(2), ["x"], with_median=False).first()
    assert short["skewness"] is None and short["kurtosis"] is None


def test_corr_constant_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, float(i), float(i * i)) for i in range(10)], "c double, x double, y double")
    rows = {(r["column_a"], r["column_b"]): r["corr"] for r in prof.corr_pairs(df, ["c", "x", "y"]).collect()}
    assert rows[("x", "c")] is None
    assert rows[("y", "x")] == pytest.approx(np.corrcoef(range(10), [i * i for i in range(10)])[0, 1])


def test_corr_pairwise_complete_with_missing(spark):
    data = [(1.0, 2.0), (2.0, None), (3.0, 7.0), (4.0, 8.0), (None, 1.0)]
    df = spark.createDataFrame(data, "a double, b double")
    got = prof.corr_pairs(df, ["a", "b"]).first()["corr"]
    ref = pd.DataFrame(data, columns=["a", "b"]).corr().loc["b", "a"]
    assert got == pytest.approx(ref)


def test_coercion_rules(spark):
    df = spark.createDataFrame([("6.9",), ("bad",), ("NaN",), (None,), ("-2.5",)], "s string")
    out = df.select(to_int_or_zero("s").alias("i"), to_double_or_null("s").alias("d"),
                    clean_string(F.col("s")).alias("t")).collect()
    assert [r["i"] for r in out] == [6, 0, 0, 0, -2]          # truncation, missing -> 0
    assert [r["d"] for r in out] == [6.9, None, None, None, -2.5]
    assert out[3]["t"] == "nan"


def test_strip_removes_tabs(spark):
    df = spark.createDataFrame([("\t a b \n",)], "s string")
    assert df.select(clean_string("s")).first()[0] == "a b"


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2024-01-07",), ("2024-13-01",), ("x",)], "d string")
    out = [r[0] for r in df.select(cal.parse_timestamp("d")).collect()]
    assert out[0] is not None and out[1] is None and out[2] is None


def test_two_weekend_rules_and_weekday_numbering(spark):
    # 2024-01-05 Friday, 06 Saturday, 07 Sunday, 08 Monday
    df = spark.createDataFrame([(f"2024-01-0{d}",) for d in (5, 6, 7, 8)], "d string") \
              .select(F.to_date("d").alias("d"))
    r = df.select(cal.weekday_monday0("d").alias("n"), cal.weekend_flag("d").alias("w"),
                  cal.weekend_yes_no("d").alias("yn"), cal.weekday_name("d").alias("name")).collect()
    assert [x["n"] for x in r] == [4, 5, 6, 0]
    assert [x["w"] for x in r] == [0, 1, 1, 0]                 # Saturday/Sunday
    assert [x["yn"] for x in r] == ["Yes", "Yes", "No", "No"]  # Friday/Saturday
    assert [x["name"] for x in r] == ["Friday", "Saturday", "Sunday", "Monday"]


def test_r2_is_not_squared_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (3.0, 4.0)], "y double, p double")
    m = met.regression_metrics(df, "y", "p", n_features=1).first()
    assert m["r2"] == pytest.approx(1 - 3.0 / 2.0)           # biased predictor: R^2 < 1
    assert m["adjusted_r2"] == pytest.approx(1 - (1 - m["r2"]) * 2 / 1)
    const = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, p double")
    assert met.regression_metrics(const, "y", "p").first()["r2"] == 0.0


def test_mape_signed_denominator_and_mask(spark):
    df = spark.createDataFrame([(-2.0, -1.0), (0.0, 5.0), (4.0, 2.0)], "y double, p double")
    m = met.regression_metrics(df, "y", "p").first()
    ref = np.mean([abs(-2 + 1) / -2.0, abs(4 - 2) / 4.0]) * 100
    assert m["mape"] == pytest.approx(ref)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    h = {r["bin"]: r["n"] for r in prof.histogram(df, "v", bins=2).collect()}
    assert h == {1: 1, 2: 2}                                   # max falls in the last bin
    const = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    rows = prof.histogram(const, "v", bins=4).collect()
    assert sum(r["n"] for r in rows) == 2 and rows[0]["bin_lo"] >= 2.5


def test_round_half_even(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (0.135,)], "v double")
    got = [r[0] for r in df.select(round_half_even("v", 2)).collect()]
    assert got[1] == 0.12


def test_circular_wrap(spark):
    df = spark.createDataFrame([(1430.0, 20.0, 10.0)], "b double, y double, p double")
    r = df.select(circular_add("b", "y").alias("a"), circular_diff("y", "p").alias("d")).first()
    assert r["a"] == 10.0 and r["d"] == 10.0
    df2 = spark.createDataFrame([(0.0, 700.0)], "y double, p double")
    assert df2.select(circular_diff("y", "p")).first()[0] == -700.0


def test_label_index_unknown_is_null(spark):
    df = spark.createDataFrame([("b",), ("z",)], "s string")
    assert [r[0] for r in df.select(label_index("s", ["a", "b"])).collect()] == [1, None]


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    s = qual.quality_summary(df).first()
    assert s["n_duplicate_rows"] == 1 and s["n_missing"] == 2
