"""Matching of rows and donors: ties, missing values and many units."""

import hashlib
import math

from pyspark.sql import functions as F

from quarry.operators import importance as imp
from quarry.session import batches_by_rows


def expected(data, features, repeats, seed):
    """Brute force: donors of equal digests in the order of their values, nulls first and NaN last."""
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    order = lambda v: (v is not None, v is not None and v != v, 0 if v is None or v != v else v)
    placed = sorted(data, key=lambda r: digest(f"{r[0]}|{seed}"))
    out = {}
    for f, c in enumerate(features):
        for n in range(repeats):
            donors = sorted(data, key=lambda r: (digest(f"{r[0]}|{seed}|{f}|{n}"), order(r[c])))
            out[f, n] = [(r[0], d[c]) for r, d in zip(placed, donors, strict=True)]
    return out


def test_equal_keys_and_missing_values_are_matched_in_order(spark):
    nan = math.nan
    data = [(i // 4, [None, nan, 2.5, float(-i)][i % 4], f"t{(i * 7) % 5}" if i % 3 else None) for i in range(400)]
    df = spark.createDataFrame(data, "k int, b double, c string").repartition(5)
    rows = imp.permuted_variants(df, ["k"], ["b", "c"], 2, 42).collect()
    assert len(rows) == 400 * 5
    told = lambda v: "NaN" if v != v else v
    for (f, n), want in expected(data, (1, 2), 2, 42).items():
        got = sorted((r["k"], str(told(r["bc"[f]]))) for r in rows if (r["_q_f"], r["_q_r"]) == (f, n))
        assert got == sorted((k, str(told(v))) for k, v in want)


def test_many_units_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(imp, "UNIT_ROWS", 50)
    df = spark.range(3000).select("id", (F.col("id") % 9).cast("int").alias("a"), F.col("id").cast("timestamp").alias("b"))
    out = imp.permuted_variants(df, ["id"], ["a", "b"], 1, 1)
    rows = out.collect()
    assert out.schema.names == ["id", "a", "b", "_q_f", "_q_r"] and len(rows) == 9000
    data = [(r["id"], r["a"], r["b"]) for r in df.collect()]
    for (f, _), want in expected(data, (1, 2), 1, 1).items():
        assert {r["id"]: r["ab"[f]] for r in rows if r["_q_f"] == f} == dict(want)
    assert {(r["id"], r["a"], r["b"]) for r in rows if r["_q_f"] < 0} == set(data)
    assert imp.permuted_variants(df.filter("id < 0"), ["id"], ["a"], 1, 1).collect() == []


def test_no_sort_or_group_of_the_variants_in_the_plan(spark):
    df = spark.range(200).select("id", F.col("id").cast("int").alias("a"))
    plan = imp.permuted_variants(df, ["id"], ["a"], 3, 1)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Window" not in plan and "Aggregate" not in plan


def test_batches_by_rows_leaves_the_session_as_it_was(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    usual = spark.conf.get(key)
    with batches_by_rows(spark):
        assert spark.conf.get(key) == str(2 ** 31 - 1)
    assert spark.conf.get(key) == usual and key not in spark.conf.getAll
    spark.conf.set(key, "1000000")
    try:
        with batches_by_rows(spark):
            assert spark.conf.get(key) == "1000000"
        assert spark.conf.get(key) == "1000000"
    finally:
        spark.conf.unset(key)
