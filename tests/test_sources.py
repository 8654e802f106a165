"""Delimited sources, fallbacks and sinks."""

import os
import tempfile

import pytest

from quarry.sources.delimited import read_batch, read_delimited, read_with_fallback, sniff_format


def _write(path, text, enc="utf-8"):
    with open(path, "wb") as f:
        f.write(text.encode(enc))


def test_sniff_semicolon_and_latin1(spark):
    d = tempfile.mkdtemp(prefix="quarry-src-")
    p = os.path.join(d, "a.csv")
    _write(p, "name;city;n\nJosé;Zürich;3\nAnn;Köln;4\n", enc="latin-1")
    enc, sep = sniff_format(spark, p)
    assert sep == ";" and enc == "latin-1"
    df = read_delimited(spark, p)
    rows = df.collect()
    assert df.columns == ["name", "city", "n"] and rows[0]["name"] == "José" and rows[1]["n"] == 4


def test_sniff_rejects_single_column(spark):
    d = tempfile.mkdtemp(prefix="quarry-src-")
    p = os.path.join(d, "b.csv")
    _write(p, "onlyone\n1\n2\n")
    with pytest.raises(ValueError):
        sniff_format(spark, p)


def test_batch_read_is_text_and_fallback(spark):
    d = tempfile.mkdtemp(prefix="quarry-src-")
    p = os.path.join(d, "c.csv")
    _write(p, "a,b\n1,x\n2,y\n")
    df = read_batch(spark, p)
    assert dict(df.dtypes) == {"a": "string", "b": "string"}
    got = read_with_fallback(spark, [os.path.join(d, "missing.csv"), p], fmt="csv", header=True)
    assert got.count() == 2
    assert read_with_fallback(spark, [os.path.join(d, "nope")], optional=True) is None


def test_bounded_read_equals_plain_top_n(spark):
    from quarry.sources.delimited import bounded_read
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    got = [r["o_orderkey"] for r in bounded_read(o, ["o_orderdate", "o_orderkey"], 500).collect()]
    ref = [r["o_orderkey"] for r in o.orderBy("o_orderdate", "o_orderkey").limit(500).collect()]
    assert got == ref
