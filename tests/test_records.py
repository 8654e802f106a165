"""Records over several splits against Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from quarry.sources import records as rec
from quarry.sources.delimited import read_batch, read_delimited


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows_of(seed, n=400):
    rng = random.Random(seed)
    cell = lambda: rng.choice([
        "plain", "two words", "a,b", 'say ""hi""'.replace('""', '"'), "line\nbreak", "many\n\n\nbreaks, \"and\" more\n", "x" * 300,
        "é漢", "1", '"', "long\n" + "text " * 300 + "\nend"])
    return [[str(k), cell(), cell(), str(rng.randint(0, 99))] for k in range(n)]


def written(path, rows, header=("id", "a", "b", "n"), encoding="utf-8", sep=","):
    with open(path, "w", newline="", encoding=encoding) as f:
        out = csv.writer(f, delimiter=sep, lineterminator="\n")
        out.writerow(header)
        out.writerows(rows)
    return str(path)


@pytest.mark.parametrize("seed", [1, 2])
def test_records_over_many_splits(small_splits, tmp_path, seed):
    rows = rows_of(seed)
    path = written(tmp_path / "a.csv", rows)
    assert small_splits.read.text(path).rdd.getNumPartitions() > 20
    got = read_batch(small_splits, path)
    assert sorted([list(r) for r in got.collect()], key=lambda r: int(r[0])) == rows
    assert [f.dataType.typeName() for f in read_delimited(small_splits, path).schema.fields] == [
        "long", "string", "string", "long"]


def test_several_files_and_encodings(small_splits, tmp_path):
    a, b = rows_of(3, 120), [[str(int(r[0]) + 1000), *r[1:]] for r in rows_of(4, 120)]
    a, b = ([[c.replace("漢", "ü") for c in r] for r in x] for x in (a, b))
    (tmp_path / "in").mkdir()
    written(tmp_path / "in" / "a.csv", a, encoding="latin-1", sep=";")
    written(tmp_path / "in" / "b.csv", b, encoding="latin-1", sep=";")
    got = read_batch(small_splits, str(tmp_path / "in"))
    assert sorted([list(r) for r in got.collect()], key=lambda r: int(r[0])) == a + b


def test_inch_marks_in_bare_fields_do_not_open(small_splits, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('id,size,note\n1,5" disk,plain\n2,7",x\n3,3" and 4",y\n4,6"," open\nclose, ""still""\nend",z\n'[:-3] + "\n")
    got = {r.id: (r.size, r.note) for r in read_batch(small_splits, str(path)).collect()}
    assert got["1"] == ('5" disk', "plain") and got["2"] == ('7"', "x") and got["3"] == ('3" and 4"', "y")
    assert got["4"] == ('6"', ' open\nclose, "still"\nend')


def test_bare_quotes_leave_the_file_split(small_splits, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("id,size\n" + "".join(f'{k},{k}" disk of some length\n' for k in range(300)))
    df = read_batch(small_splits, str(path))
    assert df.rdd.getNumPartitions() > 5 and df.count() == 300
    assert df.filter(F.col("size") == F.concat("id", F.lit('" disk of some length'))).count() == 300


def test_expression_and_function_agree(spark):
    rng = random.Random(9)
    lines = ["".join(rng.choice('a,"" ') for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    got = spark.createDataFrame([(x,) for x in lines], "v string").withColumn("o", rec.opens(F.col("v"), ",")).collect()
    assert all(r.o == rec.line_end(r.v, ",", False) for r in got)
    reader = csv.reader(io.StringIO('1,"a\nb"\n'))
    assert next(reader) == ["1", "a\nb"] and rec.line_end('1,"a', ",", False) and not rec.line_end('b"', ",", True)
