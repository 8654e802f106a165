"""Plans and rows of the jobs that dealt more than they needed."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import profile as prof


@pytest.fixture
def unhinted(spark):
    """No join is broadcast on its estimated size, as with tables too large for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_groups_do_not_deal_the_values(unhinted, monkeypatch):
    seen = []
    cumulate = prof.cumulate_by_key

    def noted(counts, *args, **named):
        seen.append(counts._jdf.queryExecution().executedPlan().toString())
        return cumulate(counts, *args, **named)

    monkeypatch.setattr(prof, "cumulate_by_key", noted)
    df = unhinted.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    got = {r["column_name"]: r["median"] for r in prof.moments(df, ["x", "y"]).collect()}
    box = prof.box_stats(df, "x", ["g"])
    seen.append(box._jdf.queryExecution().executedPlan().toString())
    assert got == {"x": 499.5, "y": 1.0} and box.count() == 7
    assert len(seen) == 3 and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in seen)


def test_donors_of_a_permutation_are_dealt_once(spark):
    """Each variant of a feature is the permutation that the digests name, and one shuffle moves rows and donors."""
    import hashlib

    from quarry.operators.importance import permuted_variants
    data = [(i, i % 5, float(i) if i % 11 else None, f"t{i % 3}") for i in range(700)]
    df = spark.createDataFrame(data, "k int, a int, b double, c string")
    out = permuted_variants(df, ["k"], ["a", "b", "c"], 2, 42)
    plan = out._jdf.queryExecution().executedPlan().toString()
    got = {(r["_q_f"], r["_q_r"], r["k"]): (r["a"], r["b"], r["c"]) for r in out.collect()}
    assert len(got) == 700 * 7 and "Exchange rangepartitioning" not in plan and plan.count("REPARTITION_BY_NUM") == 1
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    placed = sorted(data, key=lambda r: digest(f"{r[0]}|42"))
    assert all(got[-1, 0, r[0]] == r[1:] for r in data)
    for f in range(3):
        for n in range(2):
            donors = sorted(data, key=lambda r: digest(f"{r[0]}|42|{f}|{n}"))
            for r, d in zip(placed, donors, strict=True):
                want = list(r[1:])
                want[f] = d[1 + f]
                assert got[f, n, r[0]] == tuple(want)
    assert "SortMergeJoin" not in plan


def test_equal_keys_keep_every_row_and_value(spark):
    from quarry.operators.importance import permuted_variants
    df = spark.range(300).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("x"))
    rows = permuted_variants(df, ["k"], ["x"], 2, 7).collect()
    for at in ((-1, 0), (0, 0), (0, 1)):
        assert sorted(r["x"] for r in rows if (r["_q_f"], r["_q_r"]) == at) == list(range(300))
