"""Property checks with generated data: ranks, running totals, AUC."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import curves as crv
from quarry.operators.ordering import global_rank


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=5), min_size=1, max_size=300))
def test_rank_is_a_permutation_in_key_order(spark, keys):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k long")
    got = global_rank(df, ["k"], ["id"], rank_col="r", total_col="n").toPandas()
    assert sorted(got["r"]) == list(range(1, len(keys) + 1))
    assert (got["n"] == len(keys)).all()
    ordered = got.sort_values("r")
    assert list(zip(ordered["k"], ordered["id"])) == sorted(zip(got["k"], got["id"]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=200))
def test_auc_equals_pair_count(spark, pairs):
    ys = [p[0] for p in pairs]
    if len(set(ys)) < 2:
        return
    df = spark.createDataFrame([(y, float(s)) for y, s in pairs], "y int, s double")
    got = crv.auc(df, "y", "s").first()["auc"]
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert abs(got - wins / (len(pos) * len(neg))) < 1e-12
