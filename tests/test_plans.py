"""Plan assertions: the physical plans have the shape the design relies on."""

import contextlib
import io

import pytest

from quarry.operators import metrics as met
from quarry.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_split_moves_no_rows(spark):
    from quarry.operators.ordering import chronological_split
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = _plan(chronological_split(orders, "o_orderdate", ["o_orderkey"]))
    for flag in ("Exchange", "Sort", "InMemoryRelation", "InMemoryTableScan", "Window", "SinglePartition", "MapInPandas"):
        assert flag not in plan, flag


def test_top_k_is_partial_before_shuffle(spark):
    plan = _plan(QUERIES["value_counts_top"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_point_lookup_pushes_predicates_to_scan(spark):
    plan = _plan(QUERIES["point_lookup"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_custkey), IsNotNull(o_orderdate), EqualTo(o_custkey,769)" in plan


def test_small_dimension_is_broadcast(spark):
    plan = _plan(QUERIES["group_avg"](spark, SF))
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_documents_text_is_never_read(spark):
    plan = _plan(QUERIES["confusion"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in plan


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_no_python_udf_or_cartesian(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for flag in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert flag not in plan, flag


def test_confusion_counts_sum_to_rows(spark):
    from quarry.plans.catalog import _cls_frame
    df = _cls_frame(spark, SF)
    total = met.confusion(df, "y", "p").groupBy().sum("n").first()[0]
    assert total == df.count()
