"""Driver contract: entry, queries and oracle SQL line up."""

import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "n_rows", "first_date", "last_date", "avg_totalprice"]
    assert {r["split"] for r in rows} == {"train", "val", "test"}
    assert sum(r["n_rows"] for r in rows) == spark.read.parquet(
        "/root/testdata/sf0.001/orders.parquet").count()


def test_oracle_keys_are_queries():
    q = entry_mod.queries()
    o = entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 40
