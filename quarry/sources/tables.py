"""Parquet table access for the driver-provided fixtures and any table folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, root: str, name: str, spread: bool = False) -> DataFrame:
    """Lazily scan ``<root>/<name>.parquet``; projections and filters reach the scan.

    A source that plans fewer input splits than half the cluster's cores
    (one large file with a single row group, as in the fixtures) would run
    every fused stage above the scan in one task; ``spread`` then adds one
    round-robin exchange to use every core.  Catalyst still pushes filters and
    column pruning below it, and on a production table (many files and row
    groups) the check leaves the scan untouched.  Off by default: measured on
    the fixtures, the exchange (a local sort keeps round-robin deterministic)
    costs more than light aggregations gain; heavy operators partition their
    own inputs (range ranks, model training).
    """
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    if spread:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() * 2 <= cores:
            df = df.repartition(cores)
    return df
