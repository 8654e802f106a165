"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(col: str) -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(col, UPPER, UPPER.lower())


def free_name(taken: list[str], name: str) -> str:
    """``name``, or the first of name_1, name_2, ... that is not among ``taken`` (in any case of letters)."""
    used = {x.lower() for x in taken}
    return next(x for x in (name, *(f"{name}_{i}" for i in range(1, len(used) + 2))) if x.lower() not in used)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder as Parquet and read it back.

    Cuts the lineage (a lost executor costs a read, not a recomputation) and gives the planner
    the real size. The folder is the one the cluster names in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
