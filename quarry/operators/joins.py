"""The dimension lookup.

No side is hinted: the planner and AQE broadcast a side by its size in bytes, and split skewed
partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def dim_lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
               attrs: dict[str, str] | None = None) -> DataFrame:
    """Left lookup: known keys take the dimension's attributes, unknown keep their own.

    ``attrs`` maps dimension column -> output column; when the output column
    already exists in ``df`` the result is ``coalesce(dim value, existing)``.
    """
    dim_key = dim_key or key
    attrs = attrs or {c: c for c in dim.columns if c != dim_key}
    right = dim.select(F.col(dim_key).alias("_q_dk"),
                       *[F.col(src).alias(f"_q_d_{dst}") for src, dst in attrs.items()])
    joined = df.join(right, F.col(key) == F.col("_q_dk"), "left")
    out = {}
    for dst in attrs.values():
        looked_up = F.col(f"_q_d_{dst}")
        out[dst] = F.coalesce(looked_up, F.col(dst)) if dst in df.columns else looked_up
    return joined.withColumns(out).drop("_q_dk", *[f"_q_d_{d}" for d in attrs.values()])
