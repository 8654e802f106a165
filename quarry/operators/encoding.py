"""Target statistics of categorical features.

A category's number is the smoothed mean of the target over the rows that have it:
``(sum + a * prior) / (n + a)``. Training rows get out-of-fold numbers, from the rows of all other
folds, so no row sees its own target. All columns' sums come from one aggregate by (column, value, fold),
combined map-side; tables of values join on the cluster, so a column may have any number of values
and none are merged or brought to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

SMOOTHING = 10.0


@dataclass
class Statistics:
    """``table``: (column_name, value, n, sums); ``prior``: mean of each target over all training rows."""
    columns: list[str]
    prior: list[float]
    table: DataFrame
    smoothing: float = SMOOTHING


def names_of(column: str, targets: int) -> list[str]:
    return [f"_ts_{column}"] if targets == 1 else [f"_ts_{column}_{k}" for k in range(targets)]


def _value(c: str) -> Column:
    return F.col(f"`{c}`").cast("string")


def _smoothed(n: Column, s: Column, prior: Column, a: float) -> Column:
    return (s + F.lit(a) * prior) / (n + F.lit(a))


def learn(base: DataFrame, columns, targets: list[Column], fold: str) -> tuple[Statistics, DataFrame]:
    """Statistics of ``columns`` over all rows, and ``base`` with out-of-fold numbers ``_ts_<column>``
    (``_ts_<column>_<k>`` for several targets). A missing category is a value of its own; a value that only
    one fold has gets the prior of the others."""
    ensure_checkpoint_dir(base.sparkSession)
    columns = list(columns)
    k = len(targets)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), _value(c).alias("value")) for c in columns])
    parts = base.select(F.col(fold).cast("int").alias("fold"), *[t.cast("double").alias(f"t{i}") for i, t in enumerate(targets)],
                        F.explode(entries).alias("e")).groupBy("e.column_name", "e.value", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f"t{i}") for i in range(k)]).alias("sums")).checkpoint()
    of_one = parts.filter(F.col("column_name") == columns[0]).groupBy("fold").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(k)]).collect()  # a row a fold
    n = sum(r["n"] for r in of_one)
    totals = [sum(r[f"s{i}"] for r in of_one) for i in range(k)]
    prior = [t / n if n else 0.0 for t in totals]
    others = {r["fold"]: [(totals[i] - r[f"s{i}"]) / (n - r["n"]) if n > r["n"] else prior[i] for i in range(k)]
              for r in of_one}
    add = lambda name: [F.sum(F.col(name)[i]) for i in range(k)]
    table = parts.groupBy("column_name", "value").agg(F.sum("n").alias("n"), F.array(*add("sums")).alias("sums"))
    # of each value, what the rows outside a fold say; at most one row a value and fold
    outside = parts.select("column_name", "value", "fold", F.col("n").alias("own_n"), F.col("sums").alias("own")).join(
        table.withColumnRenamed("value", "v2").withColumnRenamed("column_name", "c2"),
        (F.col("column_name") == F.col("c2")) & F.col("value").eqNullSafe(F.col("v2")))
    out = base
    for c in columns:
        names = names_of(c, k)
        mine = outside.filter(F.col("column_name") == c).select(F.col("value").alias("_q_v"), F.col("fold").alias("_q_f"), *[
            _smoothed(F.col("n") - F.col("own_n"), F.col("sums")[i] - F.col("own")[i],
                      _by_fold({f: p[i] for f, p in others.items()}), SMOOTHING).alias(name)
            for i, name in enumerate(names)])
        out = out.join(mine, _value(c).eqNullSafe(F.col("_q_v")) & (F.col(fold).cast("int") == F.col("_q_f")), "left") \
            .drop("_q_v", "_q_f")
    return Statistics(columns, prior, table.checkpoint()), out


def _by_fold(values: dict[int, float]) -> Column:
    pairs = [x for f, v in values.items() for x in (F.lit(f), F.lit(float(v)))]
    return F.try_element_at(F.create_map(*pairs), F.col("fold")) if pairs else F.lit(0.0)


def apply(df: DataFrame, stats: Statistics) -> DataFrame:
    """``df`` with the numbers that all training rows give; a value they lack has the prior."""
    k = len(stats.prior)
    out = df
    for c in stats.columns:
        mine = stats.table.filter(F.col("column_name") == c).select(F.col("value").alias("_q_v"), *[
            _smoothed(F.col("n"), F.col("sums")[i], F.lit(stats.prior[i]), stats.smoothing).alias(f"_q_t{i}")
            for i in range(k)])
        out = out.join(mine, _value(c).eqNullSafe(F.col("_q_v")), "left").withColumns({
            name: F.coalesce(F.col(f"_q_t{i}"), F.lit(stats.prior[i])) for i, name in enumerate(names_of(c, k))}) \
            .drop("_q_v", *[f"_q_t{i}" for i in range(k)])
    return out
