"""Data-quality operators.

The summary is one map-side combined scan for row count, nulls and constant
columns, and a shuffle of row hashes (not rows) for the duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.calendar import parse_timestamp


def _q(name: str):
    return F.col(f"`{name}`")


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, so that one notion of missing remains."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.nanvl(_q(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in floats}) if floats else df


def resolve_target(df: DataFrame, target: str | None = None) -> str:
    """Configured target, else the last column; ``KeyError`` when absent."""
    name = target or df.columns[-1]
    if name not in df.columns:
        raise KeyError(f"the table has no column '{name}' to predict, only {', '.join(df.columns)}")
    return name


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """Drop rows whose target is missing (P2); NaN counts as missing."""
    cond = _q(target).isNotNull()
    if dict(df.dtypes)[target] in ("double", "float"):
        cond = cond & ~F.isnan(_q(target))
    return df.filter(cond)


def drop_unparseable_dates(df: DataFrame, date_col: str) -> DataFrame:
    """Coerce the date column and drop rows it cannot parse (F1 + P3)."""
    return df.withColumn(date_col, parse_timestamp(date_col)).filter(_q(date_col).isNotNull())


def duplicate_rows(df: DataFrame) -> int:
    """Rows beyond the first of each identical group, nulls comparing equal (A2).

    Only a 128-bit hash of each row is shuffled (values and null flags, counted map-side); whole rows
    are compared for hashes seen twice or more alone.
    """
    df = nan_as_null(df)
    marks = [F.col(f"`{c}`") for c in df.columns] + [F.col(f"`{c}`").isNull() for c in df.columns]
    hashed = df.withColumns({"_q_h1": F.xxhash64(F.lit(1), *marks), "_q_h2": F.xxhash64(F.lit(2), *marks)})
    twice = hashed.groupBy("_q_h1", "_q_h2").agg(F.count(F.lit(1)).alias("_q_n")).filter("_q_n > 1")
    same = (hashed.join(twice.select("_q_h1", "_q_h2"), ["_q_h1", "_q_h2"], "left_semi")
            .groupBy(*[_q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_q_n")))
    return same.agg(F.coalesce(F.sum(F.col("_q_n") - 1), F.lit(0)).cast("long")).first()[0]


def quality_summary(df: DataFrame) -> DataFrame:
    """One row: n_rows, n_columns, n_duplicate_rows, n_missing, missing_pct, constant columns (A1).

    Duplicates are rows beyond the first of each identical group, nulls
    comparing equal (A2).  A column is constant when it has at most one
    distinct non-null value; an all-null column counts as constant (P6).
    """
    df = nan_as_null(df)
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        name = "`" + c.replace("`", "``") + "`"
        # SQL text: one JVM call per expression keeps plan building cheap for wide tables
        aggs += [F.expr(f"count_if({name} IS NULL)").alias(f"_q_null_{i}"),
                 F.expr(f"min({name})").alias(f"_q_min_{i}"),
                 F.expr(f"max({name})").alias(f"_q_max_{i}")]
    wide = df.agg(*aggs).withColumn("n_duplicate_rows", F.lit(duplicate_rows(df)))
    nulls = [F.col(f"_q_null_{i}") for i in range(len(cols))]
    total_nulls = sum(nulls[1:], nulls[0]) if nulls else F.lit(0)
    const_flags = [F.when(F.col(f"_q_min_{i}").eqNullSafe(F.col(f"_q_max_{i}")), F.lit(c))
                   for i, c in enumerate(cols)]
    cells = F.col("n_rows") * F.lit(len(cols))
    return wide.select(
        F.col("n_rows"),
        F.lit(len(cols)).alias("n_columns"),
        F.col("n_duplicate_rows"),
        total_nulls.alias("n_missing"),
        F.round(F.try_divide(total_nulls * F.lit(100.0), cells), 2).alias("missing_pct"),
        F.filter(F.array(*const_flags), lambda x: x.isNotNull()).alias("constant_columns"),
    )


def null_counts(df: DataFrame, keep_zero: bool = False) -> DataFrame:
    """(column_name, n_missing) per column with missing values, most first.

    NaN in floating columns counts as missing, like pandas.
    """
    dtypes = dict(df.dtypes)
    parts = []
    for c in df.columns:
        name = "`" + c.replace("`", "``") + "`"
        miss = f"{name} IS NULL"
        if dtypes[c] in ("double", "float"):
            miss = f"({miss} OR isnan({name}))"
        label = c.replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"named_struct('column_name', '{label}', 'n_missing', count_if({miss}))")
    # SQL text: one JVM call for the whole aggregate, whatever the width
    out = df.agg(F.expr(f"array({', '.join(parts)})").alias("_q_cols")) \
            .select(F.inline("_q_cols"))
    if not keep_zero:
        out = out.filter(F.col("n_missing") > 0)
    return out.orderBy(F.desc("n_missing"), "column_name")


def total_missing(df: DataFrame) -> DataFrame:
    """Single value: missing cells of the whole table."""
    return null_counts(df, keep_zero=True).agg(
        F.coalesce(F.sum("n_missing"), F.lit(0)).alias("n_missing"))


def deduplicate(df: DataFrame) -> DataFrame:
    """Keep one of each identical row (A3)."""
    return df.dropDuplicates()


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without any value (P5), NaN being none; one aggregate, one row to the driver."""
    row = nan_as_null(df).agg(*[F.expr("count(`" + c.replace("`", "``") + "`)").alias(f"_q{i}")
                   for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[f"_q{i}"] == 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop fully-null columns (P5)."""
    empty = empty_columns(df)
    return df.drop(*empty) if empty else df
