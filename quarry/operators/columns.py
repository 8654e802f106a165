"""Column roles and pruning decisions.

Exact distinct counts over every column of a wide table would expand the
data once per column.  Roles therefore start from one pass of cheap
statistics (row count, non-null counts, min/max, HyperLogLog sketches); exact
distinct counts run afterwards only for the few columns near a decision
threshold, and the distinct test for low cardinality stops after
``threshold + 1`` values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, ByteType, DecimalType, DoubleType,
                               FloatType, IntegerType, LongType, MapType, ShortType, StringType,
                               StructType)

from quarry.operators.ordering import global_rank
from quarry.operators.quality import nan_as_null

INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
NUMERIC = INTEGRAL + (FloatType, DoubleType, DecimalType)
from quarry.constants import LOW_CARD_THRESHOLD  # noqa: E402


def _q(name: str):
    return F.col(f"`{name}`")


def is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, NUMERIC)


def type_partition(df: DataFrame, target: str | None = None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names in schema order, target removed (P20).

    Strings and booleans are categorical; dates and timestamps are neither,
    as in the reference where they are not of a numeric or object type.
    """
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name == target:
            continue
        if isinstance(f.dataType, NUMERIC):
            numeric.append(f.name)
        elif isinstance(f.dataType, (StringType, BooleanType)):
            categorical.append(f.name)
    return numeric, categorical


def bounded_distinct(df: DataFrame, col: str, cap: int) -> int:
    """min(number of distinct non-null values, cap), NaN counting as missing.

    A sketch (error 2%) settles columns with far more than ``cap`` values in one scan; only a column near
    or under it is counted exactly, and its few values are combined map-side.
    """
    one = nan_as_null(df.select(_q(col).alias("v")))
    if one.agg(F.approx_count_distinct("v", 0.02)).first()[0] > 2 * cap + 10:
        return cap
    return min(cap, one.agg(F.count_distinct("v")).first()[0])


def problem_type(df: DataFrame, target: str, threshold: int = LOW_CARD_THRESHOLD,
                 fine: bool = False) -> str:
    """regression when numeric with more than ``threshold`` distinct values (A5).

    ``fine`` splits classification into binary (exactly 2 values) and multiclass.
    """
    k = bounded_distinct(df, target, threshold + 1)
    if is_numeric(df, target) and k > threshold:
        return "regression"
    if not fine:
        return "classification"
    return "binary" if k == 2 else "multiclass"


def problem_type_frame(df: DataFrame, target: str, threshold: int = LOW_CARD_THRESHOLD
                       ) -> DataFrame:
    """The A5 decision as a one-row DataFrame; the counts come from the cluster.

    ``n_distinct_capped`` is the exact distinct count when it is at most
    ``threshold + 1`` and ``threshold + 1`` otherwise - all the decision needs.
    """
    numeric = is_numeric(df, target)
    capped = df.sparkSession.range(1).select(
        F.lit(bounded_distinct(df, target, threshold + 1)).cast("long").alias("n_distinct_capped"))
    k = F.col("n_distinct_capped")
    kind = F.when(F.lit(numeric) & (k > threshold), "regression").otherwise("classification")
    fine = (F.when(F.lit(numeric) & (k > threshold), "regression")
             .when(k == 2, "binary").otherwise("multiclass"))
    return capped.select(F.lit(target).alias("target"), k, kind.alias("problem_type"),
                         fine.alias("fine_problem_type"))


@dataclass
class ColumnRoles:
    n_rows: int
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    constant: list[str] = field(default_factory=list)
    id_like: list[str] = field(default_factory=list)
    sequence: list[str] = field(default_factory=list)
    low_cardinality: list[str] = field(default_factory=list)

    def rows(self, columns: list[str], dtypes: dict[str, str]):
        for c in columns:
            kind = ("numeric" if c in self.numeric else
                    "categorical" if c in self.categorical else "other")
            yield (c, dtypes[c], kind, c in self.constant, c in self.id_like,
                   c in self.sequence, c in self.low_cardinality)


def column_roles(df: DataFrame, target: str | None = None, order_cols=(), tie_break=(),
                 threshold: int = LOW_CARD_THRESHOLD, exclude_target: bool = True) -> ColumnRoles:
    """Decide constant / ID-like / sequence / low-cardinality columns.

    * constant: at most one distinct non-null value - ``min <=> max``, exact.
    * ID-like: string column whose distinct count equals the row count.
    * sequence: integral column, unique, and +1 between consecutive rows in
      ``order_cols`` order; with the global position r this is
      ``min(c - r) = max(c - r)``, an aggregate instead of a global lag.
    * low cardinality: categorical with at most ``threshold`` distinct values.
    """
    df = nan_as_null(df)
    schema_types = {f.name: f.dataType for f in df.schema.fields}
    # atomic columns only: arrays, maps and structs get no role (kind "other")
    cols = [c for c in df.columns if not (exclude_target and c == target)
            and not isinstance(schema_types[c], (ArrayType, MapType, StructType))]
    numeric, categorical = type_partition(df, target if exclude_target else None)
    names = ["`" + c.replace("`", "``") + "`" for c in cols]
    # SQL text: one JVM call per expression keeps plan building cheap for wide tables
    stats = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.expr(f"count({x})").alias(f"_nn{i}") for i, x in enumerate(names)],
        *[F.expr(f"min({x}) <=> max({x})").alias(f"_k{i}") for i, x in enumerate(names)],
        *[F.expr(f"approx_count_distinct({x}, 0.02)").alias(f"_a{i}") for i, x in enumerate(names)],
        *[F.expr(f"{side}({x})").alias(f"_{tag}{i}") for i, x in enumerate(names)
          if isinstance(schema_types[cols[i]], INTEGRAL) for side, tag in (("min", "lo"), ("max", "hi"))],
    ).first()
    n = stats["_n"]
    roles = ColumnRoles(n_rows=n, numeric=numeric, categorical=categorical)
    schema = {f.name: f.dataType for f in df.schema.fields}
    id_candidates, seq_candidates = [], []
    for i, c in enumerate(cols):
        if stats[f"_k{i}"]:
            roles.constant.append(c)
        approx = stats[f"_a{i}"]
        full = stats[f"_nn{i}"] == n and n > 0
        if full and approx >= 0.9 * n:
            if isinstance(schema[c], StringType):
                id_candidates.append(c)
            elif isinstance(schema[c], INTEGRAL) and stats[f"_hi{i}"] - stats[f"_lo{i}"] == n - 1:
                seq_candidates.append(c)
        if c in categorical and approx <= 2 * threshold + 10:
            if bounded_distinct(df, c, threshold + 1) <= threshold:
                roles.low_cardinality.append(c)
    unique = _exactly_unique(df, id_candidates + seq_candidates, n)
    roles.id_like = [c for c in id_candidates if c in unique]
    seq_candidates = [c for c in seq_candidates if c in unique]
    if seq_candidates and order_cols:
        ranked = global_rank(df.select(*{*order_cols, *tie_break, *seq_candidates}),
                             list(order_cols), list(tie_break), rank_col="_q_r", materialize="checkpoint")
        row = ranked.agg(*[(F.min(_q(c) - F.col("_q_r")).eqNullSafe(F.max(_q(c) - F.col("_q_r"))))
                           .alias(f"_s{i}") for i, c in enumerate(seq_candidates)]).first()
        roles.sequence = [c for i, c in enumerate(seq_candidates) if row[f"_s{i}"]]
    return roles


def _exactly_unique(df: DataFrame, cols: list[str], n: int) -> set[str]:
    """Columns among ``cols`` whose exact distinct count equals ``n``; one at a time, since several
    distinct counts in one aggregate would expand every row once a column."""
    return {c for c in cols if df.agg(F.count_distinct(_q(c))).first()[0] == n}


def roles_frame(df: DataFrame, roles: ColumnRoles, table_name: str | None = None,
                target: str | None = None, exclude_target: bool = True) -> DataFrame:
    """Roles as a small DataFrame: one row per column (bounded by the schema)."""
    dtypes = dict(df.dtypes)
    cols = [c for c in df.columns if not (exclude_target and c == target)]
    rows = [((table_name,) if table_name else ()) + r for r in roles.rows(cols, dtypes)]
    names = (["table_name"] if table_name else []) + [
        "column_name", "data_type", "kind", "is_constant", "is_id", "is_sequence",
        "is_low_cardinality"]
    return df.sparkSession.createDataFrame(rows, names)


def prune_decision(train: DataFrame, target: str, explicit=(), order_cols=(), tie_break=()
                   ) -> list[str]:
    """Columns to drop, decided on the training rows only.

    Union of the configured drops present in the table, ID-like strings,
    integer sequences and constant columns, target always kept; returned in
    schema order.
    """
    roles = column_roles(train, target, order_cols, tie_break)
    drops = {c for c in explicit if c in train.columns}
    drops |= set(roles.id_like) | set(roles.sequence) | set(roles.constant)
    drops.discard(target)
    return [c for c in train.columns if c in drops]


def prune_columns(df: DataFrame, drops) -> DataFrame:
    """Apply a drop list decided elsewhere (P9); absent names are ignored."""
    present = [c for c in drops if c in df.columns]
    return df.drop(*present) if present else df


def missing_required(df: DataFrame, required) -> list[str]:
    """Required names absent from ``df``, in the required order."""
    have = set(df.columns)
    return [c for c in required if c not in have]
