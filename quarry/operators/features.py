"""Feature completion, batch coercion, validation and lookups.

The reference derives missing features for one record in a form; here the
same derivations run as column expressions over any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.calendar import add_form_flags
from quarry.functions.coerce import clean_string, to_double_or_null, to_int_or_zero, with_default
from quarry.functions.numeric import floor_ratio_at_least_one
from quarry.operators.joins import dim_lookup

from quarry.constants import LABEL_SEPARATOR  # noqa: E402


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def complete_features(df: DataFrame, date_col: str, dim: DataFrame | None = None,
                      key: str | None = None, dim_key: str | None = None,
                      dim_attrs: dict[str, str] | None = None,
                      ratio_source: str | None = None, ratio_target: str | None = None,
                      ratio_divisor: int = 20, constants: dict | None = None,
                      defaults: dict[str, tuple] | None = None) -> DataFrame:
    """Raw date + key + measures in, full feature rows out.

    * calendar parts and the Yes/No flags from ``date_col`` (F2, F6-F8);
    * dimension attributes for known keys, existing values kept otherwise (J1);
    * ``ratio_target = max(1, floor(ratio_source / divisor))`` (F9);
    * fixed values for ``constants`` (F10);
    * ``defaults``: column -> (default, type) for missing or bad values (P16).
    """
    d = _q(date_col)
    out = df.withColumns({"Year": F.year(d), "Month": F.month(d), "Quarter": F.quarter(d)})
    out = add_form_flags(out, date_col)
    if dim is not None and key:
        out = dim_lookup(out, dim, key, dim_key=dim_key, attrs=dim_attrs)
    if ratio_source and ratio_target:
        out = out.withColumn(ratio_target, floor_ratio_at_least_one(ratio_source, ratio_divisor))
    for name, value in (constants or {}).items():
        out = out.withColumn(name, F.lit(value))
    for name, (default, dtype) in (defaults or {}).items():
        src = _q(name) if name in out.columns else F.lit(None)
        out = out.withColumn(name, with_default(src, default, dtype))
    return out


def coerce_batch(df: DataFrame, int_cols=(), float_cols=(), clean_strings: bool = True
                 ) -> DataFrame:
    """Type an uploaded batch: integers (P10), floats (P11), trimmed strings.

    Listed columns that are absent are skipped.  Remaining string columns are
    stripped and a missing string becomes ``nan``.
    """
    cols = {}
    for c in int_cols:
        if c in df.columns:
            cols[c] = to_int_or_zero(_q(c))
    for c in float_cols:
        if c in df.columns:
            cols[c] = to_double_or_null(_q(c))
    if clean_strings:
        for f in df.schema.fields:
            if f.name not in cols and f.dataType.typeName() == "string":
                cols[f.name] = clean_string(_q(f.name))
    return df.withColumns(cols) if cols else df


def domain_flags(df: DataFrame, ranges: dict[str, tuple] | None = None,
                 categories: dict[str, list] | None = None) -> DataFrame:
    """Append one boolean ``valid_<col>`` per rule and ``is_valid`` for all.

    A missing value is invalid.  Ranges are inclusive.
    """
    flags = {}
    for c, (lo, hi) in (ranges or {}).items():
        flags[f"valid_{c}"] = F.coalesce(_q(c).between(F.lit(lo), F.lit(hi)), F.lit(False))
    for c, allowed in (categories or {}).items():
        flags[f"valid_{c}"] = F.coalesce(_q(c).isin(*allowed), F.lit(False))
    out = df.withColumns(flags)
    every = F.lit(True)
    for name in flags:
        every = every & F.col(name)
    return out.withColumn("is_valid", every)


def domain_check(df: DataFrame, ranges: dict[str, tuple] | None = None,
                 categories: dict[str, list] | None = None) -> DataFrame:
    """Invalid-row counts per rule: (rule, n_invalid) plus the ``all`` rule."""
    flagged = domain_flags(df, ranges, categories)
    rules = [c for c in flagged.columns if c.startswith("valid_")] + ["is_valid"]
    structs = [F.struct(F.lit(r[len("valid_"):] if r != "is_valid" else "all").alias("rule"),
                        F.count_if(~F.col(r)).alias("n_invalid")) for r in rules]
    return flagged.agg(F.array(*structs).alias("_q_r")).select(F.inline("_q_r"))


def search(df: DataFrame, col: str, term: str | None) -> DataFrame:
    """Rows whose lower-cased ``col`` contains the lower-cased, stripped ``term`` as a regex.

    A blank term keeps every row; a missing value never matches.
    """
    if term is None or not term.strip():
        return df
    pattern = term.strip().lower()
    return df.filter(F.coalesce(F.lower(_q(col).cast("string")).rlike(pattern), F.lit(False)))


def reorder(df: DataFrame, first) -> DataFrame:
    """Put ``first`` columns in front, keep the rest in order."""
    first = [c for c in first if c in df.columns]
    return df.select(*[_q(c) for c in first], *[_q(c) for c in df.columns if c not in first])


def display_label(key, date) -> Column:
    """``key — date`` label of a record."""
    k = F.col(key) if isinstance(key, str) else key
    d = F.col(date) if isinstance(date, str) else date
    return F.concat_ws(LABEL_SEPARATOR, k.cast("string"), d.cast("string"))


def point_lookup(df: DataFrame, key_col: str, key, date_col: str, date, order_cols) -> DataFrame:
    """First record with ``key_col = key`` and ``date_col = date`` in ``order_cols`` order.

    The two native predicates reach the Parquet scan; the composite label is
    only built on the match.
    """
    when = F.lit(date).cast(df.schema[date_col].dataType)
    hit = df.filter((_q(key_col) == F.lit(key)) & (_q(date_col) == when))
    return (hit.orderBy(*order_cols).limit(1)
               .withColumn("display_label", display_label(key_col, date_col)))


def preview(df: DataFrame, order_cols, n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order (P23, S3): Spark has no file order."""
    return df.orderBy(*order_cols).limit(n)
