"""Type coercion expressions for uploaded batches.

Three different missing-value rules live side by side, as in the reference
batch form: integers fall back to 0 and truncate, floats stay NULL, and
strings are trimmed with a missing value turned into the literal ``nan``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# White space at either end, beyond ASCII too; a plain decimal number or an infinity.
OUTER_BLANKS = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"
NUMBER = r"(?i)^[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$|^[+-]?inf(inity)?$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_double_or_null(col) -> Column:
    """Numeric parse; non-numeric text and NaN become NULL.

    The text must be a plain number (no type suffixes as in ``1d``) or an infinity; NaN is
    nulled as well so that one notion of missing remains.
    """
    text = F.regexp_replace(_c(col).cast("string"), OUTER_BLANKS, "")
    d = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.nanvl(d, F.lit(None).cast("double"))


def to_int_or_zero(col) -> Column:
    """Numeric parse, missing to 0, then truncation toward zero (P10).

    Numbers beyond 64 bits and infinities have no integer and count as missing, so one
    such cell gives 0 and does not end the job.
    """
    return F.coalesce(to_double_or_null(col).try_cast("bigint"), F.lit(0).cast("bigint"))


def clean_string(col) -> Column:
    """Strip surrounding whitespace; a missing value becomes ``nan``.

    All Unicode white space is stripped, as Python's ``str.strip`` does.
    """
    stripped = F.regexp_replace(_c(col).cast("string"), OUTER_BLANKS, "")
    return F.coalesce(stripped, F.lit("nan"))


def lower_strip(col) -> Column:
    """Cast to string, lower-case and strip all Unicode white space."""
    return F.lower(F.regexp_replace(_c(col).cast("string"), OUTER_BLANKS, ""))


def with_default(col, default, dtype: str) -> Column:
    """Typed value, or ``default`` when missing or not castable."""
    return F.coalesce(_c(col).try_cast(dtype), F.lit(default).cast(dtype))
