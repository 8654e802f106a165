"""Calendar expressions (F1-F8): parsing, parts, weekday names and flags.

Two weekend rules exist on purpose: the ingestion rule (Saturday/Sunday as
0/1, Monday = 0 numbering) and the scoring-form rule (Friday/Saturday as
"Yes"/"No").  They are kept as separate functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.constants import PEAK_MONTHS, WEEKEND_DAYS_FORM  # noqa: F401  (fixed values)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_timestamp(col, fmt: str | None = None) -> Column:
    """String to timestamp; unparseable values become NULL (F1).

    ``try_to_timestamp`` tolerates bad input under ANSI mode, where
    ``to_timestamp`` raises.  Returns ``timestamp_ntz`` like the inputs.
    """
    c = _c(col).cast("string")
    parsed = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return parsed.cast("timestamp_ntz")


def weekday_monday0(col) -> Column:
    """Weekday number with Monday = 0 (F3); ``dayofweek`` would give Sunday = 1."""
    return F.weekday(_c(col))


def weekend_flag(col) -> Column:
    """1 on Saturday/Sunday, else 0."""
    return (F.weekday(_c(col)) >= 5).cast("int")


def weekday_name(col) -> Column:
    """Full English weekday name, e.g. ``Monday``."""
    return F.date_format(_c(col), "EEEE")


def weekend_yes_no(col) -> Column:
    """``Yes`` on Friday/Saturday, else ``No``."""
    return F.when(F.weekday(_c(col)).isin(4, 5), F.lit("Yes")).otherwise(F.lit("No"))


def peak_season(col) -> Column:
    """``Yes`` in months 5, 6, 7 and 12, else ``No`` (F8)."""
    return F.when(F.month(_c(col)).isin(*PEAK_MONTHS), F.lit("Yes")).otherwise(F.lit("No"))


CALENDAR_PARTS = {
    "Year": lambda d: F.year(d),
    "Month": lambda d: F.month(d),
    "Quarter": lambda d: F.quarter(d),
    "Day_of_Week": lambda d: weekday_monday0(d),
    "Weekend": lambda d: weekend_flag(d),
}


def add_calendar_features(df: DataFrame, date_col: str, derived=("Year", "Month", "Quarter",
                                                                  "Day_of_Week", "Weekend"),
                          parse: bool = True) -> DataFrame:
    """Derive the listed calendar columns that are not already present.

    With ``parse`` the date column is first coerced (F1) and rows whose date
    cannot be parsed are dropped (P3), as in ingestion.
    """
    if date_col not in df.columns:
        return df
    if parse:
        df = df.withColumn(date_col, parse_timestamp(date_col)).filter(F.col(date_col).isNotNull())
    todo = {name: CALENDAR_PARTS[name](F.col(date_col)) for name in derived
            if name not in df.columns}
    return df.withColumns(todo) if todo else df


def add_form_flags(df: DataFrame, date_col: str) -> DataFrame:
    """Weekday name, Friday/Saturday weekend and peak season as strings."""
    d = F.col(date_col)
    return df.withColumns({
        "Day_of_Week": weekday_name(d),
        "Weekend": weekend_yes_no(d),
        "Peak_Season": peak_season(d),
    })
