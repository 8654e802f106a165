"""Sinks (S6-S9, S11): split tables, one-row reports, result tables, templates."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_splits(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet",
                 mode: str = "overwrite") -> None:
    """One write partitioned by split (S7); later readers prune to one split."""
    df.write.mode(mode).partitionBy(split_col).format(fmt).save(path)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row report as JSON (S8); one row, so one output file."""
    report.coalesce(1).write.mode(mode).json(path)


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Result tables (S9, S11) as CSV with header, or any other format."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def export_template(df: DataFrame, path: str, target: str | None, order_cols, n: int = 20) -> None:
    """Scoring template: first ``n`` rows in order, target removed when present."""
    out = df.drop(target) if target and target in df.columns else df
    out.orderBy(*order_cols).limit(n).coalesce(1).write.mode("overwrite") \
       .option("header", True).csv(path)
