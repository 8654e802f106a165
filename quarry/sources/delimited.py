"""Delimited-text sources.

The sniffing reader decides the encoding on one pass over the whole text and the
separator on the header, and then issues one ordinary ``spark.read.csv``; the data itself is
never pulled through the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.constants import ENCODINGS, SEPARATORS  # fixed values: encodings (outer loop), separators
from quarry.sources.records import opens, records
# Spark's CSV reader takes Java charset names.
JAVA_CHARSETS = {"utf-8": "utf-8", "latin-1": "iso-8859-1", "cp1252": "windows-1252"}

# Tokens that stand for a missing value in delimited text
MISSING_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                  "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _scan(spark: SparkSession, path: str) -> tuple[bool, bool, bool]:
    """(has lines, holds bad UTF-8, holds quotes), from one pass over the whole text."""
    row = spark.read.text(path).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.is_valid_utf8("value")).alias("bad"),
        F.count_if(F.contains("value", F.lit('"'))).alias("quoted")).first()
    return row["n"] > 0, row["bad"] > 0, row["quoted"] > 0


def sniff_format(spark: SparkSession, path: str, encodings=ENCODINGS,
                 separators=SEPARATORS) -> tuple[str, str]:
    """(encoding, separator): first pair whose header splits into more than one field.

    UTF-8 fails on any bad byte of the whole input.  Raises ``ValueError`` when no pair works.
    """
    return _sniff(spark, path, encodings, separators)[:2]


def _sniff(spark, path, encodings, separators) -> tuple[str, str, bool]:
    some, bad_utf8, quoted = _scan(spark, path)
    if not some:
        raise ValueError(f"Cannot parse {path}: no lines")
    for enc in encodings:
        if enc == "utf-8" and bad_utf8:
            continue
        for sep in separators:
            # header-only schema resolution reads the first line, not the data
            try:
                cols = _reader(spark, enc, sep).csv(path).columns
            except IllegalArgumentException:  # charset not accepted by this Spark build
                break
            if len(cols) > 1:
                # does a line that starts outside quotes end inside them? if none does, lines are records
                lines = spark.read.text(path).filter(F.contains("value", F.lit('"')))
                over = quoted and lines.filter(opens(F.col("value"), sep)).limit(1).count() > 0
                return enc, sep, over
    raise ValueError(f"No known encoding and separator give {path} more than one column")


def _reader(spark: SparkSession, enc: str, sep: str):
    """Quotes are doubled inside quoted fields; every line is a record, so files are split."""
    return (spark.read.option("header", True).option("encoding", JAVA_CHARSETS.get(enc, enc))
                 .options(**_options(sep)))


def _options(sep: str) -> dict[str, str]:
    return {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _read_spanning(spark: SparkSession, path: str, enc: str, sep: str, schema) -> DataFrame:
    """Records that span lines, put together split by split and parsed one by one."""
    found = records(spark, path, sep, JAVA_CHARSETS.get(enc, enc)).filter(~F.col("first"))
    return found.select(F.from_csv("record", schema, _options(sep)).alias("r")).select("r.*")


def missing_tokens_as_null(df: DataFrame) -> DataFrame:
    """Text columns with the tokens that mean a missing value replaced by NULL."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(MISSING_TOKENS), F.col(f"`{c}`"))
                           for c in texts}) if texts else df


def typed(df: DataFrame) -> DataFrame:
    """Text columns as whole numbers, numbers or booleans where every value is one; the rest stays text.
    One aggregate over all columns, one row to the driver."""
    names = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    tests = {"bigint": r"{0} rlike '^\\s*[+-]?[0-9]+\\s*$' AND try_cast({0} AS bigint) IS NOT NULL",
             "double": r"{0} rlike '(?i)^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?\\s*$' "
                       r"OR trim({0}) rlike '(?i)^[+-]?inf(inity)?$'",
             "boolean": r"{0} IN ('True', 'False', 'TRUE', 'FALSE', 'true', 'false')"}
    row = df.agg(*[F.expr(f"count({x})").alias(f"n{i}") for i, x in enumerate(names)],
                 *[F.expr(f"count_if({test.format(x)})").alias(f"{kind}{i}")
                   for i, x in enumerate(names) for kind, test in tests.items()]).first()
    kinds = {c: next((k for k in tests if row[f"n{i}"] and row[f"{k}{i}"] == row[f"n{i}"]), None)
             for i, c in enumerate(df.columns)}
    return df.withColumns({c: F.trim(F.col(f"`{c}`")).cast(k) for c, k in kinds.items() if k})


def read_delimited(spark: SparkSession, path: str, infer_schema: bool = True,
                   encodings=ENCODINGS, separators=SEPARATORS, schema=None) -> DataFrame:
    """Sniffed CSV read with header (S1); ``schema`` skips inference."""
    enc, sep, spanning = _sniff(spark, path, encodings, separators)
    reader = _reader(spark, enc, sep)
    if spanning:
        names = reader.csv(path).columns
        kind = schema if schema is not None else ", ".join("`" + c.replace("`", "``") + "` string" for c in names)
        df = _read_spanning(spark, path, enc, sep, kind if isinstance(kind, str) else kind.simpleString()[7:-1])
    else:
        df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", False)).csv(path)
    if schema is not None:
        return df
    df = missing_tokens_as_null(df)
    return typed(df) if infer_schema else df


def read_batch(spark: SparkSession, path: str) -> DataFrame:
    """Uploaded batch: every column as text, typed later by the coercion rules."""
    return read_delimited(spark, path, infer_schema=False)


def read_with_fallback(spark: SparkSession, paths, fmt: str = "parquet", optional: bool = False,
                       **options) -> DataFrame | None:
    """First readable path among ``paths`` (S2); ``optional`` returns None when none exists."""
    last = None
    for p in paths:
        try:
            reader = spark.read.format(fmt)
            for k, v in options.items():
                reader = reader.option(k, v)
            return reader.load(p)
        except AnalysisException as exc:  # path does not exist
            last = exc
    if optional:
        return None
    raise FileNotFoundError(f"none of {list(paths)} can be read") from last


def bounded_read(df: DataFrame, order_cols, n: int = 10_000) -> DataFrame:
    """First ``n`` rows in a stated order, nulls first (S3); Spark tables have no file order.

    A partial top-n: every task keeps its own first ``n`` rows and only these meet.
    """
    return df.orderBy(*order_cols).limit(n)
