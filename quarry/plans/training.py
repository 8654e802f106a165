"""Model fixtures: split, prune and run the tournament on a table (stages 3-4).

Tournaments are memoised per Spark application and input folder so that
scoring and importance queries reuse one fitted pool.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import modeling as mdl
from quarry.operators.columns import problem_type, prune_columns, prune_decision
from quarry.operators.ordering import chronological_split
from quarry.session import ensure_checkpoint_dir
from quarry.sources.tables import table

_CACHE: dict = {}

LINEITEM_TARGET = "l_extendedprice"
LINEITEM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def split_table(df: DataFrame, date_col: str, tie_break) -> DataFrame:
    """Chronological split, written to the checkpoint folder once: later stages read it many times."""
    ensure_checkpoint_dir(df.sparkSession)
    return chronological_split(df, date_col, tie_break).checkpoint()


def lineitem_splits(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    key = ("lineitem_splits", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        li = table(spark, sf, "lineitem")
        split = split_table(li, "l_shipdate", LINEITEM_KEYS)
        train = split.filter(F.col("split") == "train").drop("split")
        drops = prune_decision(train, LINEITEM_TARGET, order_cols=["l_shipdate"],
                               tie_break=LINEITEM_KEYS)
        _CACHE[key] = (prune_columns(split, [d for d in drops if d not in LINEITEM_KEYS]), drops)
    return _CACHE[key]


def lineitem_tournament(spark: SparkSession, sf: str) -> mdl.Tournament:
    key = ("lineitem_tournament", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        split, _ = lineitem_splits(spark, sf)
        train = split.filter(F.col("split") == "train").drop("split")
        val = split.filter(F.col("split") == "val").drop("split")
        kind = problem_type(train, LINEITEM_TARGET, fine=True)
        _CACHE[key] = mdl.run_tournament(train, val, LINEITEM_TARGET, kind, LINEITEM_KEYS,
                                         folds=3, exclude=("l_orderkey", "l_shipdate"))
    return _CACHE[key]


def document_frame(spark: SparkSession, sf: str) -> DataFrame:
    """labels joined to the few document columns the classifier uses (text is never read)."""
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    return docs.join(lab, "doc_id")


def document_tournament(spark: SparkSession, sf: str) -> tuple[mdl.Tournament, DataFrame]:
    key = ("document_tournament", spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        split = split_table(document_frame(spark, sf), "doc_id", [])
        train = split.filter(F.col("split") == "train").drop("split")
        val = split.filter(F.col("split") == "val").drop("split")
        kind = problem_type(train, "quality", fine=True)
        t = mdl.run_tournament(train, val, "quality", kind, ["doc_id"], folds=3,
                               exclude=("doc_id",))
        _CACHE[key] = (t, split)
    return _CACHE[key]
