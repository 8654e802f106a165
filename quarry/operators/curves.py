"""Ranking curves: ROC, AUC, precision-recall, average precision.

Rows are first reduced to one row per (group, distinct score) with positive
and negative counts (map-side partial aggregation, so a hot score costs one
row per task).  Cumulative counts in descending score order come from a radix tree
over the bits of the score: windows run inside buckets of bounded size only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import ordered_bits
from quarry.operators.ordering import cumulate_by_key


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def score_counts(df: DataFrame, label, score, group_cols=(), positive=1) -> DataFrame:
    """(group..., score, pos, neg) per distinct score; NULL scores or labels are skipped."""
    lab, sc = _c(label), _c(score).cast("double")
    is_pos = (lab == F.lit(positive)).cast("long")
    return (df.filter(lab.isNotNull() & sc.isNotNull())
              .groupBy(*[_c(g) for g in group_cols], sc.alias("score"))
              .agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg")))


def cumulative_counts(counts: DataFrame, group_cols=()) -> DataFrame:
    """Add tps/fps (counts at or above each score within its group) and P/N totals."""
    cum = cumulate_by_key(counts, ordered_bits("score"), ["pos", "neg"], group_cols, descending=True)
    doubles = {"upto_pos": "tps", "upto_neg": "fps", "all_pos": "P", "all_neg": "N"}
    return cum.select(*counts.columns, *[F.col(a).cast("double").alias(b) for a, b in doubles.items()])


def roc_curve(df: DataFrame, label, score, positive=1) -> DataFrame:
    """(threshold, tps, fps, tpr, fpr): one point per distinct score, descending (M7).

    Every threshold is kept (no dropping of collinear points); the area under
    these points equals the one from the reduced curve.  The curve starts at
    (0, 0), a point without threshold; rates of an absent class are NULL.
    """
    cum = cumulative_counts(score_counts(df, label, score, positive=positive))
    points = cum.select(F.col("score").alias("threshold"), F.col("tps").cast("long").alias("tps"),
                        F.col("fps").cast("long").alias("fps"),
                        F.try_divide("tps", "P").alias("tpr"), F.try_divide("fps", "N").alias("fpr"))
    start = cum.agg(F.max("P").alias("P"), F.max("N").alias("N")).filter("P is not null").select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0).cast("long").alias("tps"),
        F.lit(0).cast("long").alias("fps"), F.try_divide(F.lit(0.0), "P").alias("tpr"),
        F.try_divide(F.lit(0.0), "N").alias("fpr"))
    return start.unionByName(points)


def _auc_terms(cum: DataFrame) -> Column:
    """pos_s * (negatives strictly below s + ties / 2), summed and normalised by P*N; NULL when a
    class is absent."""
    below = F.col("N") - F.col("fps")
    return F.try_divide(F.sum(F.col("pos") * (below + F.col("neg") / 2.0)), F.first("P") * F.first("N"))


def auc(df: DataFrame, label, score, positive=1) -> DataFrame:
    """Exact ROC AUC with ties counted half (M7); one row ``auc``."""
    cum = cumulative_counts(score_counts(df, label, score, positive=positive))
    return cum.agg(_auc_terms(cum).alias("auc"))


def pr_curve(df: DataFrame, label, score, positive=1) -> DataFrame:
    """(threshold, precision, recall) per distinct score, descending (M9), and the end point of
    recall 0 and precision 1, which has no threshold."""
    cum = cumulative_counts(score_counts(df, label, score, positive=positive))
    return _pr_points(cum, [])


def _pr_points(cum: DataFrame, group_cols) -> DataFrame:
    points = cum.select(*group_cols, F.col("score").alias("threshold"),
                        F.try_divide(F.col("tps"), F.col("tps") + F.col("fps")).alias("precision"),
                        F.try_divide("tps", "P").alias("recall"))
    last = cum.groupBy(*group_cols).agg(F.max("P").alias("P")).filter("P is not null").select(
        *group_cols, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.try_divide(F.lit(0.0), "P").alias("recall"))
    return points.unionByName(last)


def pr_curves_by_class(df: DataFrame, label, class_scores: dict) -> DataFrame:
    """One-vs-rest precision-recall points of every class (M9): class_label, threshold, precision,
    recall, from one exploded pass."""
    return _pr_points(_one_vs_rest(df, label, class_scores), ["class_label"])


def average_precision(df: DataFrame, label, score, positive=1) -> DataFrame:
    """AP = sum over thresholds of (R_n - R_n-1) * P_n; the recall step is pos/P (M9)."""
    cum = cumulative_counts(score_counts(df, label, score, positive=positive))
    precision = F.col("tps") / (F.col("tps") + F.col("fps"))
    return cum.agg(F.try_divide(F.sum(F.col("pos") * precision), F.first("P")).alias("average_precision"))


def auc_one_vs_rest(df: DataFrame, label, class_scores: dict) -> DataFrame:
    """Per class AUC of its score against the rest, plus the prevalence-weighted mean (M8).

    ``class_scores`` maps a class value to its score column/expression; every
    class enters the weighted mean; one without positives or negatives has no AUC
    and does not count there.  Output: class_label, n_pos, prevalence, auc,
    weighted_auc, from one exploded pass grouped by class.
    """
    cum = _one_vs_rest(df, label, class_scores)
    per = cum.groupBy("class_label").agg(F.first("P").alias("n_pos"), F.first("N").alias("_n_neg"),
                                         _auc_terms(cum).alias("auc"))
    every = Window.partitionBy()  # one row per class
    per = per.withColumn("prevalence",
                         F.try_divide(F.col("n_pos"),
                                      F.sum(F.col("n_pos") + F.col("_n_neg")).over(every)))
    known = F.when(F.col("auc").isNotNull(), F.col("n_pos"))
    wavg = F.try_divide(F.sum(F.col("auc") * F.col("n_pos")).over(every), F.sum(known).over(every))
    return per.withColumn("weighted_auc", wavg).select(
        "class_label", F.col("n_pos").cast("long").alias("n_pos"), "prevalence", "auc",
        "weighted_auc")


def _one_vs_rest(df: DataFrame, label, class_scores: dict) -> DataFrame:
    """Cumulative counts of every class's score against the rest."""
    lab = _c(label).cast("string")
    entries = [F.struct(F.lit(str(k)).alias("class_label"),
                        (lab == F.lit(str(k))).cast("int").alias("_y"),
                        _c(s).cast("double").alias("_s")) for k, s in class_scores.items()]
    long = df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
    return cumulative_counts(score_counts(long, "_y", "_s", group_cols=["class_label"]),
                             ["class_label"])


def roc_curves_by_class(df: DataFrame, label, class_scores: dict) -> DataFrame:
    """One-vs-rest ROC points of every class (the chart data of M8): class_label, threshold, tpr, fpr."""
    cum = _one_vs_rest(df, label, class_scores)
    return cum.select("class_label", F.col("score").alias("threshold"),
                      F.try_divide("tps", "P").alias("tpr"), F.try_divide("fps", "N").alias("fpr"))
