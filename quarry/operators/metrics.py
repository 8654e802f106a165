"""Evaluation metrics (M1-M6, M10, S11): one aggregate pass each.

Label and prediction live in the same row (a model's ``transform`` appends
the prediction), so no two frames are ever zipped by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import circular_add, circular_diff

from quarry.constants import MAPE_NONZERO as NONZERO_EPS  # noqa: E402
from quarry.session import ensure_checkpoint_dir


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _score_ratio(num: Column, den: Column) -> Column:
    """1 - num/den with sklearn's finite convention: den = 0 gives 1.0 if num = 0 else 0.0."""
    return (F.when(den == 0, F.when(num == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
             .otherwise(F.lit(1.0) - num / den))


def usable(*cols) -> list[Column]:
    """The columns as doubles, all of them NULL in rows where any is NULL or NaN, so that every
    term of a metric covers the same rows."""
    values = [_c(c).cast("double") for c in cols]
    whole = F.lit(True)
    for v in values:
        whole = whole & v.isNotNull() & ~F.isnan(v)
    return [F.when(whole, v) for v in values]


def _regression_aggs(y: Column, p: Column, base: Column, diff: Column, tag: str) -> list[Column]:
    res = y - p
    return [
        F.sum(res * res).alias(f"_sse{tag}"),
        F.sum(F.abs(res)).alias(f"_sae{tag}"),
        (F.var_pop(y) * F.count(y)).alias(f"_sst{tag}"),
        F.var_pop(res).alias(f"_vres{tag}"),
        F.var_pop(y).alias(f"_vy{tag}"),
        F.avg(F.when(F.abs(base) > NONZERO_EPS, F.abs(diff) / base)).alias(f"_mape{tag}"),
    ]


def _regression_finish(tag: str) -> dict[str, Column]:
    n = F.col("n")
    sse = F.col(f"_sse{tag}")
    return {
        "rmse": F.sqrt(F.try_divide(sse, n)),
        "mae": F.try_divide(F.col(f"_sae{tag}"), n),
        "mse": F.try_divide(sse, n),
        "r2": _score_ratio(sse, F.col(f"_sst{tag}")),
        "explained_variance": _score_ratio(F.col(f"_vres{tag}"), F.col(f"_vy{tag}")),
        "mape": F.col(f"_mape{tag}") * 100,
    }


def _adjusted(r2: Column, n_features: int) -> Column:
    dof = F.col("n") - F.lit(int(n_features)) - 1
    return F.when(dof > 0, F.lit(1.0) - (F.lit(1.0) - r2) * (F.col("n") - 1) / dof)


def regression_metrics(df: DataFrame, y, p, n_features: int | None = None) -> DataFrame:
    """One row: n, rmse, mae, mse, r2, explained_variance, mape, adjusted_r2 (M1, M3, M5).

    R^2 is 1 - SSE/SST (not the squared correlation).
    Rows with a missing label or prediction enter no term and not n.  MAPE averages
    |y - p| / y over rows with |y| > 1e-6 - the denominator keeps its sign -
    and is NULL when no row qualifies.  Adjusted R^2 needs n - k - 1 > 0.
    """
    yc, pc = usable(y, p)
    agg = df.agg(F.count(yc).alias("n"), *_regression_aggs(yc, pc, yc, yc - pc, ""))
    fin = _regression_finish("")
    out = agg.select("n", *[e.alias(k) for k, e in fin.items()])
    if n_features is not None:
        out = out.withColumn("adjusted_r2", _adjusted(F.col("r2"), n_features))
    return out


def circular_metrics(df: DataFrame, y, p, base, period: int = 1440,
                     n_features: int | None = None) -> DataFrame:
    """Metrics for a delay added to a clock time (M6), one aggregate pass.

    rmse/mae/mse use the raw delay; R^2 and explained variance use the wrapped
    clock times ``(base + y) mod period`` against ``(base + p) mod period``;
    MAPE divides the wrapped signed difference by the wrapped actual time
    where that time is above 1e-6.
    """
    yc, pc, bc = usable(y, p, base)
    act_true = circular_add(bc, yc, period)
    act_pred = circular_add(bc, pc, period)
    diff = circular_diff(yc, pc, period)
    agg = df.agg(F.count(yc).alias("n"),
                 *_regression_aggs(yc, pc, yc, yc - pc, "_raw"),
                 *_regression_aggs(act_true, act_pred,
                                   F.when(act_true > NONZERO_EPS, act_true), diff, "_wrap"))
    raw, wrap = _regression_finish("_raw"), _regression_finish("_wrap")
    cols = [raw["rmse"].alias("rmse"), raw["mae"].alias("mae"), raw["mse"].alias("mse"),
            wrap["r2"].alias("r2"), wrap["explained_variance"].alias("explained_variance"),
            wrap["mape"].alias("mape")]
    out = agg.select("n", *cols)
    if n_features is not None:
        out = out.withColumn("adjusted_r2", _adjusted(F.col("r2"), n_features))
    return out


def residuals(df: DataFrame, y, p, name: str = "residual") -> DataFrame:
    """Append y - p."""
    return df.withColumn(name, _c(y).cast("double") - _c(p).cast("double"))


# ---------------------------------------------------------------- classification

def confusion(df: DataFrame, y, p) -> DataFrame:
    """(label, prediction, n) over all rows, labels as strings (M4)."""
    return (df.groupBy(_c(y).cast("string").alias("label"), _c(p).cast("string").alias("prediction"))
              .agg(F.count(F.lit(1)).alias("n")))


def per_class(conf: DataFrame) -> DataFrame:
    """Per class: support, tp, predicted, precision, recall, f1 (zero division -> 0).

    The class set is every label seen as truth or prediction, as in sklearn.
    Each confusion cell contributes to its true class (support, tp) and to its
    predicted class (predicted): one explode and one aggregate, no joins.
    """
    n = F.col("n")
    cells = F.array(
        F.struct(F.col("label").alias("class_label"), n.alias("support"),
                 F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), n).otherwise(0).alias("tp")),
        F.struct(F.col("prediction").alias("class_label"), F.lit(0).cast("long").alias("support"),
                 n.alias("predicted"), F.lit(0).cast("long").alias("tp")))
    t = (conf.select(F.explode(cells).alias("_c")).select("_c.*")
             .filter(F.col("class_label").isNotNull())
             .groupBy("class_label")
             .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                  F.sum("tp").alias("tp")))
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    t = t.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(0.0)
    return t.withColumn("f1", f1)


def classification_metrics(df: DataFrame, y, p) -> DataFrame:
    """One row: n, accuracy, support-weighted precision, recall and F1 (M2)."""
    pc = per_class(confusion(df, y, p))
    total = F.sum("support")
    return pc.agg(
        total.alias("n"),
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), total).alias("precision"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), total).alias("recall"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), total).alias("f1_score"),
    )


def classification_report(df: DataFrame, y, p) -> DataFrame:
    """Per-class rows plus ``macro avg`` and ``weighted avg`` rows.

    Columns: row_label, precision, recall, f1, support.  Accuracy is the
    ``accuracy`` row with its value in f1 and support = n, as in the text report.
    """
    ensure_checkpoint_dir(df.sparkSession)
    pc = per_class(confusion(df, y, p)).checkpoint()  # a row a class
    rows = pc.select(F.col("class_label").alias("row_label"), "precision", "recall", "f1",
                     "support")
    total = F.sum("support")
    macro = pc.agg(F.lit("macro avg").alias("row_label"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                   total.alias("support"))
    weighted = pc.agg(F.lit("weighted avg").alias("row_label"),
                      F.try_divide(F.sum(F.col("precision") * F.col("support")), total).alias("precision"),
                      F.try_divide(F.sum(F.col("recall") * F.col("support")), total).alias("recall"),
                      F.try_divide(F.sum(F.col("f1") * F.col("support")), total).alias("f1"),
                      total.alias("support"))
    acc = pc.agg(F.lit("accuracy").alias("row_label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 F.try_divide(F.sum("tp"), total).alias("f1"), total.alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)
