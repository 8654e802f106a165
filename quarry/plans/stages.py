"""The reference's stages as plain functions over DataFrames.

ingest -> profile -> prepare -> train -> evaluate.  Each stage returns its
report as a one-row DataFrame (plus the data it hands on); tables, not CSV
files, pass between stages, and nothing is run as a separate process.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import TOP_VALUES
from quarry.functions.calendar import add_calendar_features
from quarry.functions.numeric import normalized_problem_type
from quarry.operators import curves as crv
from quarry.operators import metrics as met
from quarry.operators import modeling as mdl
from quarry.operators import profile as prof
from quarry.operators import quality as qual
from quarry.operators.columns import (column_roles, problem_type, prune_columns, prune_decision,
                                      type_partition)
from quarry.operators.ordering import chronological_split

def _one_row(spark, fields: dict, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([tuple(fields[f.name] for f in schema.fields)], schema)


# ---------------------------------------------------------------- stage 1

INGESTION_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()), T.StructField("target_column", T.StringType()),
    T.StructField("problem_type", T.StringType()), T.StructField("split_strategy", T.StringType()),
    T.StructField("date_column", T.StringType()), T.StructField("total_rows_raw", T.LongType()),
    T.StructField("duplicate_rows_dropped", T.LongType()),
    T.StructField("total_missing_values", T.LongType()), T.StructField("missing_pct", T.DoubleType()),
    T.StructField("constant_columns", T.ArrayType(T.StringType())),
    T.StructField("empty_columns_dropped", T.ArrayType(T.StringType())),
    T.StructField("train_rows", T.LongType()), T.StructField("val_rows", T.LongType()),
    T.StructField("test_rows", T.LongType()), T.StructField("n_columns", T.IntegerType()),
    T.StructField("column_list", T.ArrayType(T.StringType())),
])


@dataclass
class Ingested:
    report: DataFrame
    split: DataFrame
    target: str
    problem_type: str


def ingest(df: DataFrame, target: str | None, date_col: str, tie_break, derived=(),
           train: float = 0.70, val: float = 0.15, handoff: str = "checkpoint") -> Ingested:
    """Stage 1: P1 -> P2 -> A5 -> A1 (before de-dup) -> A3 -> P5 -> F1/P3/F5 -> W1 -> A21.

    ``handoff="checkpoint"`` writes the labelled split to the cluster's
    ``spark.checkpoint.dir`` (the reference writes its split files here):
    later stages read it many times, and a lost executor then costs a re-read
    instead of re-running de-duplication and ranking.  ``"persist"`` keeps it
    in executor storage; ``"none"`` leaves it lazy.
    """
    spark = df.sparkSession
    target = qual.resolve_target(df, target)
    df = qual.drop_null_target(df, target)
    kind = problem_type(df, target)
    q = qual.quality_summary(df).first()
    dedup = qual.deduplicate(df) if q["n_duplicate_rows"] else df
    empty = qual.empty_columns(dedup)
    cleaned = dedup.drop(*empty) if empty else dedup
    if derived:
        cleaned = add_calendar_features(cleaned, date_col, derived)
    elif date_col in cleaned.columns:
        cleaned = qual.drop_unparseable_dates(cleaned, date_col)
    split = chronological_split(cleaned, date_col, tie_break, train, val)
    if handoff == "checkpoint":
        split = split.checkpoint(eager=True)
    elif handoff == "persist":
        split = split.persist()
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    cols = [c for c in split.columns if c != "split"]
    report = _one_row(spark, {
        "stage": "data_ingestion", "target_column": target, "problem_type": kind,
        "split_strategy": "chronological", "date_column": date_col,
        "total_rows_raw": q["n_rows"], "duplicate_rows_dropped": q["n_duplicate_rows"],
        "total_missing_values": q["n_missing"], "missing_pct": q["missing_pct"],
        "constant_columns": list(q["constant_columns"]), "empty_columns_dropped": empty,
        "train_rows": counts.get("train", 0), "val_rows": counts.get("val", 0),
        "test_rows": counts.get("test", 0), "n_columns": len(cols), "column_list": cols,
    }, INGESTION_SCHEMA)
    return Ingested(report, split, target, kind)


# ---------------------------------------------------------------- stage 2

EDA_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()), T.StructField("target_column", T.StringType()),
    T.StructField("problem_type", T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("n_numeric_features", T.IntegerType()),
    T.StructField("n_categorical_features", T.IntegerType()),
    T.StructField("dropped_id_cols", T.ArrayType(T.StringType())),
    T.StructField("total_missing", T.LongType()), T.StructField("total_outliers_iqr", T.LongType()),
    T.StructField("high_skew_features", T.ArrayType(T.StringType())),
    T.StructField("target_stats", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("n_classes", T.LongType()),
    T.StructField("class_counts", T.MapType(T.StringType(), T.LongType())),
])


@dataclass
class Profiled:
    report: DataFrame
    skew_kurtosis: DataFrame
    outliers: DataFrame
    charts: dict


def profile_train(train: DataFrame, target: str | None = None, exact: bool = True,
                  with_charts: bool = True) -> Profiled:
    """Stage 2 over the training rows: ID drop (may drop the target), moments, outliers.

    One sketch a numeric column serves all quantiles. The report names the number of classes of a classification target and
    its most frequent ones; all of them are a chart table. ``with_charts`` also builds the chart-data tables.
    """
    spark = train.sparkSession
    roles = column_roles(train, None, exclude_target=False)
    df = train.drop(*roles.id_like) if roles.id_like else train
    target = qual.resolve_target(df, target)
    kind = problem_type(df, target)
    numeric, categorical = type_partition(df, target)
    moments = prof.moments(df, numeric, with_median=False) if numeric else None
    sketched = list(dict.fromkeys([*numeric, *([target] if kind == "regression" else [])]))
    sketches = prof.column_sketches(df, sketched) if sketched else None
    outliers = prof.iqr_outliers(df, numeric, exact=exact, sketches=sketches).checkpoint() if numeric else None
    total_out = outliers.agg(F.sum("n_outliers")).first()[0] if outliers is not None else 0
    high = ([r["column_name"] for r in moments.filter("is_high_skew").collect()]
            if moments is not None else [])
    missing = qual.total_missing(df).first()["n_missing"]
    stats, classes, n_classes = None, None, None
    if kind == "regression":
        m = prof.moments(df, [target], exact_median=exact, digits=None, sketches=sketches).first()
        stats = {"target_mean": m["mean"], "target_std": m["std"],
                 "target_median": m["median"], "target_skew": m["skewness"]}
    else:
        n_classes = qual.nan_as_null(df).agg(F.count_distinct(F.col(f"`{target}`"))).first()[0]
        classes = {r["value"]: r["n"] for r in prof.value_counts(df, [target], TOP_VALUES).collect()}
    report = _one_row(spark, {
        "stage": "eda", "target_column": target, "problem_type": kind, "n_rows": roles.n_rows,
        "n_numeric_features": len(numeric), "n_categorical_features": len(categorical),
        "dropped_id_cols": roles.id_like, "total_missing": missing,
        "total_outliers_iqr": int(total_out or 0), "high_skew_features": high,
        "target_stats": stats, "n_classes": n_classes, "class_counts": classes,
    }, EDA_SCHEMA)
    low = [c for c in categorical if c in roles.low_cardinality]
    charts = prof.chart_tables(df, target, kind, numeric, categorical, low, outliers) if with_charts else {}
    return Profiled(report, moments, outliers, charts)


# ---------------------------------------------------------------- stage 3

PREP_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()), T.StructField("target_column", T.StringType()),
    T.StructField("problem_type", T.StringType()),
    T.StructField("dropped_cols", T.ArrayType(T.StringType())),
    T.StructField("train_rows", T.LongType()), T.StructField("val_rows", T.LongType()),
    T.StructField("test_rows", T.LongType()), T.StructField("n_columns", T.IntegerType()),
    T.StructField("n_numeric_features", T.IntegerType()),
    T.StructField("n_categorical_features", T.IntegerType()),
    T.StructField("total_missing", T.LongType()),
    T.StructField("high_skew_features", T.ArrayType(T.StringType())),
])


def prepare(split: DataFrame, target: str, explicit=(), order_cols=(), tie_break=()
            ) -> tuple[DataFrame, DataFrame]:
    """Stage 3: drops decided on train (P4, P6-P9) and applied to every split."""
    spark = split.sparkSession
    train = split.filter(F.col("split") == "train").drop("split")
    drops = prune_decision(train, target, explicit, order_cols, tie_break)
    keep = [d for d in drops if d in explicit or (d not in order_cols and d not in tie_break)]
    pruned = prune_columns(split, keep)
    train_p = pruned.filter(F.col("split") == "train").drop("split")
    numeric, categorical = type_partition(train_p, target)
    kind = problem_type(train_p, target)
    counts = {r["split"]: r["count"] for r in pruned.groupBy("split").count().collect()}
    high = ([r["column_name"] for r in prof.moments(train_p, numeric, with_median=False)
             .filter("is_high_skew").collect()] if numeric else [])
    report = _one_row(spark, {
        "stage": "data_preparation", "target_column": target, "problem_type": kind,
        "dropped_cols": keep, "train_rows": counts.get("train", 0),
        "val_rows": counts.get("val", 0), "test_rows": counts.get("test", 0),
        "n_columns": len(train_p.columns), "n_numeric_features": len(numeric),
        "n_categorical_features": len(categorical),
        "total_missing": qual.total_missing(train_p).first()["n_missing"],
        "high_skew_features": high,
    }, PREP_SCHEMA)
    return report, pruned


# ---------------------------------------------------------------- stage 4

def train_models(split: DataFrame, target: str, key_cols, exclude=(), folds: int = 3,
                 budget_s: float | None = None) -> tuple[mdl.Tournament, DataFrame]:
    """Stage 4: tournament on train, selection on the chronological validation split."""
    train = split.filter(F.col("split") == "train").drop("split")
    val = split.filter(F.col("split") == "val").drop("split")
    kind = problem_type(train, target, fine=True)
    t = mdl.run_tournament(train, val, target, kind, key_cols, folds=folds, exclude=exclude,
                           budget_s=budget_s)
    return t, mdl.leaderboard_frame(split.sparkSession, t)


# ---------------------------------------------------------------- stage 5

EVAL_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()), T.StructField("best_model", T.StringType()),
    T.StructField("problem_type", T.StringType()), T.StructField("eval_metric", T.StringType()),
    T.StructField("target_col", T.StringType()), T.StructField("test_rows", T.LongType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])


def score_test(split: DataFrame, t: mdl.Tournament) -> DataFrame:
    """The test rows with the best model's prediction (``_q_pred``; for classification also ``prob_<class>``),
    written to the checkpoint folder: all metrics and tables of stage 5 read this one copy."""
    test = split.filter(F.col("split") == "test").drop("split")
    rows = mdl.predict_proba(test, t) if t.kind != "regression" else test
    return mdl.predict(rows, t, out_col="_q_pred").checkpoint()


def evaluate(split: DataFrame, t: mdl.Tournament, scored: DataFrame | None = None) -> DataFrame:
    """Stage 5: test metrics of the best model (M1/M3/M5 or M2 + M7/M8); ``scored`` is that of ``score_test``."""
    spark = split.sparkSession
    test = split.filter(F.col("split") == "test").drop("split")
    target = t.spec.target
    scored = score_test(split, t) if scored is None else scored
    n_features = len([c for c in test.columns if c != target])
    if t.kind == "regression":
        row = met.regression_metrics(scored, target, "_q_pred", n_features=n_features).first()
        metrics = {k: row[k] for k in ("rmse", "mae", "mse", "r2", "explained_variance",
                                       "mape", "adjusted_r2")}
        metrics["r2_score"] = metrics.pop("r2")
    else:
        row = met.classification_metrics(scored, target, "_q_pred").first()
        metrics = {k: row[k] for k in ("accuracy", "precision", "recall", "f1_score")}
        probs = scored
        if t.kind == "binary":
            pos = t.labels[-1]
            a = crv.auc(probs.withColumn("_y", (F.col(target).cast("string") == pos).cast("int")),
                        "_y", f"prob_{pos}").first()["auc"]
            metrics["roc_auc"] = a
        else:
            scores = {lbl: F.col(f"prob_{lbl}") for lbl in t.labels}
            a = crv.auc_one_vs_rest(probs, target, scores).first()["weighted_auc"]
            metrics["roc_auc_ovr_weighted"] = a
    report = _one_row(spark, {
        "stage": "evaluation", "best_model": t.best,
        "problem_type": normalized_problem_type(t.kind),
        "eval_metric": t.eval_metric, "target_col": target,
        "test_rows": test.count(), "metrics": {k: (float(v) if v is not None else None)
                                              for k, v in metrics.items()},
    }, EVAL_SCHEMA)
    return report


def evaluation_tables(split: DataFrame, t: mdl.Tournament, key_cols,
                      scored: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of stage 5: what the charts of the evaluation show, and feature importance.

    Regression: residuals (a histogram of 60 bins, and key, actual, predicted, residual of every test row)
    and the perfect-fit range. Classification: confusion matrix, report, ROC and precision-recall points.
    """
    from quarry.operators.importance import permutation_importance
    test = split.filter(F.col("split") == "test").drop("split")
    target = t.spec.target
    scored = score_test(split, t) if scored is None else scored
    out = {"importance": permutation_importance(test, t, key_cols)}
    if t.kind == "regression":
        pairs = met.residuals(scored, target, "_q_pred").select(
            *key_cols, F.col(target).cast("double").alias("actual"),
            F.col("_q_pred").alias("predicted"), "residual")
        out |= {"actual_vs_predicted": pairs, "residual_histogram": prof.histogram(pairs, "residual", 60),
                "fit_range": prof.fit_range(pairs, "actual", "predicted")}
        return out
    out |= {"confusion": met.confusion(scored, target, "_q_pred"),
            "classification_report": met.classification_report(scored, target, "_q_pred")}
    scores = {lbl: F.col(f"prob_{lbl}") for lbl in t.labels}
    out |= {"roc_points": crv.roc_curves_by_class(scored, target, scores),
            "pr_points": crv.pr_curves_by_class(scored, target, scores)}
    return out


# ---------------------------------------------------------------- all stages

def run_all(df: DataFrame, target: str, date_col: str, tie_break, key_cols, out_dir: str,
            explicit_drops=(), folds: int = 3, budget_s: float | None = None,
            exclude=()) -> dict[str, DataFrame]:
    """Stages 1-5 in order, each report and table written under ``out_dir``.

    Outputs: ``ingestion`` / ``eda`` / ``preparation`` / ``evaluation`` reports (JSON), ``splits`` (the cleaned
    table) and ``prepared`` (parquet partitioned by split), the scoring ``template`` (20 rows without the
    target), the ``skew_kurtosis``, ``outliers``, ``leaderboard``, ``charts/*`` and ``evaluation_tables/*``
    tables (CSV) and the saved ``model``.  The date column is a feature (year, month, day, weekday) unless
    excluded.
    A failing stage raises and stops the run, like the reference's runner.
    """
    from quarry.operators.modeling import save
    from quarry.sources.sinks import export_template, write_report, write_splits, write_table

    ing = ingest(df, target, date_col, tie_break)
    write_report(ing.report, f"{out_dir}/ingestion")
    write_splits(ing.split, f"{out_dir}/splits")
    train = ing.split.filter(F.col("split") == "train").drop("split")
    prof_out = profile_train(train, ing.target, with_charts=True)
    write_report(prof_out.report, f"{out_dir}/eda")
    if prof_out.skew_kurtosis is not None:
        write_table(prof_out.skew_kurtosis.select("column_name", "skewness", "kurtosis"),
                    f"{out_dir}/skew_kurtosis")
    if prof_out.outliers is not None:
        write_table(prof_out.outliers, f"{out_dir}/outliers")
    for name, table in prof_out.charts.items():
        write_table(table, f"{out_dir}/charts/{name}")
    prep_report, pruned = prepare(ing.split, ing.target, explicit_drops, [date_col], tie_break)
    write_report(prep_report, f"{out_dir}/preparation")
    write_splits(pruned, f"{out_dir}/prepared")
    export_template(pruned.drop("split"), f"{out_dir}/template", ing.target, [date_col, *tie_break]
                    if date_col in pruned.columns else list(key_cols))
    t, board = train_models(pruned, ing.target, key_cols, exclude=tuple(exclude),
                            folds=folds, budget_s=budget_s)
    write_table(board, f"{out_dir}/leaderboard")
    save(t, f"{out_dir}/model", df.sparkSession)
    scored = score_test(pruned, t)
    ev = evaluate(pruned, t, scored)
    write_report(ev, f"{out_dir}/evaluation")
    for name, table in evaluation_tables(pruned, t, key_cols, scored).items():
        write_table(table, f"{out_dir}/evaluation_tables/{name}")
    return {"ingestion": ing.report, "eda": prof_out.report, "preparation": prep_report,
            "leaderboard": board, "evaluation": ev}
