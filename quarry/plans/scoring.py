"""Batch scoring (the upload form's pipeline as a DataFrame job).

required-column check (P13) -> coercion (P10-P12) -> prediction (T8) ->
half-even rounding (F13) -> prediction first (P19), highest first (L2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import round_half_even
from quarry.operators import modeling as mdl
from quarry.operators.columns import missing_required
from quarry.operators.features import coerce_batch, reorder
from quarry.session import batches_by_rows, ensure_checkpoint_dir


class MissingColumns(ValueError):
    pass


def score_batch(df: DataFrame, t: mdl.Tournament, target: str, keys=(), required=None,
                int_cols=(), float_cols=(), digits: int = 2, sort: bool = True) -> DataFrame:
    """Score a batch with the tournament's best model.

    Raises :class:`MissingColumns` listing required names that are absent.
    With ``sort`` the rows come highest prediction first (L2).  A range sort
    samples its input before shuffling, which would run every model twice, so
    the scored rows are written to the checkpoint folder first and both passes read that copy.
    """
    required = list(required or (t.spec.numeric + t.spec.categorical))
    missing = missing_required(df, required)
    if missing:
        raise MissingColumns(f"missing required columns: {missing}")
    typed = coerce_batch(df, int_cols, float_cols, clean_strings=bool(int_cols or float_cols))
    pred_col = f"Predicted_{target}"
    scored = mdl.predict(typed, t, out_col="_q_pred")
    scored = scored.withColumn(pred_col, round_half_even(F.col("_q_pred"), digits)).drop("_q_pred")
    scored = reorder(scored, [pred_col, *keys])
    if not sort:
        return scored
    ensure_checkpoint_dir(df.sparkSession)
    with batches_by_rows(df.sparkSession):
        scored = scored.checkpoint()
    return scored.orderBy(F.desc(pred_col), *keys)


def batch_summary(scored: DataFrame, pred_col: str) -> DataFrame:
    """Rows, mean, max and min of the predictions."""
    p = F.col(pred_col)
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(p).alias("avg_prediction"),
                      F.max(p).alias("max_prediction"), F.min(p).alias("min_prediction"))
