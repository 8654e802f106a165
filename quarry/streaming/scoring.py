"""Batch scoring on a folder that receives upload files (Structured Streaming).

The reference scores one uploaded CSV at a time.  Here new files landing in
a folder are read as a file stream with a fixed schema, coerced and scored
with the same row-wise expressions as the batch path (no sort: a stream
has no total order), and appended to a sink.  Exactly-once output comes from
the checkpoint; ``availableNow`` processes what is there and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.functions.numeric import round_half_even
from quarry.operators import modeling as mdl
from quarry.operators.features import coerce_batch


def scored_stream(spark: SparkSession, input_dir: str, schema: StructType, t: mdl.Tournament,
                  int_cols=(), float_cols=(), digits: int = 2,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of scored rows from CSV files arriving in ``input_dir``."""
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(input_dir)
    typed = coerce_batch(raw, int_cols, float_cols, clean_strings=bool(int_cols or float_cols))
    pred_col = f"Predicted_{t.spec.target}"
    scored = mdl.predict(typed, t, out_col="_q_pred")
    return scored.withColumn(pred_col, round_half_even(F.col("_q_pred"), digits)).drop("_q_pred")


def start_scoring(stream: DataFrame, output_dir: str, checkpoint_dir: str,
                  available_now: bool = True, fmt: str = "parquet") -> StreamingQuery:
    """Append scored rows to ``output_dir``; the checkpoint makes restarts exactly-once."""
    writer = (stream.writeStream.format(fmt).outputMode("append")
                    .option("path", output_dir).option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
