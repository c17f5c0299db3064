"""ML-21 on a stream: new rows scored by an already fitted ``PipelineModel``.

The model's stages are row-wise (scalers, assemblers, linear models), so
``transform`` applies unchanged to a streaming DataFrame: no refit, no
state.  The query's progress lives in a checkpoint location on shared
storage, so a restarted driver or lost executors resume from the last
committed micro-batch, and the file sink writes each batch exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_new_rows(spark: SparkSession, path: str, schema: StructType | str,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over ``path`` (an explicit schema is required)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def score_stream(model, rows: DataFrame, keep: list[str], prediction: str = "prediction") -> DataFrame:
    """Apply the fitted model to every micro-batch; keep key columns and
    the prediction."""
    return model.transform(rows).select(*keep, prediction)


def write_available(scored: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> str:
    """Process everything available now in micro-batches, then stop."""
    q = (scored.writeStream.format(fmt).outputMode("append")
               .option("path", path).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return path
