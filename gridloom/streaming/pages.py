"""Pages as a stream: files that arrive in a directory, through stage 1, into Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.config import Stage1
from gridloom.operators.pages import IMAGE
from gridloom.plans.stages import stage1


def arriving(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """Page rows (Parquet files of the image schema) as they arrive."""
    return spark.readStream.schema(IMAGE).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def tables_stream(pages: DataFrame, out: str, checkpoint: str, config: Stage1 | None = None):
    """A query that writes each batch's cropped tables under out; a batch that runs again replaces its own files."""

    def write(batch: DataFrame, number: int) -> None:
        found = stage1(batch, config)
        try:
            found["tables"].withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)
        finally:
            found.release()

    return pages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def windowed_counts(events: DataFrame, length: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Events (ts, event_type, value) per window and type, closed when the watermark has passed."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
