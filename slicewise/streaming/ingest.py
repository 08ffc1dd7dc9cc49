"""Measurements as a stream: the flags of slices whose images keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def measurements(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder, as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def failed_by_window(stream: DataFrame, time: str, failed: str, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Failed and all slices for each plate and time window; state older than the watermark is dropped."""
    return (
        stream.withWatermark(time, late).groupBy(F.window(time, width).alias("window"), "plate")
        .agg(F.count_if(F.col(failed)).alias("failed"), F.count("*").alias("slices"))
        .select("window.start", "window.end", "plate", "failed", "slices")
    )
