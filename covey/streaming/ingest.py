"""Incremental ingest of observations as streams: an extension beyond what batch runs need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def observation_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def once_each(stream: DataFrame, key: list[str], time: str, late: str = "7 days") -> DataFrame:
    """Rows without those that repeat a key within the time that late rows may come; state is bounded by it."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def windowed_effort(stream: DataFrame, time: str, cell: str, checklist: str, width: str = "30 days", late: str = "7 days") -> DataFrame:
    """Records and an estimate of the distinct checklists of each cell and window, given out once the window is closed."""
    grouped = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("period"), F.col(cell).alias("cell"))
    return grouped.agg(F.count(F.lit(1)).alias("records"), F.approx_count_distinct(checklist, 0.02).alias("checklists"))


def write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Runs what is there through to Parquet and ends."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
