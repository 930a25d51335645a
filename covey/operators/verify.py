"""Checks of tables on disk: readable files, equal schemas, equal row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def file_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each file, from one pass; a file that can't be read fails the job."""
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size_bytes")).agg(F.count(F.lit(1)).alias("n_rows"))


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """Files, bytes, rows and columns of a table's files that have rows."""
    width = len(spark.read.parquet(path).columns)
    return file_counts(spark, path).agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"), F.lit(width).alias("columns"))


def schema_changes(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """Files whose schema isn't the first one's, with their schemas."""
    schemas = {f: spark.read.parquet(f).schema.simpleString() for f in files}
    first = schemas[files[0]] if files else None
    return {f: s for f, s in schemas.items() if s != first}


def reconciled(counts: dict[str, int]) -> dict[str, int]:
    """Differences of row counts from the first table's; raises when a table has others."""
    first = next(iter(counts.values()), 0)
    wrong = {k: n - first for k, n in counts.items() if n != first}
    if wrong:
        raise ValueError(f"row counts differ from the first table: {wrong}")
    return {k: 0 for k in counts}
