"""Readers of observation dumps, taxonomies and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import schemas


def typed(text: DataFrame) -> DataFrame:
    """Observation columns cast to their types; what can't be cast is null."""
    return text.select(*(F.col(n).try_cast(t).alias(n) if t != "string" else F.col(n) for n, t in schemas.OBSERVATION_COLUMNS))


def rejects(text: DataFrame) -> DataFrame:
    """How many values of each typed column can't be cast."""
    wrong = [F.count_if(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull()).alias(n) for n, t in schemas.OBSERVATION_COLUMNS if t != "string"]
    return text.agg(*wrong)


def observation_text(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """The dump's rows by position as text, empty ones null. A gzip file is one split, so its rows are dealt out again."""
    rows = spark.read.csv(path, sep="\t", schema=schemas.OBSERVATION_TEXT, header=header, quote="", escape="", nullValue="", enforceSchema=True, mode="PERMISSIVE")
    return rows.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else rows


def observations(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    return typed(observation_text(spark, path, header))


def parquet(spark: SparkSession, *paths: str, cells: list | None = None, cell: str = "boundary_cell") -> DataFrame:
    """Parquet files; of a table that is partitioned by cell only the named ones are opened."""
    rows = spark.read.parquet(*paths)
    return rows if cells is None else rows.where(F.col(cell).isin(cells))


def missing_cells(wanted: DataFrame, present: DataFrame, cell: str = "boundary_cell") -> DataFrame:
    return wanted.select(cell).distinct().join(present.select(cell).distinct(), cell, "left_anti")


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def xml_species(spark: SparkSession, path: str) -> DataFrame:
    """The orders of a species list, nested; extinct attributes as _extinct."""
    return spark.read.format("xml").options(rowTag="order", attributePrefix="_").schema(schemas.ORDERS).load(path)


def xml_version(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").options(rowTag="list", attributePrefix="_").schema("_version string").load(path).select(F.col("_version").alias("version"))


def csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=False)


def mapping(spark: SparkSession, path: str) -> DataFrame:
    """A name mapping as (scientific_name, taxon_id, url, ordinal), whatever the case of its headers; the ordinal is the row's place."""
    rows = csv(spark, path)
    by_lower = {c.strip().lower(): c for c in rows.columns}
    pick = lambda *names: next((F.col(f"`{by_lower[n]}`") for n in names if n in by_lower), F.lit(None).cast("string"))
    return rows.select(
        pick("scientific_name").alias("scientific_name"),
        pick("avibaseid", "avibase_id", "taxon_id").alias("taxon_id"),
        pick("birds_of_the_world_url", "url").alias("url"),
        F.monotonically_increasing_id().alias("ordinal"),
    )
