"""Writers: chunked and sorted Parquet, tables by cell and band, documents, and lookup packs as SQLite files."""

from __future__ import annotations

import gzip
import json
import os
import sqlite3

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import geo

CHUNK_ROWS = 1_000_000
ORDERS = {
    "location": ("latitude", "longitude", "group_identifier", "sampling_event_identifier", "taxon_concept_id", "observation_date"),
    "date": ("observation_date", "latitude", "longitude", "taxon_concept_id"),
    "taxon": ("taxon_concept_id", "observation_date", "latitude", "longitude"),
}


def chunked(df: DataFrame, path: str, rows: int = CHUNK_ROWS) -> None:
    df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)


def sort_columns(order: str) -> list:
    return [F.asc_nulls_last(c) for c in ORDERS[order]]


def sorted_bands(df: DataFrame, path: str) -> None:
    """One folder for each latitude band, rows in location order in it. Ranges are cut by the data, so dense bands get more tasks."""
    banded = df.withColumn("band", geo.band(F.col("latitude"))).where("band IS NOT NULL")
    out = banded.repartitionByRange("band", *ORDERS["location"][:2]).sortWithinPartitions("band", *sort_columns("location"))
    out.write.mode("overwrite").partitionBy("band").option("compression", "zstd").parquet(path)


def sorted_dates(df: DataFrame, path: str, parts: list[tuple[int, int, str]]) -> None:
    """One folder for each range of years, see planning.date_partitions; rows in date order in it. Rows without a date go."""
    year, label = F.substring("observation_date", 1, 4).try_cast("int"), F.lit(None).cast("string")
    for first, end, name in parts:
        label = F.when((year >= first) & (year < end), F.lit(name)).otherwise(label)
    _sorted_folders(df.withColumn("date_part", label).where("date_part IS NOT NULL"), path, "date_part", "date")


def sorted_taxa(df: DataFrame, path: str, width: int = 10) -> None:
    """One folder for each prefix of the taxon, with _ for -; rows in taxon order in it. Rows without a taxon go."""
    prefix = F.replace(F.substring("taxon_concept_id", 1, width), F.lit("-"), F.lit("_"))
    _sorted_folders(df.withColumn("taxon_part", prefix).where("taxon_part IS NOT NULL"), path, "taxon_part", "taxon")


def _sorted_folders(df: DataFrame, path: str, folder: str, order: str) -> None:
    out = df.repartitionByRange(folder, *ORDERS[order][:3]).sortWithinPartitions(folder, *sort_columns(order))
    out.write.mode("overwrite").partitionBy(folder).option("compression", "zstd").parquet(path)


def by_cell(df: DataFrame, path: str, cell: str = "boundary_cell", salt: int = 1) -> None:
    """One folder for each cell; salt is how many tasks share the rows of a cell."""
    dealt = df.repartition(F.col(cell), F.pmod(F.xxhash64(*df.columns), F.lit(salt))) if salt > 1 else df.repartition(F.col(cell))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(cell).parquet(path)


def document(value: dict, path: str) -> None:
    """A JSON document, whole or not at all."""
    with open(f"{path}.part", "w") as f:
        json.dump(value, f, indent=2, default=str)
    os.replace(f"{path}.part", path)


# The tables of a pack.
PACK_DDL = """
CREATE TABLE grid_species (h3_cell INTEGER NOT NULL, resolution INTEGER NOT NULL, avibase_id TEXT NOT NULL, confidence_tier TEXT NOT NULL, confidence_boost REAL NOT NULL, yearly_frequency REAL NOT NULL, quality_score REAL NOT NULL, PRIMARY KEY (h3_cell, resolution, avibase_id));
CREATE TABLE grid_species_monthly (h3_cell INTEGER NOT NULL, resolution INTEGER NOT NULL, avibase_id TEXT NOT NULL, month INTEGER NOT NULL, frequency REAL NOT NULL, checklist_count INTEGER NOT NULL, PRIMARY KEY (h3_cell, resolution, avibase_id, month));
CREATE TABLE species_lookup (avibase_id TEXT PRIMARY KEY, scientific_name TEXT NOT NULL, common_name TEXT);
CREATE TABLE pack_metadata (key TEXT PRIMARY KEY, value TEXT NOT NULL);
"""
PACK_INDEXES = """
CREATE INDEX idx_species_cell ON grid_species (h3_cell, resolution);
CREATE INDEX idx_species_taxon ON grid_species (avibase_id);
CREATE INDEX idx_monthly_cell ON grid_species_monthly (h3_cell, resolution, month);
CREATE INDEX idx_lookup_name ON species_lookup (scientific_name);
"""
_YEARLY = ("h3_cell", "resolution", "avibase_id", "confidence_tier", "confidence_boost", "yearly_frequency", "quality_score")
_MONTHLY = ("h3_cell", "resolution", "avibase_id", "month", "frequency", "checklist_count")


def pack_bytes(rows: pd.DataFrame, metadata: dict[str, str]) -> bytes:
    """One region's pack. rows: a row for each (cell, resolution, taxon), its months as a list of structs."""
    db = sqlite3.connect(":memory:")
    db.executescript(PACK_DDL)
    rows = rows.sort_values(["resolution", "h3_cell", "avibase_id"])
    fill = lambda n: ", ".join("?" * n)
    db.executemany(f"INSERT INTO grid_species VALUES ({fill(7)})", rows[list(_YEARLY)].astype(object).itertuples(index=False, name=None))
    months = ((r.h3_cell, r.resolution, r.avibase_id, m["month"], m["frequency"], m["checklist_count"]) for r in rows.itertuples() for m in r.months)
    db.executemany(f"INSERT INTO grid_species_monthly VALUES ({fill(6)})", ((int(a), int(b), c, int(d), float(e), int(f)) for a, b, c, d, e, f in months))
    names = rows.groupby("avibase_id")["scientific_name"].min()
    db.executemany("INSERT INTO species_lookup VALUES (?, ?, NULL)", names.items())
    facts = metadata | {"resolutions": ",".join(map(str, sorted(rows["resolution"].unique()))), "total_cells": str(rows[["resolution", "h3_cell"]].drop_duplicates().shape[0]), "total_species": str(len(names))}
    db.executemany("INSERT INTO pack_metadata VALUES (?, ?)", sorted(facts.items()))
    db.executescript(PACK_INDEXES)
    db.commit()
    db.execute("VACUUM")
    db.execute("ANALYZE")
    db.commit()
    out = db.serialize()
    db.close()
    return out


def packs(rows: DataFrame, version: str) -> DataFrame:
    """(region_id, content, size_bytes, gz, gz_bytes): each region's pack and its compressed form, made where its rows are.

    rows: region_id, the columns of grid_species, scientific_name, months array<struct<month, frequency, checklist_count>>.
    A region is planned to hold a bounded size, so it fits a task."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        region = frame["region_id"].iloc[0]
        data = pack_bytes(frame, {"region_id": region, "version": version})
        packed = gzip.compress(data, 6, mtime=0)
        return pd.DataFrame({"region_id": [region], "content": [data], "size_bytes": [len(data)], "gz": [packed], "gz_bytes": [len(packed)]})

    return rows.groupBy("region_id").applyInPandas(run, "region_id string, content binary, size_bytes long, gz binary, gz_bytes long")


def export(made: DataFrame, folder: str, column: str = "gz", suffix: str = ".db.gz") -> DataFrame:
    """Writes each pack to a file of a folder that all executors share, unless it is there; (region_id, path, written)."""

    def run(frames):
        os.makedirs(folder, exist_ok=True)
        for frame in frames:
            out = []
            for region, data in zip(frame["region_id"], frame[column], strict=True):
                path = os.path.join(folder, f"{region}{suffix}")
                new = not os.path.exists(path)
                if new:
                    with open(f"{path}.{os.getpid()}.part", "wb") as f:
                        f.write(data)
                    os.replace(f"{path}.{os.getpid()}.part", path)
                out.append((region, path, new))
            yield pd.DataFrame(out, columns=["region_id", "path", "written"])

    return made.select("region_id", column).mapInPandas(run, "region_id string, path string, written boolean")
