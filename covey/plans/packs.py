"""From an observation dump to lookup packs: the steps of a run, each through a table on disk."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import geo, indexer as cells, scores
from ..operators import observations as ops, planning
from ..sinks import files as sinks
from ..sources import adapters, files as sources
from . import state

RESOLUTIONS = (5, 4, 2)


def with_cells(obs: DataFrame, index, resolutions=RESOLUTIONS) -> DataFrame:
    """obs with cell<r> for each resolution; the boundary cell is that of the middle one."""
    return obs.withColumns({f"cell{r}": index.cell(F.col("latitude"), F.col("longitude"), r) for r in resolutions})


def grid_species(obs: DataFrame, regions: DataFrame, boundary: str, resolutions=RESOLUTIONS, profile: scores.TierProfile = scores.CODE) -> DataFrame:
    """A row for each (region, cell, resolution, taxon) of all regions in one plan, with its months as a list.

    regions: (boundary cell, region_id). A taxon with several names has the first by alphabet."""
    placed = ops.located(obs, "taxon_concept_id", "observation_date").join(regions, boundary)
    placed = placed.withColumn("month", F.substring("observation_date", 6, 2).try_cast("int"))
    names = placed.groupBy(F.col("taxon_concept_id").alias("avibase_id")).agg(F.min("scientific_name").alias("scientific_name"))
    cells = {r: f"cell{r}" for r in resolutions}
    monthly = ops.multi_frequencies(placed, cells, ["region_id", "month"], {None: ["taxon_concept_id"]}, "sampling_event_identifier")
    keys = ["region_id", "resolution", "cell", "taxon_concept_id"]
    months = F.array_sort(F.collect_list(F.struct("month", "frequency", F.col("taxon_checklists").alias("checklist_count"))))
    yearly = ops.profiled(ops.yearly_mean(monthly, keys, months.alias("by_month")), profile)
    out = yearly.drop("months").withColumnsRenamed({"by_month": "months", "cell": "h3_cell", "taxon_concept_id": "avibase_id"})
    return out.join(names, "avibase_id")


class PackRun:
    """A run in a folder that all executors share. dump: a tar, TSV or TSV.gz file."""

    def __init__(self, spark: SparkSession, dump: str, folder: str, version: str, most_mb: float = 80.0, least_checklists: int = 100, boundary: int = 4, header: bool = True, index=None):
        self.spark, self.dump, self.folder, self.version = spark, dump, folder, version
        self.most_mb, self.least, self.boundary, self.header = most_mb, least_checklists, boundary, header
        self.index = index or cells.indexer()
        os.makedirs(folder, exist_ok=True)
        self.run = state.Run(f"{folder}/state.json")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def convert(self):
        if self.dump.endswith((".tar", ".tgz", ".tar.gz")):
            adapters.register(self.spark)
            text = self.spark.read.format("observation_tar").options(path=self.dump, header=str(self.header).lower()).load()
            text = text.repartition(self.spark.sparkContext.defaultParallelism)
        else:
            text = sources.observation_text(self.spark, self.dump, self.header)
        sinks.chunked(sources.typed(text), self.path("observations"))
        return self.path("observations"), {"rows": self.read("observations").count()}

    def sort(self):
        sinks.sorted_bands(self.read("observations"), self.path("sorted"))
        return self.path("sorted"), {"rows": self.read("sorted").count()}

    def partition(self):
        obs = ops.located(with_cells(self.read("sorted"), self.index), "latitude", "longitude", "taxon_concept_id")
        sinks.by_cell(obs.withColumn("boundary_cell", F.col(f"cell{self.boundary}")), self.path("cells"))
        return self.path("cells"), {}

    def density(self):
        found = ops.discover_cells(self.read("cells"), "boundary_cell", "sampling_event_identifier", "taxon_concept_id", "latitude", "longitude")
        ops.density(found, "boundary_cell", self.boundary).write.mode("overwrite").parquet(self.path("density"))
        return self.path("density"), ops.density_totals(self.read("density")).first().asDict()

    def plan(self):
        planned = planning.plan_regions(self.read("density"), self.most_mb, self.least)
        planned.write.mode("overwrite").parquet(self.path("plan"))
        regions = planning.regions(self.read("plan")).join(planning.bounding_boxes(self.read("plan")), "region_id")
        listed = [r.asDict(recursive=True) for r in regions.orderBy("region_id").collect()]  # a registry is a document
        sinks.document({"version": self.version, "generated_at": state.now(), "total_regions": len(listed), "total_packs": sum(r["pack_count"] for r in listed), "regions": listed}, self.path("registry.json"))
        return self.path("plan"), {"regions": len(listed)}

    def build(self):
        regions = self.read("plan").select(F.col("cell").alias("boundary_cell"), "region_id")
        rows = grid_species(self.read("cells"), regions, "boundary_cell")
        sinks.packs(rows, self.version).write.mode("overwrite").parquet(self.path("packs"))
        written = sinks.export(self.read("packs"), self.path("release")).where("written").count()
        return self.path("release"), {"written": written}

    def size_manifest(self):
        """Each boundary cell's share of its region's pack, from what was built, as a document."""
        packs = self.read("plan").groupBy("region_id").agg(F.collect_list("cell").alias("cells"))
        shares = planning.size_manifest(packs, self.read("packs").select("region_id", "size_bytes"))
        totals = planning.manifest_totals(shares).first().asDict()
        listed = {geo.hex_text(r["cell"]): {"size_mb": r["size_mb"], "source_region": r["source_region"]} for r in shares.orderBy("cell").collect()}  # a row for each cell of the plan
        sinks.document({"version": self.version, "generated_at": state.now(), "boundary_resolution": self.boundary, **totals, "cells": listed}, self.path("size-manifest.json"))
        return self.path("size-manifest.json"), totals

    def verify(self):
        counts = {n: self.read(n).count() for n in ("observations", "sorted")}
        if len(set(counts.values())) > 1:
            raise ValueError(f"row counts differ: {counts}")
        return None, counts

    def go(self, first: str | None = None, force: bool = False) -> None:
        self.run.go({n: getattr(self, n) for n in state.STEPS}, first, force)

    def one(self, name: str) -> None:
        """Runs a step whatever its state."""
        single = state.Run(self.run.path, state.STEPS)
        single.names = (name,)
        single.go({name: getattr(self, name)}, force=True)
