"""Roll-up and roll-down of packs' checklists over levels of the hexagon grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import geo


def redistributed(packs: DataFrame, boundary: int, targets: tuple[int, ...]) -> DataFrame:
    """(region, resolution, cell, checklists, packs) at each target level of packs (region, cell, checklists).

    Coarser levels add up; on finer ones a cell's children get its checklists' equal share, rounded half up.
    packs: which cells' packs lie in or over the cell."""
    n, levels = F.col("checklists").cast("double"), []
    for target in sorted(targets):
        if target <= boundary:
            cells = F.array(geo.parent(F.col("cell"), target) if target < boundary else F.col("cell"))
            share = F.col("checklists").cast("long")
        else:
            cells = geo.children(F.col("cell"), boundary, target)
            share = geo.half_up(n / F.size(cells)).cast("long")
        levels.append(F.transform(cells, lambda c: F.struct(F.lit(target).alias("resolution"), c.alias("to"), share.alias("n"))))  # noqa: B023
    flat = packs.select("region", "cell", F.explode(F.concat(*levels)).alias("_x")).select("region", F.col("cell").alias("pack"), "_x.*")
    return flat.groupBy("region", "resolution", F.col("to").alias("cell")).agg(F.sum("n").alias("checklists"), F.array_sort(F.collect_list("pack")).alias("packs"))


def merged(layers: DataFrame) -> DataFrame:
    """All regions' layers as one."""
    return layers.groupBy("resolution", "cell").agg(F.sum("checklists").alias("checklists"))


def merged_stats(layers: DataFrame) -> DataFrame:
    """For each level its hexagons, their checklists, and how many are shown, those with checklists."""
    return merged(layers).groupBy("resolution").agg(F.count(F.lit(1)).alias("hexagons"), F.sum("checklists").alias("checklists"), F.count_if(F.col("checklists") > 0).alias("shown"))
