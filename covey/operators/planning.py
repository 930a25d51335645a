"""Sequential planning: regions of bounded size, bundles, date partitions, shares of work, region summaries.

What is sequential runs over one group's rows at a time, a continent's cells or a release's files: planning
objects, of which there are as many as places or files, never observations."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import geo


def fill(sizes: Iterable[float], most: float) -> list[int]:
    """The number, from 1, of the chunk each item goes to: items in order, a new chunk when one would overflow.

    An item that is larger than a chunk has one of its own."""
    out, chunk, held, empty = [], 1, 0.0, True
    for size in sizes:
        if held + size > most and not empty:
            chunk, held, empty = chunk + 1, 0.0, True
        held, empty = held + size, False
        out.append(chunk)
    return out


def first_fit(sizes: list[int], most: int) -> list[int]:
    """The number, from 1, of the first bundle with room for each item, in order; a new one where none has."""
    room: list[int] = []
    out = []
    for size in sizes:
        at = next((k for k, r in enumerate(room) if size <= r), None)
        if at is None:
            room.append(most)
            at = len(room) - 1
        room[at] -= size
        out.append(at + 1)
    return out


def plan_regions(cells: DataFrame, most_mb: float, least_checklists: int = 100) -> DataFrame:
    """cells (cell, center_lat, center_lon, unique_checklists, estimated_pack_size_mb) with continent and region_id.

    Cells with too few checklists go. A continent that fits is one region, else its cells are ordered by
    rounded coordinates (halves to even), then as the report has them, by checklists and cell, and filled in."""
    kept = cells.where(F.col("unique_checklists") >= least_checklists)
    kept = kept.withColumn("continent", geo.continent(F.col("center_lat"), F.col("center_lon")))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in kept.schema)}, region_id string"

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["unique_checklists", "cell"], ascending=[False, True], kind="stable")
        chunks = [1] * len(frame)
        if frame["estimated_pack_size_mb"].sum() > most_mb:
            order = frame.assign(_y=frame["center_lat"].round(0), _x=frame["center_lon"].round(0))
            frame = order.sort_values(["_y", "_x"], kind="stable").drop(columns=["_y", "_x"])
            chunks = fill(frame["estimated_pack_size_mb"], most_mb)
        return frame.assign(region_id=[f"{c}-{k:03d}" for c, k in zip(frame["continent"], chunks, strict=True)])

    return kept.groupBy("continent").applyInPandas(run, schema)


def regions(planned: DataFrame) -> DataFrame:
    """A manifest's row for each region: its cells, mean centre and totals."""
    return planned.groupBy("region_id").agg(
        F.array_sort(F.collect_list("cell")).alias("cells"),
        F.count(F.lit(1)).alias("pack_count"),
        F.sum("estimated_pack_size_mb").alias("size_mb"),
        F.sum("unique_checklists").alias("total_checklists"),
        F.avg("center_lat").alias("center_lat"),
        F.avg("center_lon").alias("center_lon"),
    )


def bounding_boxes(planned: DataFrame) -> DataFrame:
    """Bounds of each region's cell centres; zeros where it has none."""
    bounds = [("south", F.min("center_lat")), ("north", F.max("center_lat")), ("west", F.min("center_lon")), ("east", F.max("center_lon"))]
    return planned.groupBy("region_id").agg(*(F.coalesce(x, F.lit(0.0)).alias(n) for n, x in bounds))


def bundles(files: DataFrame, most_mb: int = 1950, version: str = "") -> DataFrame:
    """files (region_id, size_bytes) with bundle_id and release_name, largest first, ids in order among equals."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size_bytes", "region_id"], ascending=[False, True], kind="stable")
        at = first_fit(frame["size_bytes"].tolist(), most_mb * 1024 * 1024)
        return pd.DataFrame({"region_id": frame["region_id"], "size_bytes": frame["size_bytes"], "bundle_id": at, "release_name": [f"pack-bundle-{k:03d}-{version}" for k in at]})

    one = files.select("region_id", F.col("size_bytes").cast("long").alias("size_bytes")).withColumn("_all", F.lit(1))
    return one.groupBy("_all").applyInPandas(lambda frame: run(frame), "region_id string, size_bytes long, bundle_id long, release_name string")


def size_manifest(packs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each cell's even share of its region's file, regions without a file left out.

    packs: (region_id, cells array); sizes: (region_id, size_bytes)."""
    met = packs.join(sizes, "region_id").where(F.size("cells") > 0)
    share = F.col("size_bytes") / F.lit(1048576.0) / F.size("cells")
    return met.select(F.explode("cells").alias("cell"), share.alias("size_mb"), F.col("region_id").alias("source_region"))


def manifest_totals(shares: DataFrame) -> DataFrame:
    total = F.sum("size_mb")
    return shares.agg(
        F.count(F.lit(1)).alias("total_cells"),
        F.bround(total, 2).alias("total_size_mb"),
        F.bround(total / F.count(F.lit(1)), 4).alias("average_size_mb"),
        F.countDistinct("source_region").alias("regions"),
    )


def date_partitions(years: list[tuple[int, int]], most: int = 100_000_000) -> list[tuple[int, int, str]]:
    """(first year, year after the last, label) from (year, rows): large decades by year, runs of small ones as one."""
    decades: dict[int, int] = {}
    for year, n in years:
        decades[year // 10 * 10] = decades.get(year // 10 * 10, 0) + n
    out, run = [], []

    def flush() -> None:
        if run:
            end = run[-1] + 10
            out.append((run[0], end, f"pre_{end}" if end <= 2100 else f"decades_{run[0]}_{run[-1]}"))
            run.clear()

    for decade in sorted(decades):
        if decades[decade] < most:
            run.append(decade)
            continue
        flush()
        out += [(y, y + 1, f"year_{y}") for y, _ in sorted(years) if y // 10 * 10 == decade]
    flush()
    return out


def merge_greedily(cells: dict[str, float], adjacent: dict[str, set[str]], most: float, order: list[str] | None = None) -> list[list[str]]:
    """Groups of neighbouring cells of a total size up to most: each seed takes its nearest fitting neighbours, in order."""
    left, out = dict.fromkeys(order or sorted(cells, key=lambda c: (-cells[c], c))), []
    while left:
        seed = next(iter(left))
        del left[seed]
        group, size, edge = [seed], cells[seed], sorted(adjacent.get(seed, ()))
        while edge:
            cell = edge.pop(0)
            if cell in left and size + cells[cell] <= most:
                del left[cell]
                group.append(cell)
                size += cells[cell]
                edge += sorted(adjacent.get(cell, ()))
        out.append(group)
    return out


def merge_best_of(cells: dict[str, float], adjacent: dict[str, set[str]], most: float, tries: int, seed: int = 0) -> list[list[str]]:
    """The fewest groups that merge_greedily makes from random orders."""
    import random

    best = merge_greedily(cells, adjacent, most)
    for k in range(tries):
        order = sorted(cells)
        random.Random(f"{seed}:{k}").shuffle(order)
        made = merge_greedily(cells, adjacent, most, order)
        best = made if len(made) < len(best) else best
    return best


def least_groups(cells: dict[str, float], most: float) -> int:
    """A bound on how few groups there can be."""
    return -(-sum(cells.values()) // most).__int__() if cells else 0


def merged(cells: DataFrame, adjacent: DataFrame, most: float, tries: int = 0, seed: int = 0) -> DataFrame:
    """(part, cell, merged): the number, within its part, of the group that each cell is merged into, see merge_best_of.

    cells: (part, cell, size_mb); adjacent: (part, cell, other). Parts are planned apart, each by one task: a
    part is a continent's cells, which are few and don't grow with the observations."""

    def run(own: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if own.empty:
            return own[["part", "cell"]].assign(merged=0)
        sizes = dict(zip(own["cell"], own["size_mb"], strict=True))
        beside: dict[str, set[str]] = {}
        for a, b in zip(near["cell"], near["other"], strict=True):
            beside.setdefault(a, set()).add(b)
            beside.setdefault(b, set()).add(a)
        groups = merge_best_of(sizes, beside, most, tries, seed)
        rows = [(own["part"].iloc[0], cell, k) for k, group in enumerate(groups, 1) for cell in group]
        return pd.DataFrame(rows, columns=["part", "cell", "merged"])

    types = f"part {cells.schema['part'].dataType.simpleString()}, cell {cells.schema['cell'].dataType.simpleString()}, merged long"
    return cells.groupBy("part").cogroup(adjacent.groupBy("part")).applyInPandas(run, types)
