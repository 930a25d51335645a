"""Reporting frequencies, cells and their statistics, from a table of observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scores


def located(df: DataFrame, *needed: str) -> DataFrame:
    """Rows that have all the needed columns."""
    return df.dropna(subset=list(needed))


def quality_filter(df: DataFrame, approved: str, complete: str, exotic: str, category: str, count: str | None = None) -> DataFrame:
    """Approved records of native species on complete checklists; with count, only those that were counted."""
    kept = df.where((F.col(approved) == 1) & (F.col(complete) == 1) & F.col(exotic).isNull() & (F.col(category) == "species"))
    return kept if count is None else kept.where(F.col(count) != "X")


def checklist_key(checklist: str, group: str) -> Column:
    """One key for all checklists that a group shares."""
    return F.coalesce(F.nullif(F.col(group), F.lit("")), F.col(checklist).cast("string"))


def effort(df: DataFrame, cell: list[str], checklist: str = "checklist") -> DataFrame:
    """Checklists by cell (and whatever else cell lists)."""
    return df.groupBy(*cell).agg(F.countDistinct(checklist).alias("cell_checklists"))


def frequencies(df: DataFrame, cell: list[str], taxon: list[str], checklist: str = "checklist") -> DataFrame:
    """Share of a cell's checklists that report a taxon. Rows with a null key are no observation of a cell and go."""
    return multi_frequencies(df, {None: cell[0]}, cell[1:], {None: taxon}, checklist).withColumnsRenamed({"cell": cell[0]}).drop("resolution")


def multi_frequencies(df: DataFrame, cells: dict, others: list[str], taxa: dict, checklist: str = "checklist") -> DataFrame:
    """Share of a cell's checklists that report a taxon, at each resolution of cells (resolution: column).

    taxa: the taxon's columns under the key None, or else names of ranks and the column of each, which make
    one column taxon, "rank:name". others: further keys of a cell, such as the month. Rows with a null key go.

    The rows are dealt out once, by checklist, before they are fanned out over ranks and resolutions; what
    is distinct in a checklist is then found where it lies, and counts are added up before they move. A row
    without a taxon stands for the checklist itself, so that the input is read once; a cell's total reaches
    its taxa by a window, which holds no more rows than there are taxa."""
    named = None not in taxa
    names = ["taxon"] if named else taxa[None]
    held = [*(taxa.values() if named else names), checklist]
    rows = df.select(*dict.fromkeys([*cells.values(), *others, *held])).dropna().repartition(F.col(checklist))
    if named:
        kinds = F.array(F.lit(None).cast("string"), *(F.concat(F.lit(f"{k}:"), F.col(c).cast("string")) for k, c in taxa.items()))
        rows = rows.select(*cells.values(), *others, checklist, F.explode(kinds).alias("taxon"), F.lit(True).alias("_one"))
        rows = rows.withColumn("_one", F.col("taxon").isNotNull())
    else:
        rows = rows.withColumn("_one", F.explode(F.array(F.lit(False), F.lit(True))))
        rows = rows.withColumns({c: F.when(F.col("_one"), F.col(c)) for c in names})
    if None not in cells:
        levels = F.array(*(F.struct(F.lit(r).alias("resolution"), F.col(c).cast("long").alias("cell")) for r, c in cells.items()))
        rows = rows.withColumn("_level", F.explode(levels)).select("_level.*", *others, *names, "_one", checklist)
    else:
        rows = rows.withColumnRenamed(cells[None], "cell").withColumn("resolution", F.lit(0))
    place = ["resolution", "cell", *others]
    once = rows.select(*place, *names, "_one", checklist).distinct()
    counted = once.groupBy(*place, *names, "_one").agg(F.count(F.lit(1)).alias("taxon_checklists"))
    total = F.max(F.when(~F.col("_one"), F.col("taxon_checklists"))).over(Window.partitionBy(*place))
    out = counted.withColumn("cell_checklists", total).where("_one").drop("_one")
    return out.withColumn("frequency", F.col("taxon_checklists") / F.col("cell_checklists"))


def yearly_mean(monthly: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """The mean of the months that have data, the taxon's checklists and its cell's in them, and the quality score of the taxon's."""
    out = monthly.groupBy(*keys).agg(F.avg("frequency").alias("yearly_frequency"), F.sum("taxon_checklists").alias("checklists"), F.sum("cell_checklists").alias("cell_checklists"), F.count(F.lit(1)).alias("months"), *more)
    return out.withColumn("quality_score", scores.quality(F.col("checklists")))


def profiled(yearly: DataFrame, profile: scores.TierProfile = scores.CODE) -> DataFrame:
    """Tiers and boosts; a profile that asks for checklists asks for the cell's, which tell how well it is known."""
    tier = scores.tier(F.col("yearly_frequency"), profile, F.col("cell_checklists"))
    return yearly.withColumn("confidence_tier", tier).withColumn("confidence_boost", scores.boost(F.col("confidence_tier"), F.col("resolution"), profile))


def month_map(monthly: DataFrame, keys: list[str]) -> DataFrame:
    """Months with data as a map, and all twelve as an array with 0 where there is none."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("month", "frequency"))))
    out = monthly.groupBy(*keys).agg(entries.alias("by_month"))
    return out.withColumn("monthly", F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.coalesce(F.try_element_at("by_month", m), F.lit(0.0))))


def listed(monthly: DataFrame, month: int, least: float) -> DataFrame:
    """What is to be expected in a month: taxa with at least that frequency. The month goes down to the scan."""
    return monthly.where((F.col("month") == month) & (F.col("frequency") >= least))


def discover_cells(df: DataFrame, cell: str, checklist: str, taxon: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Counts, distinct counts and bounds by cell.

    Checklists and taxa are counted apart, each from its own pairs with a cell; a checklist's records are
    summed up first, which takes the counts and bounds along."""
    rows = located(df, lat, lon, taxon)
    lists = rows.groupBy(cell, checklist).agg(F.count(F.lit(1)).alias("_n"), *(f(c).alias(f"_{c}_{n}") for c in (lat, lon) for n, f in (("min", F.min), ("max", F.max))))
    counted = lists.groupBy(cell).agg(
        F.sum("_n").alias("observation_count"),
        F.count(checklist).alias("checklist_count"),
        F.min(f"_{lat}_min").alias("lat_min"),
        F.max(f"_{lat}_max").alias("lat_max"),
        F.min(f"_{lon}_min").alias("lon_min"),
        F.max(f"_{lon}_max").alias("lon_max"),
    )
    taxa = rows.select(F.col(cell).alias("_cell"), taxon).distinct().groupBy("_cell").agg(F.count(F.lit(1)).alias("species_count"))
    joined = counted.join(taxa, F.col(cell).eqNullSafe(F.col("_cell")))
    return joined.select(cell, "observation_count", "checklist_count", "species_count", "lat_min", "lat_max", "lon_min", "lon_max")


def density(cells: DataFrame, cell: str, resolution: int) -> DataFrame:
    """The density report's rows of discovered cells; all checklists pass for complete ones."""
    return cells.select(
        F.col(cell).alias("cell"),
        ((F.col("lat_min") + F.col("lat_max")) / 2).alias("center_lat"),
        ((F.col("lon_min") + F.col("lon_max")) / 2).alias("center_lon"),
        F.col("checklist_count").alias("unique_checklists"),
        F.col("checklist_count").alias("complete_checklists"),
        F.col("observation_count").alias("total_observations"),
        "species_count",
        scores.pack_size_mb(F.col("checklist_count")).alias("estimated_pack_size_mb"),
        F.lit(resolution + 1).alias("recommended_data_resolution"),
    )


def density_totals(report: DataFrame, steps: tuple[int, ...] = (1_000, 10_000, 100_000)) -> DataFrame:
    """Totals of a density report and how many cells have so many checklists."""
    counts = [F.count_if(F.col("unique_checklists") >= s).alias(f"cells_from_{s}") for s in steps]
    return report.agg(F.count(F.lit(1)).alias("total_cells"), F.sum("unique_checklists").alias("total_checklists"), F.sum("total_observations").alias("total_observations"), *counts)


def cell_metadata(df: DataFrame, cell: str, checklist: str, complete: Column, date: str) -> DataFrame:
    """Checklists, complete ones, records and dates by cell, and a class of quality."""
    lists = df.groupBy(cell, checklist).agg(F.max(F.coalesce(complete, F.lit(False))).alias("_complete"), F.count(F.lit(1)).alias("_n"), F.min(date).alias("_first"), F.max(date).alias("_last"))
    out = lists.groupBy(cell).agg(
        F.count(checklist).alias("total_checklists"),
        F.count_if(F.col("_complete") & F.col(checklist).isNotNull()).alias("complete_checklists"),
        F.sum("_n").alias("observations"),
        F.min("_first").alias("first_seen"),
        F.max("_last").alias("last_seen"),
    )
    n = F.col("total_checklists")
    return out.withColumn("data_quality", F.when(n >= 500, "excellent").when(n >= 100, "good").when(n >= 20, "fair").otherwise("sparse"))


def verify_pack(rows: DataFrame) -> DataFrame:
    """Counts of rows that break what a pack promises."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("frequency").between(0, 1)).alias("bad_frequency"),
        F.count_if(~F.col("month").between(1, 12)).alias("bad_month"),
        F.count_if(F.col("taxon_checklists") > F.col("cell_checklists")).alias("bad_count"),
    )
