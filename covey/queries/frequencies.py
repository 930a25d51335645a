"""Queries on reporting frequencies and cells."""

from pyspark.sql import DataFrame, functions as F

from ..functions import scores
from ..operators import observations as ops
from .registry import query
from .views import OBS, observations, table

CELLS = {5: "cell5", 4: "cell4", 2: "cell2"}
MONTHLY = f"""{OBS},
once AS (SELECT DISTINCT cell4 AS cell, month, kind, checklist FROM obs),
totals AS (SELECT cell, month, count(DISTINCT checklist) AS cell_checklists FROM once GROUP BY cell, month),
seen AS (SELECT cell, month, kind, count(*) AS taxon_checklists FROM once GROUP BY cell, month, kind),
monthly AS (
  SELECT s.cell, s.month, s.kind, taxon_checklists, cell_checklists, CAST(taxon_checklists AS DOUBLE) / cell_checklists AS frequency
  FROM seen s JOIN totals t ON s.cell = t.cell AND s.month = t.month
)"""
#: Taxa of three ranks, so that all tiers come up.
RANKED = f"""{OBS},
levels AS (SELECT unnest([5, 4, 2]) AS resolution),
taxa AS (
  SELECT checklist, month, cell5, cell4, cell2, 'kind:' || kind AS taxon FROM obs
  UNION SELECT checklist, month, cell5, cell4, cell2, 'brand:' || brand FROM obs
  UNION SELECT checklist, month, cell5, cell4, cell2, 'part:' || CAST(part AS VARCHAR) FROM obs
),
once AS (SELECT DISTINCT resolution, CASE resolution WHEN 5 THEN cell5 WHEN 4 THEN cell4 ELSE cell2 END AS cell, month, taxon, checklist FROM taxa, levels),
totals AS (SELECT resolution, cell, month, count(DISTINCT checklist) AS cell_checklists FROM once GROUP BY resolution, cell, month),
seen AS (SELECT resolution, cell, month, taxon, count(*) AS taxon_checklists FROM once GROUP BY resolution, cell, month, taxon),
monthly AS (
  SELECT s.resolution, s.cell, s.month, taxon, taxon_checklists, cell_checklists, CAST(taxon_checklists AS DOUBLE) / cell_checklists AS frequency
  FROM seen s JOIN totals t ON s.resolution = t.resolution AND s.cell = t.cell AND s.month = t.month
),
yearly AS (
  SELECT resolution, cell, taxon, avg(frequency) AS yearly_frequency, CAST(sum(taxon_checklists) AS BIGINT) AS checklists, CAST(sum(cell_checklists) AS BIGINT) AS cell_checklists, count(*) AS months
  FROM monthly GROUP BY resolution, cell, taxon
)"""


def monthly(spark, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).withColumn("cell", F.col("cell4"))
    return ops.frequencies(obs, ["cell", "month"], ["kind"])


def ranked(spark, sf_dir: str, cells: dict[int, str] = CELLS, ranks: tuple[str, ...] = ("kind", "brand", "part")) -> DataFrame:
    """Monthly frequencies at the resolutions of cells and for taxa of ranks, whatever of them is asked for."""
    return ops.multi_frequencies(observations(spark, sf_dir), cells, ["month"], {r: r for r in ranks})


def yearly(spark, sf_dir: str, **which) -> DataFrame:
    return ops.yearly_mean(ranked(spark, sf_dir, **which), ["resolution", "cell", "taxon"])


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 9) for n in names})


@query(f"WITH {MONTHLY} SELECT cell, month, kind, taxon_checklists, cell_checklists, frequency FROM monthly")
def freq_monthly(spark, sf_dir):
    return monthly(spark, sf_dir)


@query(f"WITH {RANKED} SELECT resolution, cell, month, taxon, taxon_checklists, cell_checklists, frequency FROM monthly")
def freq_multires(spark, sf_dir):
    return ranked(spark, sf_dir)


@query(f"WITH {RANKED} SELECT resolution, cell, taxon, round(yearly_frequency, 9) AS yearly_frequency, checklists, cell_checklists, months, least(1.0, checklists / 100.0) AS quality_score FROM yearly")
def yearly_mean(spark, sf_dir):
    return rounded(yearly(spark, sf_dir), "yearly_frequency")


@query(f"""WITH {RANKED} SELECT resolution, cell, taxon, tier AS confidence_tier,
  (CASE tier WHEN 'common' THEN 1.5 WHEN 'uncommon' THEN 1.2 WHEN 'rare' THEN 1.0 ELSE 0.8 END)::DOUBLE * (CASE resolution WHEN 5 THEN 1.0 WHEN 4 THEN 0.8 WHEN 2 THEN 0.5 ELSE 1.0 END)::DOUBLE AS confidence_boost
  FROM (SELECT *, CASE WHEN yearly_frequency >= 0.1 THEN 'common' WHEN yearly_frequency >= 0.01 THEN 'uncommon' WHEN yearly_frequency >= 0.001 THEN 'rare' ELSE 'vagrant' END AS tier FROM yearly) AS t""")
def tier_boost(spark, sf_dir):
    return ops.profiled(yearly(spark, sf_dir)).select("resolution", "cell", "taxon", "confidence_tier", "confidence_boost")


@query(f"""WITH {RANKED} SELECT resolution, cell, taxon,
  CASE WHEN cell_checklists < 20 THEN 'vagrant' WHEN yearly_frequency >= 0.2 THEN 'common' WHEN yearly_frequency >= 0.05 THEN 'uncommon' WHEN yearly_frequency >= 0.01 THEN 'rare' ELSE 'vagrant' END AS confidence_tier FROM yearly""")
def tier_documented(spark, sf_dir):
    return ops.profiled(yearly(spark, sf_dir), scores.DOC).select("resolution", "cell", "taxon", "confidence_tier")


@query(f"""WITH {OBS}, once AS (SELECT DISTINCT cell4 AS cell, year, kind, checklist FROM obs),
totals AS (SELECT cell, year, count(DISTINCT checklist) AS n FROM once GROUP BY cell, year)
SELECT o.cell, o.year, kind, count(*) AS taxon_checklists, max(n) AS cell_checklists, CAST(count(*) AS DOUBLE) / max(n) AS frequency
FROM once o JOIN totals t ON o.cell = t.cell AND o.year = t.year GROUP BY o.cell, o.year, kind""")
def yearly_ratio(spark, sf_dir):
    obs = observations(spark, sf_dir).withColumn("cell", F.col("cell4"))
    return ops.frequencies(obs, ["cell", "year"], ["kind"])


@query(f"""WITH {OBS}, once AS (SELECT DISTINCT cell4 AS cell, year, quarter, kind, checklist FROM obs)
SELECT cell, year, quarter, kind, count(DISTINCT checklist) AS taxon_checklists FROM once GROUP BY GROUPING SETS ((cell, year, quarter, kind), (cell, year, kind), (cell, kind))""")
def freq_quarter_year(spark, sf_dir):
    once = observations(spark, sf_dir).select(F.col("cell4").alias("cell"), "year", "quarter", "kind", "checklist").distinct()
    sets = [["cell", "year", "quarter", "kind"], ["cell", "year", "kind"], ["cell", "kind"]]
    return once.groupingSets([[F.col(c) for c in s] for s in sets], "cell", "year", "quarter", "kind").agg(F.countDistinct("checklist").alias("taxon_checklists"))


@query(f"""WITH {MONTHLY} SELECT cell, kind, {", ".join(f"round(coalesce(max(CASE WHEN month = {m} THEN frequency END), 0), 9) AS m{m}" for m in range(1, 13))} FROM monthly GROUP BY cell, kind""")
def month_pivot(spark, sf_dir):
    out = ops.month_map(monthly(spark, sf_dir), ["cell", "kind"])
    return out.select("cell", "kind", *(F.round(F.element_at("monthly", m), 9).alias(f"m{m}") for m in range(1, 13)))


@query(f"""WITH {OBS} SELECT cell5, count(*) AS observation_count, count(DISTINCT checklist) AS checklist_count, count(DISTINCT part) AS species_count,
min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max FROM obs GROUP BY cell5""")
def cell_discovery(spark, sf_dir):
    return ops.discover_cells(observations(spark, sf_dir), "cell5", "checklist", "part")


DENSITY = f"""{OBS}, cells AS (SELECT cell5 AS cell, count(*) AS observations, count(DISTINCT checklist) AS checklists, count(DISTINCT part) AS species_count,
  (min(lat) + max(lat)) / 2 AS center_lat, (min(lon) + max(lon)) / 2 AS center_lon FROM obs GROUP BY cell5),
density AS (SELECT cell, center_lat, center_lon, checklists AS unique_checklists, checklists AS complete_checklists, observations AS total_observations, species_count,
  round_even(least(0.5::DOUBLE + checklists / 1000.0::DOUBLE * 0.05::DOUBLE, 200.0::DOUBLE), 3) AS estimated_pack_size_mb, 5 AS recommended_data_resolution FROM cells)"""


def density(spark, sf_dir):
    return ops.density(ops.discover_cells(observations(spark, sf_dir), "cell5", "checklist", "part"), "cell5", 4)


@query(f"WITH {DENSITY} SELECT * FROM density")
def density_report(spark, sf_dir):
    return density(spark, sf_dir)


@query(f"""WITH {DENSITY} SELECT count(*) AS total_cells, CAST(sum(unique_checklists) AS BIGINT) AS total_checklists, CAST(sum(total_observations) AS BIGINT) AS total_observations,
count(*) FILTER (unique_checklists >= 400) AS cells_from_400, count(*) FILTER (unique_checklists >= 600) AS cells_from_600, count(*) FILTER (unique_checklists >= 5000) AS cells_from_5000 FROM density""")
def coverage_thresholds(spark, sf_dir):
    return ops.density_totals(density(spark, sf_dir), (400, 600, 5000))


@query(f"WITH {DENSITY} SELECT CAST(floor(estimated_pack_size_mb * 1000 / 2) * 2 AS BIGINT) AS bucket, count(*) AS cells FROM density GROUP BY 1")
def size_histogram(spark, sf_dir):
    return density(spark, sf_dir).groupBy((F.floor(F.col("estimated_pack_size_mb") * 1000 / 2) * 2).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("cells"))


@query(f"""WITH {OBS} SELECT cell5, count(DISTINCT checklist) AS total_checklists, count(DISTINCT CASE WHEN flag <> 'N' THEN checklist END) AS complete_checklists,
count(*) AS observations, min(seen_at) AS first_seen, max(seen_at) AS last_seen,
CASE WHEN count(DISTINCT checklist) >= 500 THEN 'excellent' WHEN count(DISTINCT checklist) >= 100 THEN 'good' WHEN count(DISTINCT checklist) >= 20 THEN 'fair' ELSE 'sparse' END AS data_quality
FROM obs GROUP BY cell5""")
def cell_metadata(spark, sf_dir):
    return ops.cell_metadata(observations(spark, sf_dir), "cell5", "checklist", F.col("flag") != "N", "seen_at")


@query(f"""WITH {OBS}, cells AS (SELECT cell5, count(DISTINCT checklist) AS n, count(DISTINCT part) AS species FROM obs GROUP BY cell5)
SELECT CASE WHEN n >= 500 THEN 'excellent' WHEN n >= 100 THEN 'good' WHEN n >= 20 THEN 'fair' ELSE 'sparse' END AS data_quality, count(*) AS cells, round(avg(species), 9) AS mean_species FROM cells GROUP BY 1""")
def quality_histogram(spark, sf_dir):
    obs = observations(spark, sf_dir)
    meta = ops.cell_metadata(obs, "cell5", "checklist", F.lit(True), "seen_at").select("cell5", "data_quality")
    species = obs.groupBy("cell5").agg(F.countDistinct("part").alias("species"))
    return meta.join(species, "cell5").groupBy("data_quality").agg(F.count(F.lit(1)).alias("cells"), F.round(F.avg("species"), 9).alias("mean_species"))


@query(f"""WITH {OBS}, shared AS (SELECT cell4, kind, CASE WHEN checklist % 4 = 0 THEN 'G' || CAST(checklist // 8 AS VARCHAR) ELSE CAST(checklist AS VARCHAR) END AS key FROM obs)
SELECT cell4, kind, count(DISTINCT key) AS checklists FROM shared GROUP BY cell4, kind""")
def group_dedup(spark, sf_dir):
    group = F.when(F.col("checklist") % 4 == 0, F.concat(F.lit("G"), F.expr("checklist div 8").cast("string"))).otherwise("")
    obs = observations(spark, sf_dir).withColumn("group", group).withColumn("key", ops.checklist_key("checklist", "group"))
    return obs.groupBy("cell4", "kind").agg(F.countDistinct("key").alias("checklists"))


@query(f"""WITH {MONTHLY}, w AS (SELECT cell, kind, sum(taxon_checklists)::DOUBLE AS hits, sum(cell_checklists)::DOUBLE AS n FROM monthly GROUP BY cell, kind), p AS (SELECT *, hits / n AS p FROM w)
SELECT cell, kind, round(sqrt(p * (1 - p) / n), 9) AS standard_error,
round((p + 3.8416 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 9) AS lower_bound,
round((p + 3.8416 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 9) AS upper_bound FROM p""")
def wilson_ci(spark, sf_dir):
    sums = monthly(spark, sf_dir).groupBy("cell", "kind").agg(F.sum("taxon_checklists").alias("hits"), F.sum("cell_checklists").alias("n"))
    error, low, high = scores.wilson(F.col("hits"), F.col("n"))
    return rounded(sums.select("cell", "kind", error.alias("standard_error"), low.alias("lower_bound"), high.alias("upper_bound")), "standard_error", "lower_bound", "upper_bound")


@query(f"""WITH {MONTHLY}, y AS (SELECT cell, kind, avg(frequency) AS yearly FROM monthly GROUP BY cell, kind)
SELECT m.cell, m.month, m.kind, round(CASE WHEN frequency > yearly THEN 1 + (frequency - yearly) * 0.5 ELSE 1 END, 9) AS seasonal,
round(greatest(1, least(1.3, 1 + yearly * 0.3)), 9) AS linear FROM monthly m JOIN y ON m.cell = y.cell AND m.kind = y.kind""")
def seasonal_boost(spark, sf_dir):
    rows = monthly(spark, sf_dir)
    whole = rows.groupBy("cell", "kind").agg(F.avg("frequency").alias("yearly"))
    out = rows.join(whole, ["cell", "kind"]).select("cell", "month", "kind", scores.seasonal_boost(F.col("frequency"), F.col("yearly")).alias("seasonal"), scores.linear_boost(F.col("yearly")).alias("linear"))
    return rounded(out, "seasonal", "linear")


@query(f"""WITH {MONTHLY} SELECT count(*) AS n_rows, count(*) FILTER (NOT frequency BETWEEN 0 AND 1) AS bad_frequency, count(*) FILTER (NOT month BETWEEN 1 AND 12) AS bad_month,
count(*) FILTER (taxon_checklists > cell_checklists) AS bad_count FROM monthly""")
def pack_validation(spark, sf_dir):
    return ops.verify_pack(monthly(spark, sf_dir))


@query(f"""WITH {OBS}, f AS (SELECT cell4 AS cell, brand, count(*) AS observations, count(DISTINCT checklist) AS checklists FROM obs GROUP BY 1, 2)
SELECT * FROM f WHERE observations >= 90 AND checklists >= 80""")
def having_thresholds(spark, sf_dir):
    counted = observations(spark, sf_dir).groupBy(F.col("cell4").alias("cell"), "brand").agg(F.count(F.lit(1)).alias("observations"), F.countDistinct("checklist").alias("checklists"))
    return counted.where("observations >= 90 AND checklists >= 80")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_linestatus IS NOT NULL AND CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END = 1 AND nullif(l_partkey % 7, 0) IS NULL AND l_returnflag = 'N' AND CASE WHEN l_quantity > 40 THEN 'X' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END <> 'X'""")
def quality_chain(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.withColumns({
        "approved": F.lit(1),
        "complete": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        "exotic": F.nullif(F.col("l_partkey") % 7, F.lit(0)),
        "category": F.when(F.col("l_returnflag") == "N", "species").otherwise("hybrid"),
        "count": F.when(F.col("l_quantity") > 40, "X").otherwise(F.col("l_quantity").cast("int").cast("string")),
    })
    return ops.quality_filter(rows, "approved", "complete", "exotic", "category", "count").select("l_orderkey", "l_linenumber")


@query(f"""WITH {MONTHLY}, o AS (SELECT cell, month, kind, frequency FROM monthly WHERE month = 5 AND frequency >= 0.15)
SELECT cell, kind, round(frequency, 9) AS frequency FROM o""")
def species_list_month(spark, sf_dir):
    return ops.listed(monthly(spark, sf_dir), 5, 0.15).select("cell", "kind", F.round("frequency", 9).alias("frequency"))
