"""Queries on planning: regions, bundles, partitions, manifests."""

from pyspark.sql import Window, functions as F

from ..operators import lookups, ordering, planning as ops
from .frequencies import DENSITY, density, rounded
from .grid import continent_sql
from .registry import query
from .views import OBS, observations, table

MOST = 3.2
CELLS_SQL = f"""{DENSITY}, moved AS (SELECT cell, round(center_lat + (cell % 9 - 4) * 10, 4) AS center_lat, round(center_lon + (cell % 17 - 8) * 20, 4) AS center_lon, unique_checklists, estimated_pack_size_mb FROM density WHERE unique_checklists >= 100),
named AS (SELECT *, {continent_sql('center_lat', 'center_lon')} AS continent FROM moved),
ranked AS (SELECT *, row_number() OVER (PARTITION BY continent ORDER BY round_even(center_lat, 0), round_even(center_lon, 0), unique_checklists DESC, cell) AS place, sum(estimated_pack_size_mb) OVER (PARTITION BY continent) AS total FROM named),
filled(continent, cell, place, total, center_lat, center_lon, unique_checklists, estimated_pack_size_mb, chunk, held) AS (
  SELECT continent, cell, place, total, center_lat, center_lon, unique_checklists, estimated_pack_size_mb, 1, estimated_pack_size_mb FROM ranked WHERE place = 1
  UNION ALL
  SELECT r.continent, r.cell, r.place, r.total, r.center_lat, r.center_lon, r.unique_checklists, r.estimated_pack_size_mb,
    CASE WHEN f.held + r.estimated_pack_size_mb > {MOST}::DOUBLE THEN f.chunk + 1 ELSE f.chunk END, CASE WHEN f.held + r.estimated_pack_size_mb > {MOST}::DOUBLE THEN r.estimated_pack_size_mb ELSE f.held + r.estimated_pack_size_mb END
  FROM filled f JOIN ranked r ON r.continent = f.continent AND r.place = f.place + 1
),
planned AS (SELECT *, continent || '-' || printf('%03d', CASE WHEN total <= {MOST}::DOUBLE THEN 1 ELSE chunk END) AS region_id FROM filled)"""


def spread_cells(spark, sf_dir):
    """Density cells, moved apart so that they lie on all continents."""
    moved = density(spark, sf_dir).withColumns({
        "center_lat": F.round(F.col("center_lat") + (F.col("cell") % 9 - 4) * 10, 4),
        "center_lon": F.round(F.col("center_lon") + (F.col("cell") % 17 - 8) * 20, 4),
    })
    return moved.select("cell", "center_lat", "center_lon", "unique_checklists", "estimated_pack_size_mb")


def planned(spark, sf_dir):
    return ops.plan_regions(spread_cells(spark, sf_dir), MOST)


@query(f"WITH RECURSIVE {CELLS_SQL} SELECT cell, continent, region_id FROM planned")
def region_chunking(spark, sf_dir):
    return planned(spark, sf_dir).select("cell", "continent", "region_id")


@query(f"WITH RECURSIVE {CELLS_SQL} SELECT region_id, count(*) AS pack_count, round(sum(estimated_pack_size_mb), 6) AS size_mb, CAST(sum(unique_checklists) AS BIGINT) AS total_checklists, round(avg(center_lat), 6) AS center_lat, round(avg(center_lon), 6) AS center_lon, min(cell) AS first_cell FROM planned GROUP BY region_id")
def region_aggregates(spark, sf_dir):
    out = ops.regions(planned(spark, sf_dir))
    return out.select("region_id", "pack_count", *(F.round(c, 6).alias(c) for c in ("size_mb", "center_lat", "center_lon")), "total_checklists", F.element_at("cells", 1).alias("first_cell"))


@query(f"WITH RECURSIVE {CELLS_SQL} SELECT region_id, min(center_lat) AS south, max(center_lat) AS north, min(center_lon) AS west, max(center_lon) AS east FROM planned GROUP BY region_id")
def region_bbox(spark, sf_dir):
    return ops.bounding_boxes(planned(spark, sf_dir))


FILES = "files AS (SELECT 'region-' || CAST(o_custkey % 40 AS VARCHAR) AS region_id, CAST(sum(o_orderkey % 97 + 1) * 65536 AS BIGINT) AS size_bytes FROM orders GROUP BY 1)"


def files(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("region-"), (F.col("o_custkey") % 40).cast("string")).alias("region_id")).agg((F.sum(F.col("o_orderkey") % 97 + 1) * 65536).alias("size_bytes"))


@query(f"""WITH RECURSIVE {FILES}, ranked AS (SELECT *, row_number() OVER (ORDER BY size_bytes DESC, region_id) AS place FROM files),
packed(place, region_id, size_bytes, bundle_id, room) AS (
  SELECT place, region_id, size_bytes, 1, [{2400 << 20} - size_bytes] FROM ranked WHERE place = 1
  UNION ALL
  SELECT place, region_id, size_bytes, bundle_id, CASE WHEN bundle_id <= len(room) THEN list_transform(room, lambda x, i: CASE WHEN i = bundle_id THEN x - size_bytes ELSE x END) ELSE list_append(room, {2400 << 20} - size_bytes) END FROM (
    SELECT r.place, r.region_id, r.size_bytes, p.room, CAST(coalesce(list_position(list_transform(p.room, lambda x: x >= r.size_bytes), true), len(p.room) + 1) AS INTEGER) AS bundle_id
    FROM packed p JOIN ranked r ON r.place = p.place + 1)
)
SELECT region_id, size_bytes, CAST(bundle_id AS BIGINT) AS bundle_id, 'pack-bundle-' || printf('%03d', bundle_id) || '-2024.01' AS release_name FROM packed""")
def ffd_bundles(spark, sf_dir):
    return ops.bundles(files(spark, sf_dir), 2400, "2024.01")


@query(f"WITH {FILES} SELECT region_id, CAST((row_number() OVER (ORDER BY region_id) - 1) % 7 AS INTEGER) AS worker FROM files")
def round_robin(spark, sf_dir):
    place = F.row_number().over(Window.orderBy("region_id"))  # regions, not observations
    return files(spark, sf_dir).select("region_id", F.pmod(place - 1, F.lit(7)).alias("worker"))


MANIFEST = f"""{FILES}, packs AS (SELECT 'region-' || CAST(c_nationkey % 12 AS VARCHAR) AS region_id, list(DISTINCT c_nationkey) AS cells FROM customer GROUP BY 1),
shares AS (SELECT unnest(cells) AS cell, size_bytes / 1048576.0::DOUBLE / len(cells) AS size_mb, p.region_id AS source_region FROM packs p JOIN files f ON p.region_id = f.region_id)"""


def shares(spark, sf_dir):
    packs = table(spark, sf_dir, "customer").groupBy(F.concat(F.lit("region-"), (F.col("c_nationkey") % 12).cast("string")).alias("region_id")).agg(F.collect_set("c_nationkey").alias("cells"))
    return ops.size_manifest(packs, files(spark, sf_dir))


@query(f"WITH {MANIFEST} SELECT cell, round(size_mb, 6) AS size_mb, source_region FROM shares")
def size_manifest(spark, sf_dir):
    return rounded(shares(spark, sf_dir), "size_mb").withColumn("size_mb", F.round("size_mb", 6))


@query(f"WITH {MANIFEST} SELECT count(*) AS total_cells, round_even(sum(size_mb), 2) AS total_size_mb, round_even(sum(size_mb) / count(*), 4) AS average_size_mb, count(DISTINCT source_region) AS regions FROM shares")
def size_manifest_totals(spark, sf_dir):
    return ops.manifest_totals(shares(spark, sf_dir))


@query("SELECT CAST(substr(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 1, 3) || '0' AS INTEGER) AS decade, count(*) AS n FROM lineitem GROUP BY 1")
def decade_histogram(spark, sf_dir):
    text = F.date_format("l_shipdate", "yyyy-MM-dd")
    decade = F.concat(F.substring(text, 1, 3), F.lit("0")).cast("int")
    return table(spark, sf_dir, "lineitem").groupBy(decade.alias("decade")).agg(F.count(F.lit(1)).alias("n"))


YEARS = "years AS (SELECT CAST(year(l_shipdate) - 40 + (l_partkey % 5) * 12 AS INTEGER) AS year, count(*) AS n FROM lineitem GROUP BY 1)"


@query(f"""WITH {YEARS}, total AS (SELECT sum(n) AS total FROM years), decades AS (SELECT year // 10 * 10 AS decade, sum(n) AS n FROM years GROUP BY 1),
flagged AS (SELECT decade, n * 5 >= total AS big, sum(CASE WHEN n * 5 >= total THEN 1 ELSE 0 END) OVER (ORDER BY decade) AS island FROM decades, total)
SELECT CAST(year AS INTEGER) AS first_year, CAST(year + 1 AS INTEGER) AS end_year, 'year_' || CAST(year AS VARCHAR) AS label FROM years JOIN flagged ON year // 10 * 10 = decade WHERE big
UNION ALL SELECT CAST(min(decade) AS INTEGER), CAST(max(decade) + 10 AS INTEGER), CASE WHEN max(decade) + 10 <= 2100 THEN 'pre_' || CAST(max(decade) + 10 AS VARCHAR) ELSE 'decades_' || CAST(min(decade) AS VARCHAR) || '_' || CAST(max(decade) AS VARCHAR) END
FROM flagged WHERE NOT big GROUP BY island""")
def smart_date_partitions(spark, sf_dir):
    year = F.year("l_shipdate") - 40 + F.col("l_partkey").cast("int") % 5 * 12
    years = [tuple(r) for r in table(spark, sf_dir, "lineitem").groupBy(year.cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n")).collect()]  # one row a year
    most = -(-sum(n for _, n in years) // 5)
    return spark.createDataFrame(ops.date_partitions(years, most), "first_year int, end_year int, label string")


@query("SELECT DISTINCT replace(substr(o_orderpriority, 1, 10), '-', '_') AS prefix FROM orders ORDER BY prefix")
def taxon_prefixes(spark, sf_dir):
    prefix = F.replace(F.substring("o_orderpriority", 1, 10), F.lit("-"), F.lit("_"))
    return table(spark, sf_dir, "orders").select(prefix.alias("prefix")).distinct().orderBy("prefix")


@query(f"""WITH {OBS}, g AS (SELECT *, nullif(checklist % 5, 0) AS grp FROM obs)
SELECT checklist, line, row_number() OVER (PARTITION BY cell2 ORDER BY lat, lon, grp NULLS LAST, checklist, part, seen_at, line) AS place FROM g""")
def location_sort_rank(spark, sf_dir):
    rows = observations(spark, sf_dir).withColumn("grp", F.nullif(F.col("checklist") % 5, F.lit(0)))
    rows = rows.select("cell2", "lat", "lon", "grp", "checklist", "part", "seen_at", "line")
    order = [F.col("lat"), F.col("lon"), F.asc_nulls_last("grp"), F.col("checklist"), F.col("part"), F.col("seen_at"), F.col("line")]
    return ordering.placed(rows, "cell2", order).select("checklist", "line", "place")


@query(f"WITH {OBS}, c AS (SELECT cell5, count(*) AS n, count(DISTINCT checklist) AS checklists, count(DISTINCT part) AS taxa FROM obs GROUP BY cell5) SELECT cell5, n, checklists, taxa FROM c ORDER BY checklists DESC, cell5 LIMIT 5")
def top_cells(spark, sf_dir):
    cells = observations(spark, sf_dir).groupBy("cell5").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("checklist").alias("checklists"), F.countDistinct("part").alias("taxa"))
    return cells.orderBy(F.desc("checklists"), "cell5").limit(5)


@query("SELECT r.region_id, r.n, 'https://example.org/' || b.tag AS url FROM (SELECT 'region-' || CAST(c_nationkey AS VARCHAR) AS region_id, count(*) AS n FROM customer GROUP BY 1) r LEFT JOIN (SELECT 'region-' || CAST(n_nationkey AS VARCHAR) AS region_id, lower(n_name) AS tag FROM nation WHERE n_nationkey % 2 = 0) b ON r.region_id = b.region_id")
def registry_urls(spark, sf_dir):
    name = lambda c: F.concat(F.lit("region-"), F.col(c).cast("string")).alias("region_id")
    registry = table(spark, sf_dir, "customer").groupBy(name("c_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    tags = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(name("n_nationkey"), F.concat(F.lit("https://example.org/"), F.lower("n_name")).alias("url"))
    return registry.join(tags, "region_id", "left").select("region_id", "n", "url")


@query("SELECT a.n AS rows_a, b.n AS rows_b, a.n - b.n AS missing FROM (SELECT count(*) AS n FROM lineitem) a, (SELECT count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P') b")
def row_count_reconcile(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    a = lines.agg(F.count(F.lit(1)).alias("rows_a"))
    b = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).agg(F.count(F.lit(1)).alias("rows_b"))
    return a.join(b).select("rows_a", "rows_b", (F.col("rows_a") - F.col("rows_b")).alias("missing"))


@query("""WITH u AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events) SELECT event_id, user_id, event_type FROM u WHERE place = 1""")
def first_wins_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return lookups.first_wins(rows, ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("""WITH registry AS (SELECT 'region-' || CAST(c_custkey AS VARCHAR) AS region_id, 'bundle-' || CAST(c_nationkey AS VARCHAR) AS release_name, c_custkey AS place FROM customer),
asked AS (SELECT 'bundle-' || CAST(n_nationkey + 3 AS VARCHAR) AS release_name FROM nation)
SELECT a.release_name, (SELECT r.region_id FROM registry r WHERE r.release_name = a.release_name ORDER BY r.place LIMIT 1) AS region_id FROM asked a""")
def release_lookup(spark, sf_dir):
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    registry = table(spark, sf_dir, "customer").select(text("region-", F.col("c_custkey")).alias("region_id"), text("bundle-", F.col("c_nationkey")).alias("release_name"), F.col("c_custkey").alias("place"))
    asked = table(spark, sf_dir, "nation").select(text("bundle-", F.col("n_nationkey") + 3).alias("release_name"))
    return lookups.by_release(registry, asked)
