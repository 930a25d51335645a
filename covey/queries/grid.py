"""Queries on places: bands, boxes, hexagon bits, distances, continents."""

import re

from pyspark.sql import DataFrame, functions as F

from ..functions import geo, indexer
from ..operators import coverage
from .registry import query
from .views import OBS, observations, table

POINTS = f"{OBS}, points AS (SELECT DISTINCT checklist, part, lat, lon FROM obs)"
#: Cells at resolution 8 made from keys, with base cells 0 to 121, some of them pentagons.
HEX = """cells AS (SELECT DISTINCT o_orderkey AS k, CAST((1::BIGINT << 59) | (8::BIGINT << 52) | ((o_custkey % 122)::BIGINT << 45) | (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE (o_orderkey % 7)::BIGINT << 42 END)
  | ((o_orderkey % 5)::BIGINT << 39) | ((o_custkey % 7)::BIGINT << 36) | ((o_orderkey % 6)::BIGINT << 33) | ((o_orderkey % 4)::BIGINT << 30) | ((o_custkey % 3)::BIGINT << 27) | ((o_custkey % 2)::BIGINT << 24) | ((o_orderkey % 2)::BIGINT << 21) | 2097151 AS BIGINT) AS cell,
  o_custkey FROM orders)"""


def parent_sql(cell: str, resolution: int) -> str:
    return f"(({cell} & {~(15 << 52)}) | {resolution << 52} | {(1 << 3 * (15 - resolution)) - 1})"


def points(spark, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("checklist", "part", "lat", "lon").distinct()


def hexagons(spark, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    digits = [F.when(o % 3 == 0, F.lit(0)).otherwise(o % 7), o % 5, c % 7, o % 6, o % 4, c % 3, c % 2, o % 2]
    cell = F.lit((1 << 59) | (8 << 52) | ((1 << 21) - 1)).bitwiseOR(F.shiftleft((c % 122).cast("long"), 45))
    for k, digit in enumerate(digits):
        cell = cell.bitwiseOR(F.shiftleft(digit.cast("long"), 42 - 3 * k))
    return table(spark, sf_dir, "orders").select(o.alias("k"), cell.alias("cell"), c)


BAND_SQL = "CASE " + " ".join(f"WHEN lat >= {a} AND lat < {b} THEN 'lat_{'n' if a < 0 else 'p'}{abs(a):03d}_to_{'n' if b < 0 else 'p'}{abs(b):03d}'" for a, b in zip(geo.BANDS, geo.BANDS[1:])) + " END"


@query(f"WITH {POINTS} SELECT {BAND_SQL} AS band, count(*) AS n FROM points GROUP BY 1")
def lat_bands(spark, sf_dir):
    return points(spark, sf_dir).groupBy(geo.band(F.col("lat")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


# The rules by which a place's region is found, written out apart from the library's table of them.
CONTINENT_SQL = """CASE WHEN y > 60 AND x > -60 AND x < -10 THEN 'atlantic' WHEN y > 30 AND y < 45 AND x > -35 AND x < -15 THEN 'atlantic' WHEN y > 10 AND y < 35 AND x > -30 AND x < -10 THEN 'atlantic'
WHEN y > 45 AND x < -165 THEN 'pacific'
WHEN y > 25 AND x > -170 AND x < -50 THEN CASE WHEN y > 50 THEN 'na-north' WHEN x < -100 THEN 'na-west' ELSE 'na-east' END
WHEN y > 5 AND y <= 25 AND x > -120 AND x < -55 THEN 'central-america'
WHEN y > -60 AND x > -85 AND x < -30 THEN CASE WHEN y > 0 THEN 'sa-north' ELSE 'sa-south' END
WHEN y > -5 AND y < 5 AND x > -95 AND x < -85 THEN 'pacific'
WHEN y > 35 AND x > -15 AND x < 60 THEN 'europe' WHEN y > 10 AND y < 45 AND x > 30 AND x < 75 THEN 'middle-east'
WHEN y > -10 AND x > 60 AND x < 150 THEN CASE WHEN y <= 20 THEN 'se-asia' WHEN x > 100 THEN 'asia-east' ELSE 'asia-south' END
WHEN y > -40 AND y < 40 AND x > -20 AND x < 55 THEN 'africa' WHEN y < -10 AND x > 110 AND x < 180 THEN 'oceania'
WHEN x > 150 OR x < -100 THEN 'pacific' WHEN y > -40 AND y < 30 AND x > 40 AND x < 120 THEN 'indian' WHEN y < -40 THEN 'sub-antarctic' ELSE 'remote' END"""


def continent_sql(lat: str, lon: str) -> str:
    """CONTINENT_SQL of two columns that have other names."""
    return re.sub(r"\b[xy]\b", lambda m: lat if m.group() == "y" else lon, CONTINENT_SQL)


@query(f"WITH {POINTS} SELECT {continent_sql('lat', 'lon')} AS continent, count(*) AS n, round(min(lat), 2) AS south, round(max(lat), 2) AS north FROM points GROUP BY 1")
def continent_rules(spark, sf_dir):
    named = points(spark, sf_dir).withColumn("continent", geo.continent(F.col("lat"), F.col("lon")))
    return named.groupBy("continent").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("lat"), 2).alias("south"), F.round(F.max("lat"), 2).alias("north"))


@query(f"WITH {POINTS} SELECT checklist, part FROM points WHERE lat BETWEEN 20 AND 60 AND lon BETWEEN -30 AND 45.5")
def bbox_filter(spark, sf_dir):
    return points(spark, sf_dir).where(geo.in_box(F.col("lat"), F.col("lon"), 20, -30, 60, 45.5)).select("checklist", "part")


CORNERS = [(10.0, 10.0), (60.0, -40.0), (50.0, 70.0), (0.0, 40.0), (25.0, 30.0)]
_EDGES = list(zip(CORNERS, CORNERS[1:] + CORNERS[:1]))
POLYGON_SQL = " + ".join(f"CASE WHEN ({a[0]} > lat) <> ({b[0]} > lat) AND lon < (lat - {a[0]}) * CAST({(b[1] - a[1]) / (b[0] - a[0])!r} AS DOUBLE) + {a[1]} THEN 1 ELSE 0 END" for a, b in _EDGES)


@query(f"WITH {POINTS} SELECT checklist, part FROM points WHERE ({POLYGON_SQL}) % 2 = 1")
def polygon_filter(spark, sf_dir):
    return points(spark, sf_dir).where(geo.inside_polygon(F.col("lat"), F.col("lon"), CORNERS)).select("checklist", "part")


@query(f"WITH {POINTS} SELECT CAST(trunc(lat / 2.5) AS BIGINT) * 2.5::DOUBLE AS south, CAST(trunc(lon / 2.5) AS BIGINT) * 2.5::DOUBLE AS west, count(*) AS n FROM points GROUP BY 1, 2")
def latlon_grid(spark, sf_dir):
    south, west = geo.square_cell(F.col("lat"), F.col("lon"), 2.5)
    return points(spark, sf_dir).groupBy(south.alias("south"), west.alias("west")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {POINTS} SELECT checklist, part, round(2 * 6371.0 * asin(least(1.0, sqrt(power(sin(radians(51.5 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(51.5)) * power(sin(radians(-0.1 - lon) / 2), 2)))), 4) AS km
FROM points""")
def haversine(spark, sf_dir):
    km = geo.haversine(F.col("lat"), F.col("lon"), F.lit(51.5), F.lit(-0.1))
    return points(spark, sf_dir).select("checklist", "part", F.round(km, 4).alias("km"))


@query(f"""WITH {POINTS}, near AS (SELECT checklist, part, 2 * 6371.0 * asin(least(1.0, sqrt(power(sin(radians(51.5 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(51.5)) * power(sin(radians(-0.1 - lon) / 2), 2)))) AS km
FROM points WHERE lat BETWEEN 41.5 AND 61.5 AND lon BETWEEN -20.1 AND 19.9) SELECT checklist, part, round(km, 4) AS km FROM near WHERE km < 900 ORDER BY near.km, checklist, part LIMIT 50""")
def nearest_points(spark, sf_dir):
    boxed = points(spark, sf_dir).where(geo.in_box(F.col("lat"), F.col("lon"), 41.5, -20.1, 61.5, 19.9))
    km = geo.haversine(F.col("lat"), F.col("lon"), F.lit(51.5), F.lit(-0.1))
    near = boxed.withColumn("km", km).where("km < 900").orderBy("km", "checklist", "part").limit(50)
    return near.select("checklist", "part", F.round("km", 4).alias("km"))


@query(f"WITH {HEX} SELECT k, printf('%x', cell) AS hex, CAST((cell >> 52) & 15 AS INTEGER) AS resolution, {parent_sql('cell', 5)} AS parent5, {parent_sql('cell', 2)} AS parent2 FROM cells")
def hex_parent_bits(spark, sf_dir):
    c = F.col("cell")
    return hexagons(spark, sf_dir).select("k", geo.to_hex(c).alias("hex"), geo.resolution_of(c).alias("resolution"), geo.parent(c, 5).alias("parent5"), geo.parent(c, 2).alias("parent2"))


CHILDREN_SQL = f"""c AS (SELECT DISTINCT {parent_sql('cell', 3)} AS cell FROM cells),
d AS (SELECT unnest(range(0, 7)) AS digit),
one AS (SELECT c.cell, (c.cell & {~(15 << 52) & ~(7 << 33)}) | {4 << 52} | (digit << 33) AS child FROM c, d
  WHERE NOT (digit = 1 AND (c.cell >> 45) & 127 IN (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117) AND c.cell & {511 << 36} = 0)),
two AS (SELECT cell, (child & {~(15 << 52) & ~(7 << 30)}) | {5 << 52} | (digit << 30) AS child FROM one, d
  WHERE NOT (digit = 1 AND (child >> 45) & 127 IN (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117) AND child & {4095 << 33} = 0))"""


@query(f"WITH {HEX}, {CHILDREN_SQL} SELECT CAST(cell AS BIGINT) AS cell, CAST(child AS BIGINT) AS child FROM two")
def hex_children_bits(spark, sf_dir):
    coarse = hexagons(spark, sf_dir).select(geo.parent(F.col("cell"), 3).alias("cell")).distinct()
    return coarse.select("cell", F.explode(geo.children(F.col("cell"), 3, 5)).alias("child"))


PACKS_SQL = f"""{HEX}, packs AS (SELECT 'r' || CAST(o_custkey % 4 AS VARCHAR) AS region, CAST({parent_sql('cell', 4)} AS BIGINT) AS cell, CAST(sum(k % 50) AS BIGINT) AS checklists FROM cells GROUP BY 1, 2),
d AS (SELECT unnest(range(0, 7)) AS digit),
fine AS (SELECT region, cell, checklists, (cell & {~(15 << 52) & ~(7 << 30)}) | {5 << 52} | (digit << 30) AS child FROM packs, d
  WHERE NOT (digit = 1 AND (cell >> 45) & 127 IN (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117) AND cell & {4095 << 33} = 0)),
share AS (SELECT region, child, floor(CAST(checklists AS DOUBLE) / count(*) OVER (PARTITION BY region, cell) + 0.5) AS n FROM fine),
spread AS (
  SELECT region, 4 AS resolution, cell, checklists AS n FROM packs
  UNION ALL SELECT region, 2, {parent_sql('cell', 2)}, checklists FROM packs
  UNION ALL SELECT region, 5, child, n FROM share
)"""


def packs(spark, sf_dir: str) -> DataFrame:
    region = F.concat(F.lit("r"), (F.col("o_custkey") % 4).cast("string"))
    return hexagons(spark, sf_dir).groupBy(region.alias("region"), geo.parent(F.col("cell"), 4).alias("cell")).agg(F.sum(F.col("k") % 50).alias("checklists"))


@query(f"WITH {PACKS_SQL} SELECT region, resolution, CAST(cell AS BIGINT) AS cell, CAST(sum(n) AS BIGINT) AS checklists, count(*) AS packs FROM spread GROUP BY 1, 2, 3")
def hex_redistribute(spark, sf_dir):
    out = coverage.redistributed(packs(spark, sf_dir), 4, (2, 4, 5))
    return out.select("region", "resolution", "cell", "checklists", F.size("packs").cast("long").alias("packs"))


@query(f"WITH {PACKS_SQL}, merged AS (SELECT resolution, cell, sum(n) AS n FROM spread GROUP BY 1, 2) SELECT resolution, count(*) AS hexagons, CAST(sum(n) AS BIGINT) AS checklists, count(*) FILTER (n > 0) AS shown FROM merged GROUP BY 1")
def hex_merge_stats(spark, sf_dir):
    return coverage.merged_stats(coverage.redistributed(packs(spark, sf_dir), 4, (2, 4, 5)))


# Published cells of the hexagon index.
PLACES = [(37.775938728915946, -122.41795063018799, 9), (37.3615593, -122.0553238, 7), (40.689167, -74.044444, 10)]


@query("""SELECT * FROM (VALUES (9, '8928308280fffff', '85283083fffffff'), (7, '87283472bffffff', '85283473fffffff'), (10, '8a2a1072b59ffff', '852a1073fffffff')) AS t(resolution, cell, parent5)""")
def hex_published(spark, sf_dir):
    rows, index = spark.createDataFrame(PLACES, "lat double, lon double, resolution int"), indexer.HexagonIndex()
    cell = F.coalesce(*(F.when(F.col("resolution") == r, index.cell(F.col("lat"), F.col("lon"), r)) for r in (7, 9, 10)))
    return rows.select("resolution", geo.to_hex(cell).alias("cell"), geo.to_hex(geo.parent(cell, 5)).alias("parent5"))


@query("""SELECT unnest(['89283082803ffff', '89283082807ffff', '8928308280bffff', '8928308280fffff', '8928308283bffff', '89283082873ffff', '89283082877ffff']) AS cell""")
def hex_ring(spark, sf_dir):
    one = spark.createDataFrame([(0x8928308280FFFFF,)], "cell long")
    return one.select(F.explode(indexer.HexagonIndex().ring(F.col("cell"), 1)).alias("c")).select(geo.to_hex(F.col("c")).alias("cell"))


@query(f"""WITH {POINTS}, r AS (SELECT unnest([2, 4, 5]) AS resolution) SELECT resolution, count(*) AS places, count(*) AS in_their_cell, count(*) AS at_its_centre FROM points, r GROUP BY resolution""")
def hex_places(spark, sf_dir):
    """Every place's cell is of the resolution asked for, and is the cell of its own centre."""
    index, out = indexer.HexagonIndex(), None
    for r in (2, 4, 5):
        rows = points(spark, sf_dir).withColumn("cell", index.cell(F.col("lat"), F.col("lon"), r))
        lat, lon = index.centre(F.col("cell"), r)
        rows = rows.withColumns({"clat": lat, "clon": lon}).withColumn("again", index.cell(F.col("clat"), F.col("clon"), r))
        right = (geo.resolution_of(F.col("cell")) == r) & (F.shiftright("cell", 59) == 1)
        one = rows.agg(F.lit(r).alias("resolution"), F.count(F.lit(1)).alias("places"), F.count_if(right).alias("in_their_cell"), F.count_if(F.col("again") == F.col("cell")).alias("at_its_centre"))
        out = one if out is None else out.unionByName(one)
    return out
