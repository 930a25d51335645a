"""Queries on filters and joins of the steps that prepare observations."""

from pyspark.sql import functions as F

from ..functions import geo, languages, scores, text
from ..operators import observations as ops, taxonomy
from .frequencies import DENSITY, MONTHLY, density, monthly
from .grid import POINTS, points
from .registry import query
from .views import OBS, observations, table


@query(f"WITH {OBS} SELECT checklist, line FROM obs WHERE lat >= -12.5 AND lat < 33.25 AND year BETWEEN 1996 AND 1998 AND substr(brand, 1, 7) = 'Brand#2'")
def range_filters(spark, sf_dir):
    lat = F.col("lat").cast("string").try_cast("double")  # as text, the way dumps have it
    rows = observations(spark, sf_dir).where((lat >= -12.5) & (lat < 33.25) & F.col("year").between(1996, 1998))
    return rows.where(F.substring("brand", 1, 7) == "Brand#2").select("checklist", "line")


@query(f"WITH {DENSITY} SELECT count(*) FILTER (unique_checklists >= 550) AS kept, count(*) FILTER (unique_checklists < 550) AS removed FROM density")
def min_checklists(spark, sf_dir):
    enough = F.col("unique_checklists") >= 550
    return density(spark, sf_dir).agg(F.count_if(enough).alias("kept"), F.count_if(~enough).alias("removed"))


@query("SELECT lang, count(*) AS n FROM documents WHERE lang IN ('de', 'en', 'es', 'fr') GROUP BY lang")  # of the languages asked for, those that the table has
def language_codes(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(languages.wanted(F.col("lang"))).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH names(code, name) AS (VALUES ('en', 'English'), ('de', 'German'), ('zh-hans', 'Chinese (Simplified)')), headers(name, code) AS (VALUES ('Thai', 'th'), ('Northern Sami', 'se'), ('French (Gaudin)', 'fr-Gaudin')),
asked AS (SELECT n_nationkey AS k, list_extract(['en', 'de', 'xx-q', 'zh-hans'], n_nationkey % 4 + 1) AS code, list_extract(['Thai', 'Northern Sami', 'Name', 'French (Gaudin)', 'thai'], n_nationkey % 5 + 1) AS header FROM nation)
SELECT k, coalesce(n.name, upper(a.code)) AS display_name, h.code AS header_code FROM asked a LEFT JOIN names n ON a.code = n.code LEFT JOIN headers h ON a.header = h.name""")
def language_names(spark, sf_dir):
    k = F.col("n_nationkey")
    code = F.element_at(F.array(*map(F.lit, ("en", "de", "xx-q", "zh-hans"))), k % 4 + 1)
    header = F.element_at(F.array(*map(F.lit, ("Thai", "Northern Sami", "Name", "French (Gaudin)", "thai"))), k % 5 + 1)
    return table(spark, sf_dir, "nation").select(k.alias("k"), languages.name_of(code).alias("display_name"), languages.code_of(header).alias("header_code"))


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_quantity > 49.5 AND l_partkey % 3 = 0)")
def missing_files(spark, sf_dir):
    present = table(spark, sf_dir, "lineitem").where("l_quantity > 49.5 AND l_partkey % 3 = 0").select(F.col("l_suppkey").alias("s_suppkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey").join(present, "s_suppkey", "left_anti")


@query(f"""WITH {MONTHLY}, t AS (SELECT cell, kind, month, CASE WHEN frequency >= 0.2 THEN 0 WHEN frequency >= 0.15 THEN 1 WHEN frequency >= 0.1 THEN 2 ELSE 3 END AS r FROM monthly)
SELECT a.cell, a.kind, CAST(abs(a.r - b.r) AS INTEGER) AS distance, abs(a.r - b.r) <= 1 AS close FROM t a JOIN t b ON a.cell = b.cell AND a.kind = b.kind WHERE a.month = 1 AND b.month = 7""")
def tier_distance(spark, sf_dir):
    profile = scores.TierProfile((("common", 0.2), ("uncommon", 0.15), ("rare", 0.1)), "vagrant", {})
    rank = F.array_position(F.array(*map(F.lit, scores.TIERS)), scores.tier(F.col("frequency"), profile)).cast("int")
    rows = monthly(spark, sf_dir).select("cell", "kind", "month", rank.alias("r"))
    later = rows.where("month = 7").select("cell", "kind", F.col("r").alias("r7"))
    out = rows.where("month = 1").join(later, ["cell", "kind"]).withColumn("distance", F.abs(F.col("r") - F.col("r7")))
    return out.select("cell", "kind", "distance", (F.col("distance") <= 1).alias("close"))


CENTRE_SQL = "CASE " + " ".join(
    f"WHEN lon BETWEEN {w} AND {e} AND lat BETWEEN {s} AND {n} THEN " + ("CASE " + " ".join(f"WHEN lon < {b} THEN '{name}-{p}'" if b is not None else f"ELSE '{name}-{p}'" for p, b in geo.PARTS[name]) + " END" if name in geo.PARTS else f"'{name}-main'")
    for name, w, e, s, n in geo.CENTRES
) + " ELSE 'unknown-main' END"


@query(f"WITH {POINTS} SELECT {CENTRE_SQL} AS name, count(*) AS n FROM points GROUP BY 1")
def region_names(spark, sf_dir):
    return points(spark, sf_dir).groupBy(geo.centre_name(F.col("lat"), F.col("lon")).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderstatus = 'F' AS complete, count(*) AS records, count(DISTINCT l_orderkey) AS checklists FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def sampling_events(spark, sf_dir):
    events = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderstatus") == "F").alias("complete"))
    joined = table(spark, sf_dir, "lineitem").join(events, "l_orderkey")
    return joined.groupBy("complete").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("l_orderkey").alias("checklists"))


@query("SELECT p_partkey AS taxon, p_name AS name FROM part WHERE lower(CASE WHEN p_size % 2 = 0 THEN 'Species' ELSE 'genus' END) = 'species' AND nullif(p_partkey % 11, 0) IS NOT NULL")
def rank_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("taxon"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 2 == 0, "Species").otherwise("genus").alias("rank"), F.nullif(F.col("p_partkey") % 11, F.lit(0)).alias("id"))
    return taxonomy.species_rank(rows, "rank", "id", ["taxon", "name", "no_such_column"])


@query("""SELECT o_orderkey, CAST(epoch(o_orderdate + INTERVAL 90 SECOND) - epoch(o_orderdate) AS BIGINT) AS seconds, 'n' || lower(o_orderpriority) AS slug FROM orders""")
def step_durations(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate").cast("timestamp_ntz")
    took = F.timestamp_diff("SECOND", start, F.timestamp_add("SECOND", F.lit(90), start))
    return rows.select("o_orderkey", took.alias("seconds"), F.concat(F.lit("n"), text.key(F.col("o_orderpriority"))).alias("slug"))


@query(f"WITH {OBS} SELECT cell4, count(*) AS observation_count, count(DISTINCT checklist) AS checklist_count FROM obs WHERE nullif(part % 13, 0) IS NOT NULL GROUP BY cell4 ORDER BY checklist_count DESC, cell4 LIMIT 5")
def discovered_top(spark, sf_dir):
    obs = observations(spark, sf_dir).withColumn("taxon", F.nullif(F.col("part") % 13, F.lit(0)))
    found = ops.discover_cells(obs, "cell4", "checklist", "taxon")
    return found.select("cell4", "observation_count", "checklist_count").orderBy(F.desc("checklist_count"), "cell4").limit(5)
