"""Queries that look rows up: fallback, neighbours, regions, names, modes and rules."""

from pyspark.sql import functions as F

from ..functions import scores
from ..operators import lookups as ops
from .frequencies import MONTHLY, RANKED, monthly, yearly
from .registry import query
from .views import OBS, observations as obs_table, table

PROBES = "probes AS (SELECT (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey % 10000 AS probe, l_suppkey AS c5, CAST(s_nationkey AS BIGINT) AS c4, CAST(n_regionkey AS BIGINT) AS c2, 'part:' || CAST(l_partkey % 400 AS VARCHAR) AS taxon FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"


def probes(spark, sf_dir):
    lines, suppliers, nations = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    rows = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    # An order has some line numbers twice: the part and the supplier tell such lines apart.
    probe = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey") % 10_000
    return rows.select(probe.alias("probe"), F.col("l_suppkey").alias("c5"), F.col("s_nationkey").cast("long").alias("c4"), F.col("n_regionkey").cast("long").alias("c2"), F.concat(F.lit("part:"), (F.col("l_partkey") % 400).cast("string")).alias("taxon"))


@query(f"""WITH {RANKED}, {PROBES}, tried AS (
  SELECT probe, p.taxon, 0 AS rank, 4 AS resolution, c4 AS cell FROM probes p UNION ALL SELECT probe, p.taxon, 1, 2, c2 FROM probes p),
hits AS (SELECT probe, t.resolution, t.cell, yearly_frequency, row_number() OVER (PARTITION BY probe ORDER BY rank) AS place FROM tried t JOIN yearly y ON t.resolution = y.resolution AND t.cell = y.cell AND t.taxon = y.taxon)
SELECT p.probe, p.taxon, h.resolution, h.cell, round(h.yearly_frequency, 9) AS yearly_frequency FROM probes p LEFT JOIN hits h ON p.probe = h.probe AND place = 1""")
def lookup_fallback(spark, sf_dir):
    rows = yearly(spark, sf_dir, cells={4: "cell4", 2: "cell2"}, ranks=("part",)).select("resolution", "cell", "taxon", "yearly_frequency")
    out = ops.with_fallback(probes(spark, sf_dir), rows, [(4, "c4"), (2, "c2")], ["taxon"], "probe")
    return out.select("probe", "taxon", "resolution", "cell", F.round("yearly_frequency", 9).alias("yearly_frequency"))


@query(f"""WITH {RANKED}, {PROBES}, tried AS (
  SELECT probe, p.taxon, 0 AS rank, 5 AS resolution, c5 AS cell FROM probes p UNION ALL SELECT probe, p.taxon, 1, 4, c4 FROM probes p UNION ALL SELECT probe, p.taxon, 2, 2, c2 FROM probes p),
hits AS (SELECT probe, t.resolution, t.cell, cell_checklists, row_number() OVER (PARTITION BY probe ORDER BY rank) AS place FROM tried t JOIN yearly y ON t.resolution = y.resolution AND t.cell = y.cell AND t.taxon = y.taxon WHERE cell_checklists >= 200)
SELECT p.probe, h.resolution, h.cell, h.cell_checklists FROM probes p LEFT JOIN hits h ON p.probe = h.probe AND place = 1""")
def sparse_fallback(spark, sf_dir):
    rows = yearly(spark, sf_dir, ranks=("part",)).select("resolution", "cell", "taxon", "cell_checklists")
    out = ops.with_fallback(probes(spark, sf_dir), rows, [(5, "c5"), (4, "c4"), (2, "c2")], ["taxon"], "probe", F.col("cell_checklists") >= 200)
    return out.select("probe", "resolution", "cell", "cell_checklists")


@query(f"WITH {RANKED}, {PROBES} SELECT probe FROM probes p WHERE EXISTS (SELECT 1 FROM yearly y WHERE y.resolution = 4 AND y.cell = p.c4 AND y.taxon = p.taxon)")
def pack_probe(spark, sf_dir):
    rows = yearly(spark, sf_dir, cells={4: "cell4"}, ranks=("part",)).select(F.col("cell").alias("c4"), "taxon")
    return ops.existing(probes(spark, sf_dir), rows, ["c4", "taxon"]).select("probe")


@query(f"""WITH {PROBES}, regions AS (SELECT 'region-' || CAST(n_regionkey AS VARCHAR) AS region, list(CAST(n_nationkey AS BIGINT)) AS cells FROM nation GROUP BY 1),
flat AS (SELECT region, unnest(cells) AS cell FROM regions) SELECT probe, region FROM probes JOIN flat ON c4 = cell""")
def region_lookup(spark, sf_dir):
    regions = table(spark, sf_dir, "nation").groupBy(F.concat(F.lit("region-"), F.col("n_regionkey").cast("string")).alias("region")).agg(F.collect_list(F.col("n_nationkey").cast("long")).alias("cells"))
    flat = regions.select("region", F.explode("cells").alias("c4"))
    return probes(spark, sf_dir).join(flat, "c4").select("probe", "region")


@query(f"""WITH {MONTHLY}, names AS (SELECT DISTINCT p_type AS kind, 'id-' || upper(substr(md5(p_type), 1, 8)) AS taxon FROM part), packs AS (SELECT cell, taxon, month, frequency FROM monthly JOIN names USING (kind)),
asked AS (SELECT DISTINCT p_type AS label, CAST(n_nationkey AS BIGINT) AS cell FROM part, nation WHERE n_nationkey < 5)
SELECT a.label, a.cell, p.month, round(p.frequency, 9) AS frequency FROM asked a JOIN names n ON a.label = n.kind JOIN packs p ON p.taxon = n.taxon AND p.cell = a.cell""")
def cross_taxonomy_lookup(spark, sf_dir):
    taxon = F.concat(F.lit("id-"), F.upper(F.substring(F.md5(F.col("kind").cast("binary")), 1, 8)))
    names = table(spark, sf_dir, "part").select(F.col("p_type").alias("kind")).distinct().withColumn("taxon", taxon)
    packs = monthly(spark, sf_dir).join(names, "kind").select("cell", "taxon", "month", "frequency")
    cells = F.explode(F.expr("sequence(0L, 4L)"))
    asked = names.select(F.col("kind").alias("label"), "taxon", cells.alias("cell"))
    return asked.join(packs, ["taxon", "cell"]).select("label", "cell", "month", F.round("frequency", 9).alias("frequency"))


@query(f"""WITH {MONTHLY}, pairs AS (SELECT CAST(a.n_nationkey AS BIGINT) AS cell, CAST(b.n_nationkey AS BIGINT) AS neighbour, CAST(abs(a.n_nationkey - b.n_nationkey) AS DOUBLE) AS distance FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey)
SELECT p.cell, m.kind, round(sum(frequency / (1 + distance)) / sum(1 / (1 + distance)), 9) AS weighted_frequency, count(*) AS neighbours,
min(CASE WHEN frequency >= 0.1 THEN 0 WHEN frequency >= 0.01 THEN 1 WHEN frequency >= 0.001 THEN 2 ELSE 3 END) AS best_rank
FROM pairs p JOIN monthly m ON m.cell = p.neighbour AND m.month = 6 GROUP BY 1, 2""")
def idw_neighbours(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), "n_regionkey")
    pairs = nations.alias("a").join(nations.alias("b"), F.col("a.n_regionkey") == F.col("b.n_regionkey"))
    pairs = pairs.select(F.col("a.k").alias("cell"), F.col("b.k").alias("neighbour"), F.abs(F.col("a.k") - F.col("b.k")).cast("double").alias("distance"))
    rank = F.array_position(F.array(*map(F.lit, scores.TIERS)), scores.tier(F.col("frequency"))).cast("int") - 1
    rows = monthly(spark, sf_dir).where("month = 6").select("cell", "kind", "frequency", rank.alias("tier_rank"))
    out = ops.weighted_neighbours(rows, pairs, ["kind"])
    return out.withColumn("weighted_frequency", F.round("weighted_frequency", 9))


@query(f"WITH {MONTHLY} SELECT kind, round(avg(frequency), 9) AS mean_frequency FROM monthly WHERE cell IN (1, 5, 9, 14) GROUP BY kind")
def neighbour_mean(spark, sf_dir):
    return monthly(spark, sf_dir).where(F.col("cell").isin(1, 5, 9, 14)).groupBy("kind").agg(F.round(F.avg("frequency"), 9).alias("mean_frequency"))


@query(f"""WITH {MONTHLY}, tiers AS (SELECT cell, kind, avg(frequency) AS f FROM monthly WHERE kind < 'P' GROUP BY 1, 2),
known AS (SELECT cell, kind, CASE WHEN f >= 0.17 THEN 'common' WHEN f >= 0.165 THEN 'uncommon' WHEN f >= 0.16 THEN 'rare' ELSE 'vagrant' END AS tier FROM tiers),
d AS (SELECT event_id, CAST(user_id % 25 AS BIGINT) AS cell, p_type AS kind, value - floor(value) AS confidence FROM events JOIN part ON event_id % (SELECT count(*) FROM part) + (SELECT min(p_partkey) FROM part) = p_partkey),
j AS (SELECT event_id, confidence, tier FROM d LEFT JOIN known k ON d.cell = k.cell AND d.kind = k.kind),
a AS (SELECT event_id, coalesce(tier, 'unknown') AS tier, CASE WHEN tier = 'common' THEN least(1.0, confidence * 1.5) WHEN tier = 'uncommon' THEN least(1.0, confidence * 1.2) WHEN tier = 'rare' THEN confidence
  WHEN tier = 'vagrant' AND confidence >= 0.95 THEN confidence * 0.9 WHEN tier IS NULL AND confidence >= 0.95 THEN confidence END AS adjusted FROM j)
SELECT event_id, tier, round(adjusted, 9) AS adjusted FROM a WHERE adjusted IS NOT NULL""")
def detection_adjust(spark, sf_dir):
    profile = scores.TierProfile((("common", 0.17), ("uncommon", 0.165), ("rare", 0.16)), "vagrant", scores.CODE.boosts)
    known = monthly(spark, sf_dir).where("kind < 'P'").groupBy("cell", "kind").agg(F.avg("frequency").alias("f"))
    known = known.select("cell", "kind", scores.tier(F.col("f"), profile).alias("tier"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("kind"))
    keys = part.agg(F.count(F.lit(1)).alias("_n"), F.min("p_partkey").alias("_first"))
    events = table(spark, sf_dir, "events").crossJoin(F.broadcast(keys))  # one row
    seen = events.join(part, F.col("event_id") % F.col("_n") + F.col("_first") == F.col("p_partkey"))
    seen = seen.select("event_id", (F.col("user_id") % 25).alias("cell"), "kind", (F.col("value") - F.floor("value")).alias("confidence"))
    out = seen.join(known, ["cell", "kind"], "left")
    value = scores.adjusted(F.col("confidence"), scores.boost(F.col("tier"), F.lit(5), profile), F.col("tier"))
    return out.select("event_id", F.coalesce("tier", F.lit("unknown")).alias("tier"), F.round(value, 9).alias("adjusted")).where("adjusted IS NOT NULL")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS id, lower(trim(p_brand)) AS key, last_value FROM part JOIN (
  SELECT lower(trim(p_brand)) AS k, arg_max(p_name, p_partkey) AS last_value FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1) m ON lower(trim(p_brand)) = k WHERE p_size < 20""")
def name_lookup_last_wins(spark, sf_dir):
    part, key = table(spark, sf_dir, "part"), F.lower(F.trim("p_brand"))
    mapping = ops.last_wins(part.where("p_partkey % 3 <> 0").withColumn("last_value", F.col("p_name")), key, "p_partkey", "last_value")
    return part.where("p_size < 20").withColumn("key", key).join(mapping, "key").select(F.col("p_partkey").cast("string").alias("id"), "key", "last_value")


@query("""SELECT s_suppkey, s_name, url FROM supplier LEFT JOIN (SELECT CAST(c_custkey AS BIGINT) AS k, 'https://' || lower(c_mktsegment) AS url FROM customer WHERE c_custkey % 2 = 0 AND nullif(trim(c_mktsegment), 'BUILDING') IS NOT NULL) ON s_suppkey = k""")
def optional_attribute(spark, sf_dir):
    urls = table(spark, sf_dir, "customer").where((F.col("c_custkey") % 2 == 0) & F.nullif(F.trim("c_mktsegment"), F.lit("BUILDING")).isNotNull())
    urls = urls.select(F.col("c_custkey").alias("s_suppkey"), F.concat(F.lit("https://"), F.lower("c_mktsegment")).alias("url"))
    return table(spark, sf_dir, "supplier").join(urls, "s_suppkey", "left").select("s_suppkey", "s_name", "url")


@query("""WITH u AS (SELECT c_custkey AS taxon, c_mktsegment AS name, 0 AS priority FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, c_name, 1 FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'en ' || c_name, 2 FROM customer)
SELECT taxon, arg_min(name, priority) AS name, min(priority) AS priority FROM u GROUP BY taxon""")
def translation_priority(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("taxon", F.col("c_custkey"))
    parts = [c.where("c_custkey % 3 = 0").withColumn("name", F.col("c_mktsegment")), c.where("c_custkey % 2 = 0").withColumn("name", F.col("c_name")), c.withColumn("name", F.concat(F.lit("en "), "c_name"))]
    return ops.by_priority(parts, ["taxon"], "name")


MODES = {"supplement": "UNION", "replace": None, "strict": "INTERSECT"}


@query("""WITH a AS (SELECT DISTINCT l_partkey AS part FROM lineitem WHERE l_quantity > 45), b AS (SELECT DISTINCT p_partkey AS part FROM part WHERE p_size < 15)
SELECT 'supplement' AS mode, part FROM (SELECT part FROM a UNION SELECT part FROM b) UNION ALL SELECT 'replace', part FROM b UNION ALL SELECT 'strict', part FROM (SELECT part FROM a INTERSECT SELECT part FROM b)""")
def filter_modes(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("part"))
    b = table(spark, sf_dir, "part").where("p_size < 15").select(F.col("p_partkey").alias("part"))
    out = None
    for mode in MODES:
        one = ops.filter_mode(a, b, "part", mode).select(F.lit(mode).alias("mode"), "part")
        out = one if out is None else out.unionByName(one)
    return out


@query("""WITH inc(p_brand, p_type) AS (VALUES ('Brand#12', NULL), (NULL, 'STANDARD'), ('Brand#33', 'PROMO')), exc(p_brand, p_type) AS (VALUES ('Brand#21', NULL), ('Brand#12', 'ECONOMY'))
SELECT p_partkey FROM part p WHERE EXISTS (SELECT 1 FROM inc r WHERE (r.p_brand IS NULL OR r.p_brand = p.p_brand) AND (r.p_type IS NULL OR r.p_type = p.p_type))
AND NOT EXISTS (SELECT 1 FROM exc r WHERE (r.p_brand IS NULL OR r.p_brand = p.p_brand) AND (r.p_type IS NULL OR r.p_type = p.p_type))""")
def taxon_rules(spark, sf_dir):
    rules = "p_brand string, p_type string"
    include = spark.createDataFrame([("Brand#12", None), (None, "STANDARD"), ("Brand#33", "PROMO")], rules)
    exclude = spark.createDataFrame([("Brand#21", None), ("Brand#12", "ECONOMY")], rules)
    return ops.by_rules(table(spark, sf_dir, "part"), include, exclude, ["p_brand", "p_type"]).select("p_partkey")


@query(f"""WITH {OBS}, f AS (SELECT brand, count(DISTINCT checklist) AS n FROM obs WHERE starts_with(brand, 'Brand#1') GROUP BY brand) SELECT brand, n FROM f ORDER BY n DESC, brand""")
def prefix_like(spark, sf_dir):
    rows = obs_table(spark, sf_dir).where(F.col("brand").startswith("Brand#1"))
    return rows.groupBy("brand").agg(F.countDistinct("checklist").alias("n")).orderBy(F.desc("n"), "brand")


