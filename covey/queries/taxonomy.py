"""Queries on taxonomies and their tables."""

from pyspark.sql import functions as F

from ..operators import taxonomy as ops
from .registry import query
from .views import table


@query("""WITH RECURSIVE raw AS (SELECT CAST(p_partkey AS INTEGER) AS k, 'a' || CAST(p_partkey % 40 AS VARCHAR) AS a, 'b' || CAST(p_size % 37 AS VARCHAR) AS b, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'c' || CAST(p_partkey * 7 % 60 AS VARCHAR) END AS c FROM part),
steps(k, sa, sb, sc, kept) AS (
  SELECT -1, ['']::VARCHAR[], ['']::VARCHAR[], ['']::VARCHAR[], false
  UNION ALL
  SELECT r.k, CASE WHEN ok THEN list_append(sa, r.a) ELSE sa END, CASE WHEN ok THEN list_append(sb, r.b) ELSE sb END, CASE WHEN ok AND r.c IS NOT NULL THEN list_append(sc, r.c) ELSE sc END, ok
  FROM (SELECT s.*, r.k AS rk, NOT list_contains(sa, r.a) AND NOT list_contains(sb, r.b) AND NOT coalesce(list_contains(sc, r.c), false) AS ok FROM steps s JOIN raw r ON r.k = s.k + 1) s JOIN raw r ON r.k = s.rk
)
SELECT raw.k, a, b, c FROM raw JOIN steps ON raw.k = steps.k WHERE kept""")
def insert_or_ignore(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = p.select(
        k.cast("int").alias("k"),
        F.concat(F.lit("a"), (k % 40).cast("string")).alias("a"),
        F.concat(F.lit("b"), (F.col("p_size") % 37).cast("string")).alias("b"),
        F.when(k % 3 != 0, F.concat(F.lit("c"), (k * 7 % 60).cast("string"))).alias("c"),
    )
    return ops.insert_species(rows, F.col("k"), [("a",), ("b",), ("c",)])


@query("""WITH t AS (SELECT p_partkey AS subject, 'rank' AS property, CASE WHEN p_size % 4 = 0 THEN 'genus' ELSE 'species' END AS value FROM part UNION ALL SELECT p_partkey, 'status', CASE WHEN p_size % 5 = 0 THEN 'EX' ELSE 'LC' END FROM part UNION ALL SELECT p_partkey, 'end', '1900' FROM part WHERE p_size % 7 = 0)
SELECT DISTINCT subject FROM t WHERE property = 'rank' AND value = 'species' AND subject NOT IN (SELECT subject FROM t WHERE (property = 'status' AND value = 'EX') OR property = 'end')""")
def live_species(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    row = lambda name, value: p.select(F.col("p_partkey").alias("subject"), F.lit(name).alias("property"), value.alias("value"))
    triples = row("rank", F.when(F.col("p_size") % 4 == 0, "genus").otherwise("species"))
    triples = triples.unionByName(row("status", F.when(F.col("p_size") % 5 == 0, "EX").otherwise("LC")))
    ended = p.where("p_size % 7 = 0").select(F.col("p_partkey").alias("subject"), F.lit("end").alias("property"), F.lit("1900").alias("value"))
    triples = triples.unionByName(ended)
    return ops.live_species(triples, [("status", "EX"), ("end", None)])


@query("""SELECT language, CASE language WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE upper(language) END AS display_name, count(*) AS raw_count, count(DISTINCT source) AS kept_count FROM (SELECT lang AS language, source FROM documents) GROUP BY language""")
def language_table(spark, sf_dir):
    raw = table(spark, sf_dir, "documents").select(F.col("lang").alias("language"), "source")
    return ops.languages(raw.distinct(), {"en": "English", "fr": "French"}, raw)
