"""Queries that compare translation tables: documents' sources and orders play species and languages."""

from pyspark.sql import functions as F

from ..operators import comparing as ops
from .frequencies import rounded
from .registry import query
from .views import table

#: Three tables of (species, language, name), one name for each pair.
T = """a AS (SELECT DISTINCT c_custkey % 400 AS species, 'l' || CAST(c_nationkey AS VARCHAR) AS language, 'n' || CAST((c_custkey % 400) % 7 + c_nationkey % 2 AS VARCHAR) AS name FROM customer WHERE c_nationkey < 18),
b AS (SELECT DISTINCT c_custkey % 400 AS species, 'l' || CAST(c_nationkey AS VARCHAR) AS language, 'n' || CAST((c_custkey % 400) % 7 + CASE WHEN (c_custkey % 400) % 10 < c_nationkey % 11 THEN 9 ELSE c_nationkey % 2 END AS VARCHAR) AS name FROM customer WHERE c_nationkey > 4 AND c_custkey % 3 <> 1),
c AS (SELECT DISTINCT s_suppkey % 50 AS species, 'l' || CAST(s_nationkey AS VARCHAR) AS language, 'n' || CAST((s_suppkey % 50) % 7 AS VARCHAR) AS name FROM supplier)"""
OVERLAP = f"""{T}, ov AS (
  SELECT coalesce(a.language, b.language) AS language, count(a.name) AS first_count, count(b.name) AS second_count, count(*) FILTER (a.name IS NOT NULL AND b.name IS NOT NULL) AS common, count(*) FILTER (a.name = b.name) AS identical
  FROM a FULL JOIN b ON a.language = b.language AND a.species = b.species GROUP BY 1),
pct AS (SELECT *, CASE WHEN common > 0 THEN identical / common::DOUBLE * 100 ELSE 0 END AS identical_pct FROM ov)"""


def tables(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    k, n = F.col("c_custkey") % 400, F.col("c_nationkey")
    language, text = F.concat(F.lit("l"), n.cast("string")), lambda x: F.concat(F.lit("n"), x.cast("string"))
    a = c.where("c_nationkey < 18").select(k.alias("species"), language.alias("language"), text(k % 7 + n % 2).alias("name")).distinct()
    other = k % 7 + F.when(k % 10 < n % 11, F.lit(9)).otherwise(n % 2)
    b = c.where("c_nationkey > 4 AND c_custkey % 3 <> 1").select(k.alias("species"), language.alias("language"), text(other).alias("name")).distinct()
    d = s.select((F.col("s_suppkey") % 50).alias("species"), F.concat(F.lit("l"), F.col("s_nationkey").cast("string")).alias("language"), text(F.col("s_suppkey") % 50 % 7).alias("name")).distinct()
    return a, b, d


def overlaps(spark, sf_dir):
    a, b, _ = tables(spark, sf_dir)
    return ops.overlap(a, b)


@query(f"WITH {T} SELECT 'shared' AS side, language FROM (SELECT language FROM a INTERSECT SELECT language FROM b) UNION ALL SELECT 'first_only', language FROM (SELECT language FROM a EXCEPT SELECT language FROM b) UNION ALL SELECT 'second_only', language FROM (SELECT language FROM b EXCEPT SELECT language FROM a)")
def language_sets(spark, sf_dir):
    a, b, _ = tables(spark, sf_dir)
    return ops.language_sets(a, b)


SETS = f"""{T}, x AS (SELECT language FROM a UNION SELECT language FROM c), s AS (SELECT 'shared' AS side, language FROM (SELECT language FROM x INTERSECT SELECT language FROM b)
UNION ALL SELECT 'first_only', language FROM (SELECT language FROM x EXCEPT SELECT language FROM b) UNION ALL SELECT 'second_only', language FROM (SELECT language FROM b EXCEPT SELECT language FROM x))"""


@query(f"WITH {SETS} SELECT count(*) FILTER (side = 'shared') AS shared, count(*) FILTER (side = 'first_only') AS extra, count(*) FILTER (side = 'second_only') AS missing, count(*) FILTER (side = 'shared') / count(*) FILTER (side <> 'first_only')::DOUBLE * 100 AS coverage FROM s")
def combined_vs_third(spark, sf_dir):
    a, b, c = tables(spark, sf_dir)
    return ops.combined_against(a, c, b)


@query(f"WITH {T} SELECT species FROM a INTERSECT SELECT species FROM b INTERSECT SELECT species FROM c")
def three_way_intersect(spark, sf_dir):
    return ops.in_all(list(tables(spark, sf_dir)), "species")


@query(f"WITH {T} SELECT a.species, a.language, CASE WHEN a.name = b.name AND b.name = c.name THEN 'all' WHEN a.name = b.name OR b.name = c.name OR a.name = c.name THEN 'two' ELSE 'none' END AS agreement FROM a JOIN b ON a.species = b.species AND a.language = b.language JOIN c ON a.species = c.species AND a.language = c.language")
def three_way_match(spark, sf_dir):
    return ops.three_way(*tables(spark, sf_dir))


@query(f"WITH {OVERLAP} SELECT language, first_count, second_count, common, identical, common - identical AS different, first_count - common AS first_only, second_count - common AS second_only, round(identical_pct, 6) AS identical_pct FROM pct WHERE first_count > 0 AND second_count > 0")
def overlap_by_language(spark, sf_dir):
    return ops.shared_languages(overlaps(spark, sf_dir)).withColumn("identical_pct", F.round("identical_pct", 6))


ACTION = "CASE WHEN second_count = 0 THEN 'keep_in_first' WHEN first_count = 0 THEN 'keep_in_second' WHEN identical_pct > 90 AND first_count >= second_count THEN 'keep_in_first_only' WHEN identical_pct > 90 THEN 'keep_in_second_only' WHEN identical_pct > 50 THEN 'keep_both_deduplicate' ELSE 'keep_both' END"


@query(f"""WITH {OVERLAP}, r AS (SELECT *, {ACTION} AS action FROM pct) SELECT language, action, CASE WHEN action IN ('keep_in_first_only', 'keep_in_second_only', 'keep_both_deduplicate') THEN CASE WHEN first_count >= second_count THEN 'second' ELSE 'first' END END AS remove_from,
CASE WHEN action IN ('keep_in_first_only', 'keep_in_second_only', 'keep_both_deduplicate') THEN identical END AS savings FROM r""")
def recommendation(spark, sf_dir):
    return ops.recommendation(overlaps(spark, sf_dir))


@query(f"""WITH {OVERLAP}, s AS (SELECT CAST(sum(first_count) AS BIGINT) AS first_total, CAST(sum(second_count) AS BIGINT) AS second_total, CAST(coalesce(sum(identical) FILTER (first_count > 0 AND second_count > 0), 0) AS BIGINT) AS removable_from_second,
CAST(coalesce(sum(identical) FILTER (first_count > 0 AND second_count > first_count), 0) AS BIGINT) AS removable_from_first FROM pct)
SELECT *, removable_from_second * 50 / 1024.0::DOUBLE AS saved_second_kb, removable_from_first * 50 / 1024.0::DOUBLE AS saved_first_kb, (first_total + second_total) * 50 / 1024.0::DOUBLE / 1024 AS total_mb FROM s""")
def size_savings(spark, sf_dir):
    return ops.savings(overlaps(spark, sf_dir))


COVERAGE = f"""{T}, cov AS (SELECT x.language, x.n AS first_count, round_even(x.n / (SELECT count(DISTINCT species) FROM a)::DOUBLE * 100, 1) AS first_coverage, y.n AS second_count, round_even(y.n / (SELECT count(DISTINCT species) FROM b)::DOUBLE * 100, 1) AS second_coverage
FROM (SELECT language, count(*) AS n FROM a GROUP BY 1) x JOIN (SELECT language, count(*) AS n FROM b GROUP BY 1) y ON x.language = y.language)"""


@query(f"WITH {COVERAGE} SELECT * FROM cov")
def coverage_comparison(spark, sf_dir):
    a, b, _ = tables(spark, sf_dir)
    return ops.coverage(a, b)


@query(f"""WITH {COVERAGE}, s AS (SELECT 'shared' AS side, language FROM (SELECT language FROM a INTERSECT SELECT language FROM b) UNION ALL SELECT 'first_only', language FROM (SELECT language FROM a EXCEPT SELECT language FROM b) UNION ALL SELECT 'second_only', language FROM (SELECT language FROM b EXCEPT SELECT language FROM a)),
v AS (SELECT count(*) FILTER (side = 'shared') AS shared, count(*) FILTER (side = 'first_only') AS extra, count(*) FILTER (side = 'second_only' AND language IN ('l20', 'l3')) AS missing_critical, count(*) FILTER (side = 'shared') / count(*) FILTER (side <> 'first_only')::DOUBLE * 100 AS language_coverage FROM s)
SELECT v.*, (SELECT count(*) FROM cov WHERE first_coverage > 90) AS high_coverage, language_coverage >= 85 AND missing_critical = 0 AS sufficient FROM v""")
def sufficiency_verdict(spark, sf_dir):
    a, b, _ = tables(spark, sf_dir)
    return ops.verdict(ops.language_sets(a, b), ops.coverage(a, b), ("l20", "l3"))


@query(f"WITH {T} SELECT count(*) AS translations, count(DISTINCT species) AS species, count(DISTINCT language) AS languages FROM a")
def db_statistics(spark, sf_dir):
    return ops.statistics(tables(spark, sf_dir)[0])


@query(f"WITH {T} SELECT language, count(*) AS n, count(DISTINCT species) AS species, round_even(count(*) / count(DISTINCT species)::DOUBLE, 2) AS per_species FROM b GROUP BY 1 ORDER BY n DESC, language LIMIT 20")
def top_languages(spark, sf_dir):
    return ops.top_languages(tables(spark, sf_dir)[1])


SPECIES = "sp AS (SELECT DISTINCT species, CASE WHEN species % 2 = 0 THEN 'n' || CAST(species % 7 AS VARCHAR) ELSE 'N' || CAST(species % 7 AS VARCHAR) END AS scientific_name FROM a)"


def named_species(a):
    k = F.col("species")
    return a.select("species").distinct().withColumn("scientific_name", F.concat(F.when(k % 2 == 0, "n").otherwise("N"), (k % 7).cast("string")))


@query(f"WITH {T}, {SPECIES} SELECT a.species, language, name FROM a JOIN sp ON a.species = sp.species WHERE name <> scientific_name")
def fallback_label_filter(spark, sf_dir):
    a = tables(spark, sf_dir)[0]
    return ops.without_fallbacks(a, named_species(a))[0].select("species", "language", "name")


@query(f"WITH {T}, {SPECIES} SELECT language, count(*) AS raw_count, count(*) FILTER (name = scientific_name) AS removed FROM a JOIN sp ON a.species = sp.species GROUP BY 1")
def fallback_counts(spark, sf_dir):
    a = tables(spark, sf_dir)[0]
    return ops.without_fallbacks(a, named_species(a))[1]


@query("""WITH m AS (SELECT nullif(p_partkey % 50, 0) AS k FROM part), s AS (SELECT count(*) AS n_rows, count(*) FILTER (k IS NULL) AS missing, count(DISTINCT k) AS distinct_keys FROM m)
SELECT *, true AS has_columns, missing = 0 AS no_missing, n_rows >= 100 AS enough, distinct_keys = n_rows - missing AS "unique", missing = 0 AND n_rows >= 100 AND distinct_keys = n_rows - missing AS passes FROM s""")
def mapping_validation(spark, sf_dir):
    mapping = table(spark, sf_dir, "part").select(F.nullif(F.col("p_partkey") % 50, F.lit(0)).alias("k"))
    return ops.mapping_check(mapping, "k", ["k"], 100)


@query("SELECT lang, source, count(*) AS n, round(avg(n_chars), 6) AS mean_chars FROM documents GROUP BY GROUPING SETS ((lang, source), (lang))")
def language_dimension(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = docs.groupingSets([[F.col("lang"), F.col("source")], [F.col("lang")]], "lang", "source").agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean_chars"))
    return rounded(out, "mean_chars").withColumn("mean_chars", F.round("mean_chars", 6))
