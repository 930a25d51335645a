"""Queries on scalar functions of text, dates, numbers, arrays, maps and JSON."""

from pyspark.sql import functions as F

from ..functions import geo, scores, text
from .registry import query
from .views import table


@query("""SELECT p_partkey, lower(trim('  ' || p_name || ' ')) AS key, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'avibase-' || upper(substr(md5(p_name), 1, 8)) END AS taxon, list_extract(string_split('http://x/e/' || p_brand, '/'), -1) AS segment,
replace(p_brand, '#', '_') AS replaced, split_part(p_type || '_' || p_brand, '_', 2) AS label_part, printf('%03d', p_size) AS padded, concat_ws(',', p_brand, p_type) AS listed, coalesce(nullif(substr(p_type, 1, 1), 'S'), 'none') AS fallback FROM part""")
def string_kit(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.md5(F.col("p_name").cast("binary")))
    return p.select(
        "p_partkey",
        text.key(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("key"),
        text.taxon_id(raw).alias("taxon"),
        text.last_segment(F.concat(F.lit("http://x/e/"), "p_brand")).alias("segment"),
        F.replace("p_brand", F.lit("#"), F.lit("_")).alias("replaced"),
        F.split_part(F.concat("p_type", F.lit("_"), "p_brand"), F.lit("_"), F.lit(2)).alias("label_part"),
        F.format_string("%03d", "p_size").alias("padded"),
        F.concat_ws(",", "p_brand", "p_type").alias("listed"),
        F.coalesce(F.nullif(F.substring("p_type", 1, 1), F.lit("S")), F.lit("none")).alias("fallback"),
    )


@query("""SELECT o_orderkey, CASE WHEN n < 1024 THEN printf('%.2f B', n) WHEN n < 1048576 THEN printf('%.2f KB', n / 1024) WHEN n < 1073741824 THEN printf('%.2f MB', n / 1048576) WHEN n < 1099511627776 THEN printf('%.2f GB', n / 1073741824) ELSE printf('%.2f TB', n / 1099511627776) END AS size,
CASE WHEN s >= 3600 THEN printf('%dh %dm %ds', s // 3600, s // 60 % 60, s % 60) WHEN s >= 60 THEN printf('%dm %ds', s // 60 % 60, s % 60) ELSE printf('%ds', s % 60) END AS duration
FROM (SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) * o_orderkey * (o_custkey % 997 + 1) * (o_custkey % 13 + 1) AS n, o_orderkey % 9000 AS s FROM orders)""")
def human_kit(spark, sf_dir):
    n = F.col("o_orderkey").cast("double") * F.col("o_orderkey") * (F.col("o_custkey") % 997 + 1) * (F.col("o_custkey") % 13 + 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", text.human_size(n).alias("size"), text.human_duration(F.col("o_orderkey") % 9000).alias("duration"))


@query("""SELECT o_orderkey, CAST(substr(d, 1, 4) AS INTEGER) AS year, CAST(substr(d, 6, 2) AS INTEGER) AS month, CAST(substr(d, 1, 3) || '0' AS INTEGER) AS decade, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
strftime(o_orderdate, '%Y.%m') AS version, CAST(epoch(o_orderdate) - epoch(TIMESTAMP '1995-01-01') AS BIGINT) AS seconds FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)""")
def date_kit(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select(
        "o_orderkey",
        F.substring("d", 1, 4).try_cast("int").alias("year"),
        text.month(F.col("d")).alias("month"),
        text.decade(F.col("d")).alias("decade"),
        F.quarter("o_orderdate").alias("quarter"),
        F.date_format("o_orderdate", "yyyy.MM").alias("version"),
        F.timestamp_diff("SECOND", F.lit("1995-01-01").cast("timestamp_ntz"), F.col("o_orderdate").cast("timestamp_ntz")).alias("seconds"),
    )


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 3 <> 0 THEN l_quantity / (l_partkey % 3) * 100 ELSE 0 END AS guarded, round_even(l_extendedprice / 8, 1) AS half_even, CAST(floor(l_extendedprice / 8 + 0.5) AS BIGINT) AS half_up,
CAST(trunc(l_extendedprice / 100) AS BIGINT) * 100 AS bucket, least(1.0, l_quantity / 40) AS clamped, CAST(ceil(l_orderkey / 50.0) AS BIGINT) AS batches, l_orderkey % 7 AS worker, round(l_extendedprice * 1000 / 1048576, 6) AS mb FROM lineitem""")
def math_kit(spark, sf_dir):
    price, part = F.col("l_extendedprice"), F.col("l_partkey") % 3
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.ratio(F.col("l_quantity"), part).alias("guarded"),
        F.bround(price / 8, 1).alias("half_even"),
        geo.half_up(price / 8).alias("half_up"),
        ((price / 100).cast("long") * 100).alias("bucket"),
        F.least(F.lit(1.0), F.col("l_quantity") / 40).alias("clamped"),
        F.ceil(F.col("l_orderkey") / F.lit(50.0)).alias("batches"),
        F.pmod("l_orderkey", F.lit(7)).alias("worker"),
        F.round(price * 1000 / 1048576, 6).alias("mb"),
    )


@query("""SELECT n_regionkey, len(l) AS n, array_to_string(list_sort(l), ',') AS names, list_contains(l, 'NATION_3') AS has, array_to_string(list_slice(list_sort(l), 1, 2), ',') AS first_two,
CASE n_regionkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'other' END AS looked_up FROM (SELECT n_regionkey, list(n_name) AS l FROM nation GROUP BY 1)""")
def array_map_kit(spark, sf_dir):
    grouped = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("l"))
    return grouped.select(
        "n_regionkey",
        F.size("l").cast("long").alias("n"),
        F.array_join("l", ",").alias("names"),
        F.array_contains("l", "NATION_3").alias("has"),
        F.array_join(F.slice("l", 1, 2), ",").alias("first_two"),
        text.looked_up({0: "zero", 1: "one"}, F.col("n_regionkey"), F.lit("other")).alias("looked_up"),
    )


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string('[1.5,2.5,' || CAST(event_id AS VARCHAR) || ']', '$[2]') AS BIGINT) AS third FROM events""")
def json_kit(spark, sf_dir):
    array = F.concat(F.lit("[1.5,2.5,"), F.col("event_id").cast("string"), F.lit("]"))
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.element_at(F.from_json(array, "array<double>"), 3).cast("long").alias("third"))


@query("SELECT w AS week, CAST(least(12, ceil(w / 4.0)) AS INTEGER) AS month, CASE WHEN w < 1 OR w > 48 THEN 12 WHEN w >= 44 THEN 11 WHEN w >= 40 THEN 10 WHEN w >= 36 THEN 9 WHEN w >= 31 THEN 8 WHEN w >= 27 THEN 7 WHEN w >= 22 THEN 6 WHEN w >= 18 THEN 5 WHEN w >= 14 THEN 4 WHEN w >= 9 THEN 3 WHEN w >= 5 THEN 2 ELSE 1 END AS irregular FROM (SELECT CAST(p_partkey AS INTEGER) AS w FROM part WHERE p_partkey <= 60)")
def week_to_month(spark, sf_dir):
    week = F.col("p_partkey").cast("int")
    return table(spark, sf_dir, "part").where("p_partkey <= 60").select(week.alias("week"), scores.month_of_week(week).alias("month"), scores.month_of_week_irregular(week).alias("irregular"))


@query("SELECT s_suppkey, round(s_suppkey * power(7.0, (s_suppkey % 3 + 5) - 4) * 450 * 60.0 * 0.25, 4) AS bytes, CASE WHEN s_suppkey * 2500 >= 100000 THEN 6 WHEN s_suppkey * 2500 >= 10000 THEN 5 ELSE 4 END AS resolution FROM supplier")
def pack_size_model(spark, sf_dir):
    k = F.col("s_suppkey")
    size = scores.modelled_size(k, F.lit(4), k % 3 + 5, F.lit(450), 60.0, 0.25)
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(size, 4).alias("bytes"), scores.data_resolution(k * 2500).alias("resolution"))


@query("""SELECT c_custkey, language, name FROM (SELECT c_custkey, unnest(['en', 'fr', 'de']) AS language, unnest([c_name, CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE 'fr ' || c_name END, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END]) AS name FROM customer) WHERE trim(coalesce(name, '')) <> ''""")
def unpivot_languages(spark, sf_dir):
    k = F.col("c_custkey")
    wide = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("en"),
        F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("fr "), "c_name")).alias("fr"),
        F.when(k % 4 != 0, F.col("c_mktsegment")).alias("de"),
    )
    from ..operators.taxonomy import long_names

    return long_names(wide, ["c_custkey"], ["en", "fr", "de"])


@query("""WITH m AS (SELECT count(*) AS n, count(DISTINCT c_nationkey) AS nations, max(c_acctbal) AS top FROM customer) SELECT 'rows' AS key, CAST(n AS VARCHAR) AS value FROM m UNION ALL SELECT 'nations', CAST(nations AS VARCHAR) FROM m UNION ALL SELECT 'version', '2024.01' FROM m""")
def metadata_kv(spark, sf_dir):
    from ..operators.taxonomy import key_values

    m = table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("c_nationkey").alias("nations"), F.lit("2024.01").alias("version"))
    return key_values(m)
