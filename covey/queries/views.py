"""The driver's tables as observations, in Spark and in SQL."""

from pyspark.sql import DataFrame, functions as F

#: Columns of an observation, and what they are made of.
OBS = """obs AS (
  SELECT l_orderkey AS checklist, l_linenumber AS line, l_partkey AS part, p_brand AS brand, p_type AS kind, l_quantity AS quantity,
    l_returnflag AS flag, l_shipdate AS seen_at, CAST(month(l_shipdate) AS INTEGER) AS month, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
    l_suppkey AS cell5, CAST(s_nationkey AS BIGINT) AS cell4, CAST(n_regionkey AS BIGINT) AS cell2,
    CAST((l_partkey * 37) % 18001 AS DOUBLE) / 100 - 90 AS lat, CAST((l_orderkey * 53) % 36001 AS DOUBLE) / 100 - 180 AS lon
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
)"""


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark, sf_dir: str) -> DataFrame:
    lines, suppliers, nations, parts = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation", "part"))
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("l_orderkey").alias("checklist"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").alias("seen_at"),
        F.month("l_shipdate").alias("month"),
        F.year("l_shipdate").alias("year"),
        F.quarter("l_shipdate").alias("quarter"),
        F.col("l_suppkey").alias("cell5"),
        F.col("s_nationkey").cast("long").alias("cell4"),
        F.col("n_regionkey").cast("long").alias("cell2"),
        ((F.col("l_partkey") * 37 % 18001).cast("double") / 100 - 90).alias("lat"),
        ((F.col("l_orderkey") * 53 % 36001).cast("double") / 100 - 180).alias("lon"),
    )
