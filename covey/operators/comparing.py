"""Comparisons of translation tables (species, language, name) between databases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Languages that a replacement must not lack, and bytes that a translation is taken to need.
CRITICAL = ("en", "es", "fr", "de", "it", "pt", "nl", "pl", "ru", "zh", "ja")
BYTES_EACH = 50


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def language_sets(a: DataFrame, b: DataFrame, language: str = "language") -> DataFrame:
    """(side, language): shared, first_only or second_only."""
    x, y = a.select(language).distinct(), b.select(language).distinct()
    parts = {"shared": x.intersect(y), "first_only": x.subtract(y), "second_only": y.subtract(x)}
    out = None
    for side, part in parts.items():
        one = part.select(F.lit(side).alias("side"), language)
        out = one if out is None else out.unionByName(one)
    return out


def combined_against(a: DataFrame, b: DataFrame, c: DataFrame, language: str = "language") -> DataFrame:
    """How much of c's languages a and b together have: counts and a percentage."""
    return language_sets(a.select(language).union(b.select(language)), c, language).agg(
        F.count_if(F.col("side") == "shared").alias("shared"),
        F.count_if(F.col("side") == "first_only").alias("extra"),
        F.count_if(F.col("side") == "second_only").alias("missing"),
        percent(F.count_if(F.col("side") == "shared"), F.count_if(F.col("side") != "first_only")).alias("coverage"),
    )


def in_all(frames: list[DataFrame], column: str) -> DataFrame:
    out = frames[0].select(column)
    for x in frames[1:]:
        out = out.intersect(x.select(column))
    return out.distinct()


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """By language that both have: species of each, common ones, and how many of these have the same name.

    One full outer join gives all counts; a translation table has one name for a species and language."""
    x = a.select("language", "species", F.col("name").alias("first"))
    y = b.select("language", "species", F.col("name").alias("second"))
    both = F.col("first").isNotNull() & F.col("second").isNotNull()
    out = x.join(y, ["language", "species"], "full_outer").groupBy("language").agg(
        F.count("first").alias("first_count"),
        F.count("second").alias("second_count"),
        F.count_if(both).alias("common"),
        F.count_if(both & (F.col("first") == F.col("second"))).alias("identical"),
    )
    out = out.withColumns({
        "different": F.col("common") - F.col("identical"),
        "first_only": F.col("first_count") - F.col("common"),
        "second_only": F.col("second_count") - F.col("common"),
        "identical_pct": percent(F.col("identical"), F.col("common")),
    })
    return out


def shared_languages(overlaps: DataFrame) -> DataFrame:
    return overlaps.where("first_count > 0 AND second_count > 0")


def three_way(a: DataFrame, b: DataFrame, c: DataFrame) -> DataFrame:
    """(species, language) that all three have, with whether the names agree: all, two of them, or none."""
    keys = ["species", "language"]
    met = a.select(*keys, F.col("name").alias("x")).join(b.select(*keys, F.col("name").alias("y")), keys).join(c.select(*keys, F.col("name").alias("z")), keys)
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return met.select(*keys, F.when((x == y) & (y == z), "all").when((x == y) | (y == z) | (x == z), "two").otherwise("none").alias("agreement"))


def recommendation(overlaps: DataFrame) -> DataFrame:
    """What to keep of each language, where from to remove, and how many rows that saves."""
    more = F.col("first_count") >= F.col("second_count")
    one_sided = F.when(F.col("second_count") == 0, "keep_in_first").when(F.col("first_count") == 0, "keep_in_second")
    action = (
        F.when(one_sided.isNotNull(), one_sided)
        .when((F.col("identical_pct") > 90) & more, "keep_in_first_only")
        .when(F.col("identical_pct") > 90, "keep_in_second_only")
        .when(F.col("identical_pct") > 50, "keep_both_deduplicate")
        .otherwise("keep_both")
    )
    drops = action.isin("keep_in_first_only", "keep_in_second_only", "keep_both_deduplicate")
    return overlaps.select("language", action.alias("action"), F.when(drops, F.when(more, "second").otherwise("first")).alias("remove_from"), F.when(drops, F.col("identical")).alias("savings"))


def savings(overlaps: DataFrame) -> DataFrame:
    """Translations that could go from either side, and their size."""
    both = (F.col("first_count") > 0) & (F.col("second_count") > 0)
    out = overlaps.agg(
        F.sum("first_count").alias("first_total"),
        F.sum("second_count").alias("second_total"),
        F.coalesce(F.sum(F.when(both, F.col("identical"))), F.lit(0)).alias("removable_from_second"),
        F.coalesce(F.sum(F.when(both & (F.col("second_count") > F.col("first_count")), F.col("identical"))), F.lit(0)).alias("removable_from_first"),
    )
    return out.withColumns({
        "saved_second_kb": F.col("removable_from_second") * BYTES_EACH / 1024,
        "saved_first_kb": F.col("removable_from_first") * BYTES_EACH / 1024,
        "total_mb": (F.col("first_total") + F.col("second_total")) * BYTES_EACH / 1024 / 1024,
    })


def coverage(a: DataFrame, b: DataFrame) -> DataFrame:
    """For languages that both have: counts, and the share of each side's species, rounded to a tenth."""
    total = lambda x, n: x.agg(F.countDistinct("species").alias(n))
    count = lambda x, n: x.groupBy("language").agg(F.count(F.lit(1)).alias(n))
    met = count(a, "first_count").join(count(b, "second_count"), "language")
    met = met.join(F.broadcast(total(a, "_a"))).join(F.broadcast(total(b, "_b")))  # one row each
    share = lambda n, of: F.bround(percent(F.col(n), F.col(of)), 1)
    return met.select("language", "first_count", share("first_count", "_a").alias("first_coverage"), "second_count", share("second_count", "_b").alias("second_coverage"))


def verdict(sets: DataFrame, covered: DataFrame, critical: tuple[str, ...] = CRITICAL, least: float = 85.0) -> DataFrame:
    """Whether the first database can replace the second: enough of its languages, and no critical one missing."""
    high = covered.agg(F.count_if(F.col("first_coverage") > 90).alias("high_coverage"))
    out = sets.agg(
        F.count_if(F.col("side") == "shared").alias("shared"),
        F.count_if(F.col("side") == "first_only").alias("extra"),
        F.count_if((F.col("side") == "second_only") & F.col("language").isin(*critical)).alias("missing_critical"),
        percent(F.count_if(F.col("side") == "shared"), F.count_if(F.col("side") != "first_only")).alias("language_coverage"),
    )
    return out.join(F.broadcast(high)).withColumn("sufficient", (F.col("language_coverage") >= least) & (F.col("missing_critical") == 0))


def statistics(translations: DataFrame) -> DataFrame:
    return translations.agg(F.count(F.lit(1)).alias("translations"), F.countDistinct("species").alias("species"), F.countDistinct("language").alias("languages"))


def top_languages(translations: DataFrame, k: int = 20) -> DataFrame:
    """The languages with most translations, and their mean number for each species that has any."""
    counted = translations.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("species").alias("species"))
    return counted.withColumn("per_species", F.bround(F.col("n") / F.col("species"), 2)).orderBy(F.desc("n"), "language").limit(k)


def without_fallbacks(labels: DataFrame, species: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels that aren't just the scientific name (case matters), and counts of those that are, by language."""
    met = labels.join(species.select("species", "scientific_name"), "species")
    same = F.col("name") == F.col("scientific_name")
    return met.where(~same).drop("scientific_name"), met.groupBy("language").agg(F.count(F.lit(1)).alias("raw_count"), F.count_if(same).alias("removed"))


def mapping_check(mapping: DataFrame, key: str, needed: list[str], least: int) -> DataFrame:
    """Rows, missing and distinct keys of a mapping table, and whether it passes."""
    has = all(c in mapping.columns for c in needed)
    out = mapping.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(key).isNull()).alias("missing"), F.countDistinct(key).alias("distinct_keys"))
    ok = {"has_columns": F.lit(has), "no_missing": F.col("missing") == 0, "enough": F.col("n_rows") >= least, "unique": F.col("distinct_keys") == F.col("n_rows") - F.col("missing")}
    out = out.withColumns(ok)
    return out.withColumn("passes", F.forall(F.array(*ok), lambda x: x))
