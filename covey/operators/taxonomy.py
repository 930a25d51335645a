"""Taxonomies and multilingual names: from files' frames to species, translations, languages and metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as text_functions
from .lookups import inserted, last_wins


def long_names(wide: DataFrame, keys: list[str], languages: list[str]) -> DataFrame:
    """One row for each language column that isn't blank, as (keys, language, name)."""
    return wide.unpivot(keys, languages, "language", "name").where(F.trim(F.coalesce("name", F.lit(""))) != "")


def key_values(one: DataFrame) -> DataFrame:
    """The columns of a table of one row as (key, value) of text."""
    return one.select(*(F.col(c).cast("string").alias(c) for c in one.columns)).unpivot([], one.columns, "key", "value")


def flat_species(orders: DataFrame) -> DataFrame:
    """Species of a nested list of orders (see sources.xml_species), without extinct genera and species and those that lack a name.

    The scientific name is the genus and the epithet; an empty authority is the genus's."""
    families = orders.select(text_functions.title(F.col("latin_name")).alias("order_name"), F.explode("family").alias("f"))
    genera = families.select("order_name", F.col("f.latin_name").alias("family"), F.explode("f.genus").alias("g")).where(F.coalesce("g._extinct", F.lit("")) != "yes")
    species = genera.select("order_name", "family", F.col("g.latin_name").alias("genus"), F.col("g.authority").alias("genus_authority"), F.explode("g.species").alias("s")).where(F.coalesce("s._extinct", F.lit("")) != "yes")
    filled = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    out = species.select(
        F.concat_ws(" ", "genus", filled("s.latin_name")).alias("scientific_name"),
        filled("s.english_name").alias("english_name"),
        "order_name",
        "family",
        "genus",
        filled("s.latin_name").alias("epithet"),
        F.coalesce(filled("s.authority"), filled("genus_authority")).alias("authority"),
        F.col("s.breeding_regions").alias("breeding_regions"),
        F.col("s.breeding_subregions").alias("breeding_subregions"),
    )
    return out.where("genus IS NOT NULL AND epithet IS NOT NULL AND english_name IS NOT NULL")


def with_ids(species: DataFrame, mapping: DataFrame, name: str = "scientific_name") -> DataFrame:
    """species with the id that mapping (scientific_name, taxon_id, url, ordinal) has last for the name, case aside; others go."""
    clean = mapping.where(F.trim(F.coalesce("scientific_name", F.lit(""))) != "").where(F.trim(F.coalesce("taxon_id", F.lit(""))) != "")
    ids = last_wins(clean, text_functions.key(F.col("scientific_name")), "ordinal", "taxon_id")
    urls = clean.where("lower(trim(url)) NOT IN ('', 'nan')")
    urls = last_wins(urls, text_functions.key(F.col("scientific_name")), "ordinal", "url")
    return species.join(ids.join(urls, "key", "left"), text_functions.key(F.col(name)) == F.col("key")).drop("key")


def existing_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of the wanted columns that df has, in the order wanted."""
    return df.select(*(c for c in wanted if c in df.columns))


def species_rank(df: DataFrame, rank: str, key: str, wanted: list[str]) -> DataFrame:
    return existing_columns(df.where((F.lower(rank) == "species") & F.col(key).isNotNull()), wanted)


def header_columns(columns: list[str], required: list[str], excluded: set[str]) -> dict[str, str]:
    """Language columns by their lower-cased code; raises where a required column is missing."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return {c: c.strip().lower() for c in columns if c not in excluded and c not in required and c.strip()}


def insert_species(df: DataFrame, order: Column, unique: list[tuple[str, ...]]) -> DataFrame:
    """Rows in order without those that repeat any of the unique keys of one kept before; see lookups.inserted."""
    return inserted(df, order, unique)


def languages(translations: DataFrame, names: dict[str, str], raw: DataFrame | None = None) -> DataFrame:
    """(language, display_name, raw_count, kept_count): codes without a name are shown in upper case."""
    kept = translations.groupBy("language").agg(F.count(F.lit(1)).alias("kept_count"))
    if raw is not None:
        kept = raw.groupBy("language").agg(F.count(F.lit(1)).alias("raw_count")).join(kept, "language", "left").fillna(0, ["kept_count"])
    else:
        kept = kept.withColumn("raw_count", F.col("kept_count"))
    return kept.select("language", text_functions.looked_up(names, F.col("language"), F.upper("language")).alias("display_name"), "raw_count", "kept_count")


def bindings(results: DataFrame, variables: list[str]) -> DataFrame:
    """Rows of a query service's JSON (results.bindings, each a map from a variable to {value}); a missing one is null."""
    flat = results.select(F.explode("results.bindings").alias("b"))
    return flat.select(*(F.try_element_at("b", F.lit(v))["value"].alias(v) for v in variables))


def live_species(triples: DataFrame, ended: list[tuple[str, str | None]]) -> DataFrame:
    """Subjects of rank species with none of the properties (name, value or any) that mean extinct.

    triples: (subject, property, value)."""
    out = triples.where("property = 'rank' AND value = 'species'").select("subject").distinct()
    bad = reduce(lambda a, b: a | b, ((F.col("property") == p) & (F.lit(True) if v is None else F.col("value") == v) for p, v in ended))
    return out.join(triples.where(bad).select("subject"), "subject", "left_anti")
