"""Reference databases of species and their names as SQLite files, of the checklist and of the label service."""

from __future__ import annotations

import os
import sqlite3
from itertools import islice

from pyspark.sql import DataFrame

BATCH = 1000
# The tables of the two databases, whose columns are the format, and their indexes.
_SHARED = """
CREATE TABLE translations (avibase_id VARCHAR(20) NOT NULL REFERENCES species (avibase_id), language_code VARCHAR(10) NOT NULL, common_name VARCHAR(150) NOT NULL, PRIMARY KEY (avibase_id, language_code));
CREATE TABLE metadata (key VARCHAR(50) NOT NULL PRIMARY KEY, value VARCHAR(500) NOT NULL);
"""
CHECKLIST_DDL = """
CREATE TABLE species (avibase_id VARCHAR(20) NOT NULL PRIMARY KEY, scientific_name VARCHAR(80) NOT NULL UNIQUE, english_name VARCHAR(80) NOT NULL, order_name VARCHAR(30) NOT NULL, family VARCHAR(30) NOT NULL, genus VARCHAR(30) NOT NULL, species_epithet VARCHAR(30) NOT NULL, authority VARCHAR(60), breeding_regions VARCHAR(20), breeding_subregions VARCHAR(200), bow_url VARCHAR(200));
CREATE TABLE languages (language_code VARCHAR(10) NOT NULL PRIMARY KEY, language_name VARCHAR(50) NOT NULL, language_family VARCHAR(30), translation_count INTEGER NOT NULL);
""" + _SHARED
LABELS_DDL = """
CREATE TABLE species (avibase_id VARCHAR(20) NOT NULL PRIMARY KEY, scientific_name VARCHAR(80) NOT NULL UNIQUE, wikidata_id VARCHAR(20) NOT NULL UNIQUE, taxon_rank VARCHAR(30), english_name VARCHAR(120), image_url VARCHAR(500), conservation_status VARCHAR(50));
CREATE TABLE languages (language_code VARCHAR(10) NOT NULL PRIMARY KEY, language_name VARCHAR(50) NOT NULL, translation_count INTEGER NOT NULL);
""" + _SHARED
CHECKLIST_INDEXES = """
CREATE INDEX idx_species_family ON species (family);
CREATE INDEX idx_species_genus ON species (genus);
CREATE INDEX idx_species_order_family ON species (order_name, family);
CREATE INDEX idx_species_english_name ON species (english_name);
CREATE INDEX idx_translations_language_common ON translations (language_code, common_name);
"""
LABELS_INDEXES = "CREATE INDEX idx_translations_lang_name ON translations (language_code, common_name);"
KINDS = {"checklist": (CHECKLIST_DDL, CHECKLIST_INDEXES), "labels": (LABELS_DDL, LABELS_INDEXES)}


def reference_database(tables: dict[str, DataFrame], path: str, kind: str = "checklist") -> dict[str, int]:
    """Writes tables (species, translations, languages, metadata) to a new file, whole or not at all; rows of each.

    Columns are taken by name, missing ones are null. Rows come to the driver part by part and go in by
    batches, so its memory doesn't grow with a table; a key that comes twice fails the write."""
    ddl, indexes = KINDS[kind]
    part = f"{path}.part"
    if os.path.exists(part):
        os.remove(part)
    db, counts = sqlite3.connect(part), {}
    try:
        db.executescript(ddl)
        for name in ("species", "translations", "languages", "metadata"):
            columns = [r[1] for r in db.execute(f"PRAGMA table_info({name})")]
            has = [c for c in columns if name in tables and c in tables[name].columns]
            rows = tables[name].select(*has).toLocalIterator() if has else iter(())
            insert = f"INSERT INTO {name} ({', '.join(has)}) VALUES ({', '.join('?' * len(has))})"
            counts[name] = 0
            while batch := [tuple(r) for r in islice(rows, BATCH)]:
                db.executemany(insert, batch)
                counts[name] += len(batch)
        db.executescript(indexes)
        db.execute("ANALYZE")
        db.commit()
    finally:
        db.close()
    os.replace(part, path)
    return counts
