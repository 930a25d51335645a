"""Schemas of what the engine reads."""

from pyspark.sql import types as T

# Names and types of the observation dump's columns, by position. Rows follow the newer layout from column 34 on.
OBSERVATION_COLUMNS: tuple[tuple[str, str], ...] = (
    ("global_unique_identifier", "string"), ("last_edited_date", "string"), ("taxonomic_order", "double"), ("category", "string"),
    ("taxon_concept_id", "string"), ("common_name", "string"), ("scientific_name", "string"), ("subspecies_common_name", "string"),
    ("subspecies_scientific_name", "string"), ("exotic_code", "string"), ("observation_count", "string"), ("breeding_code", "string"),
    ("breeding_category", "string"), ("behavior_code", "string"), ("age_sex", "string"), ("country", "string"), ("country_code", "string"),
    ("state", "string"), ("state_code", "string"), ("county", "string"), ("county_code", "string"), ("iba_code", "string"),
    ("bcr_code", "bigint"), ("usfws_code", "string"), ("atlas_block", "string"), ("locality", "string"), ("locality_id", "string"),
    ("locality_type", "string"), ("latitude", "double"), ("longitude", "double"), ("observation_date", "string"),
    ("time_observations_started", "string"), ("observer_id", "string"), ("observer_extra", "string"), ("sampling_event_identifier", "string"),
    ("observation_type", "string"), ("protocol_name", "string"), ("protocol_code", "string"), ("project_names", "string"),
    ("project_identifiers", "string"), ("duration_minutes", "double"), ("effort_distance_km", "double"), ("effort_area_ha", "double"),
    ("number_observers", "bigint"), ("all_species_reported", "bigint"), ("group_identifier", "string"), ("has_media", "bigint"),
    ("approved", "bigint"), ("reviewed", "bigint"),
)
OBSERVATION_TEXT = T.StructType([T.StructField(n, T.StringType()) for n, _ in OBSERVATION_COLUMNS])

BOUNDARY_CELLS = "cells array<struct<boundary_cell:string,boundary_cell_int:bigint,observation_count:bigint,checklist_count:bigint,species_count:bigint,lat_min:double,lat_max:double,lon_min:double,lon_max:double>>"
DENSITY_REPORT = "resolution int, total_cells bigint, total_checklists bigint, total_observations bigint, cells array<struct<h3_cell:string,center_lat:double,center_lon:double,unique_checklists:bigint,complete_checklists:bigint,total_observations:bigint,species_count:bigint,estimated_pack_size_mb:double,recommended_data_resolution:int>>"
MANIFEST = "version string, regions array<struct<region_id:string,release_name:string,h3_cells:array<string>,packs:array<struct<pack_id:string,boundary_cell:string,boundary_resolution:int,data_resolution:int,center_lat:double,center_lon:double,estimated_size_mb:double,total_checklists:bigint>>,size_mb:double,pack_count:bigint,center:struct<lat:double,lon:double>>>"
REGISTRY = "version string, generated_at string, total_regions bigint, total_packs bigint, regions array<struct<region_id:string,release_name:string,h3_cells:array<string>,pack_count:bigint,total_size_mb:double,resolution:int,center:struct<lat:double,lon:double>,bbox:struct<min_lat:double,max_lat:double,min_lon:double,max_lon:double>>>"
COVERAGE_REPORT = "species_count bigint, languages map<string,bigint>"
BINDINGS = "results struct<bindings:array<map<string,struct<value:string>>>>"
_SPECIES = "struct<latin_name:string,english_name:string,authority:string,breeding_regions:string,breeding_subregions:string,_extinct:string>"
_GENUS = f"struct<latin_name:string,authority:string,_extinct:string,species:array<{_SPECIES}>>"
ORDERS = f"latin_name string, family array<struct<latin_name:string,genus:array<{_GENUS}>>>"
SAMPLING_EVENTS = "checklist string, complete bigint, group_identifier string, duration_minutes double"
