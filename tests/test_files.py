import gzip
import io
import json
import sqlite3
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from covey.functions import hexagon, indexer
from covey.operators import taxonomy, verify
from covey.plans import analysis, cli, packs, state
from covey.sinks import files as sinks, reference
from covey.sources import adapters, files as sources, schemas
from covey.streaming import ingest
from test_operators import SAMPLE

PLACES = {"A": (40.0, -75.0), "B": (40.1, -75.1), "C": (41.0, -75.0)}


def dump_rows(times: int = 1) -> list[str]:
    """The ground sample as lines of the dump, by position."""
    out = []
    for k in range(times):
        for obs, taxon, cell, day, checklist, group, complete in SAMPLE:
            row = dict.fromkeys((n for n, _ in schemas.OBSERVATION_COLUMNS), "")
            row |= {"global_unique_identifier": f"{obs}-{k}", "taxon_concept_id": f"avibase-{taxon}", "scientific_name": f"Name {taxon}", "category": "species", "latitude": str(PLACES[cell][0]), "longitude": str(PLACES[cell][1]), "observation_date": day, "sampling_event_identifier": f"{checklist}-{k}", "group_identifier": "" if group == "-" else group, "all_species_reported": complete, "approved": "1", "observation_count": "X"}
            out.append("\t".join(row.values()))
    return out


@pytest.fixture
def dump(tmp_path):
    lines = ["\t".join(n for n, _ in schemas.OBSERVATION_COLUMNS), *dump_rows(8)]
    data = gzip.compress(("\n".join(lines) + "\n").encode())
    with tarfile.open(tmp_path / "dump.tar", "w") as archive:
        for name, content in (("._dump.txt.gz", b"x"), ("terms.txt", b"y"), ("dump.txt.gz", data)):
            info = tarfile.TarInfo(name)
            info.size = len(content)
            archive.addfile(info, io.BytesIO(content))
    (tmp_path / "dump.txt.gz").write_bytes(data)
    return tmp_path


def test_dumps_agree(spark, dump):
    adapters.register(spark)
    a = sources.typed(spark.read.format("observation_tar").load(str(dump / "dump.tar")))
    b = sources.observations(spark, str(dump / "dump.txt.gz"), header=True)
    assert a.count() == b.count() == 8 * len(SAMPLE)
    assert a.exceptAll(b).count() == 0 and a.schema == b.schema
    assert a.where("group_identifier IS NULL").count() == 8 * 3 and a.where("latitude IS NULL").count() == 0
    with pytest.raises(ValueError):
        adapters.dump_member(["a.csv", "x/._b.txt.gz"])


def test_dump_in_blocks():
    text = b"a\tb\tc\td\r\n\tx\n\n" + "é\t\t\tz".encode()
    for size in (1, 2, 5, 1000):
        rows = [tuple(r.values()) for lines in adapters.text_blocks(io.BytesIO(text), size) for r in adapters.split_fields(lines, ["p", "q", "r"]).to_pylist()]
        assert rows == [("a", "b", "c"), (None, "x", None), (None, None, None), ("é", None, None)]
    assert list(adapters.text_blocks(io.BytesIO(b""))) == []
    with pytest.warns(UserWarning, match="2 .txt.gz files, b.txt.gz is read"):
        assert adapters.dump_member(["._b.txt.gz", "b.txt.gz", "c.txt.gz"]) == "b.txt.gz"


def test_dirty_values_are_counted(spark, tmp_path):
    line = dump_rows()[0].split("\t")
    at = [n for n, _ in schemas.OBSERVATION_COLUMNS].index("latitude")
    (tmp_path / "x.tsv").write_text("\n".join(["\t".join(line), "\t".join([*line[:at], "north", *line[at + 1 :]]), "\t".join([*line[:at], "", *line[at + 1 :]])]))
    raw = sources.observation_text(spark, str(tmp_path / "x.tsv"))
    assert sources.rejects(raw).first()["latitude"] == 1 and sources.typed(raw).where("latitude IS NULL").count() == 2


def test_run_to_packs(spark, dump):
    run = packs.PackRun(spark, str(dump / "dump.tar"), str(dump / "run"), "2024.01", least_checklists=1, index=indexer.SquareGrid())  # one cell holds all at resolution 2
    run.go()
    assert {s for _, s, _ in run.run.table()} == {state.COMPLETED}
    registry = json.loads((dump / "run/registry.json").read_text())
    assert registry["total_regions"] == 1 and registry["regions"][0]["region_id"] == "na-east-001"
    data = gzip.decompress((dump / "run/release/na-east-001.db.gz").read_bytes())
    (dump / "pack.db").write_bytes(data)
    db = sqlite3.connect(dump / "pack.db")
    assert db.execute("SELECT count(*) FROM species_lookup").fetchone() == (5,)
    assert dict(db.execute("SELECT key, value FROM pack_metadata"))["resolutions"] == "2,4,5"
    yearly, mean = dict(db.execute("SELECT avibase_id, yearly_frequency FROM grid_species WHERE resolution = 2")), {}
    seen, totals = {}, {}
    for _, taxon, _, day, checklist, _, _ in SAMPLE:
        totals.setdefault(day[5:7], set()).add(checklist)
        seen.setdefault((taxon, day[5:7]), set()).add(checklist)
    for (taxon, month), lists in seen.items():
        mean.setdefault(f"avibase-{taxon}", []).append(len(lists) / len(totals[month]))
    assert yearly == pytest.approx({k: sum(v) / len(v) for k, v in mean.items()})
    counts = {(t, m): n for t, m, n in db.execute("SELECT avibase_id, month, checklist_count FROM grid_species_monthly WHERE resolution = 2")}
    assert counts == {(f"avibase-{t}", int(m)): 8 * len(lists) for (t, m), lists in seen.items()}  # the taxon's, not the cell's
    quality = dict(db.execute("SELECT avibase_id, quality_score FROM grid_species WHERE resolution = 2"))
    assert quality == pytest.approx({t: min(1, sum(n for (x, _), n in counts.items() if x == t) / 100) for t in yearly}) and min(quality.values()) < 1
    before = (dump / "run/state.json").read_text()
    packs.PackRun(spark, str(dump / "dump.tar"), str(dump / "run"), "2024.01", least_checklists=1).go()  # nothing is left to do
    assert (dump / "run/state.json").read_text() == before
    run.one("build")
    assert spark.read.parquet(str(dump / "run/packs")).count() == 1
    pruned = sources.parquet(spark, str(dump / "run/cells"), cells=[1])
    assert "PartitionFilters: [isnotnull(boundary_cell" in pruned._jdf.queryExecution().toString()


def test_packs_of_hexagons(spark, dump):
    """Packs hold the cells of the hexagon index unless another index is given."""
    run = packs.PackRun(spark, str(dump / "dump.txt.gz"), str(dump / "hex"), "2024.01", least_checklists=1)
    run.go()
    want = {int(hexagon.cell_of([lat], [lon], r)[0]) for lat, lon in PLACES.values() for r in (2, 4, 5)}
    rows = spark.read.parquet(str(dump / "hex/packs")).select("content").collect()
    found = set()
    for k, row in enumerate(rows):
        (dump / f"{k}.db").write_bytes(row["content"])
        found |= {x for (x,) in sqlite3.connect(dump / f"{k}.db").execute("SELECT h3_cell FROM grid_species")}
    assert found == want
    made, totals = run.size_manifest()
    manifest = json.loads(open(made).read())
    assert totals["total_cells"] == len(manifest["cells"]) == len({int(hexagon.cell_of([lat], [lon], 4)[0]) for lat, lon in PLACES.values()})
    assert sum(c["size_mb"] for c in manifest["cells"].values()) == pytest.approx(sum(r[0] for r in spark.read.parquet(str(dump / "hex/packs")).select("size_bytes").collect()) / 2**20)
    cli.main(["--dump", "x", "--folder", str(dump / "hex"), "--version", "v", "bundle"])
    assert json.loads((dump / "hex/bundles.json").read_text())["bundles"][0]["release_name"] == "pack-bundle-001-v"


def test_state(tmp_path):
    path = str(tmp_path / "state.json")
    run, done = state.Run(path, ("a", "b", "c")), []

    def fail():
        raise ValueError("no")

    actions = {"a": lambda: (done.append("a") or "out", {"rows": 1}), "b": fail, "c": lambda: (done.append("c"), {})}
    with pytest.raises(ValueError):
        run.go(actions)
    run = state.Run(path, ("a", "b", "c"))
    assert [s for _, s, _ in run.table()] == [state.COMPLETED, state.FAILED, state.PENDING] and run.next() == "b"
    assert run.steps["a"].metrics == {"rows": 1} and run.steps["a"].seconds >= 0 and run.steps["b"].error_message == "ValueError: no"
    run.skip("b")
    run.go(actions)
    assert done == ["a", "c"] and run.next() is None and run.suffix("b") == ("b", "c")
    with pytest.raises(ValueError):
        run.suffix("x")
    (tmp_path / "state.json").write_text("{broken")
    assert state.Run(path, ("a",)).next() == "a" and (tmp_path / "state.json.corrupt").exists()


def test_cli(capsys, tmp_path):
    cli.main(["--dump", "x", "--folder", str(tmp_path), "status"])
    assert "convert    pending" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["--dump", "x", "--folder", "y", "no-such-step"])


XML = """<ioclist version="15.1"><list version="15.1">
<order><latin_name>STRUTHIONIFORMES</latin_name><family><latin_name>Struthionidae</latin_name>
<genus><latin_name>Struthio</latin_name><authority>Linnaeus, 1758</authority>
<species><latin_name>camelus</latin_name><english_name> Common Ostrich </english_name><authority>Linnaeus</authority></species>
<species extinct="yes"><latin_name>antiquus</latin_name><english_name>Old Ostrich</english_name></species>
<species><latin_name>molybdophanes</latin_name><english_name>Somali Ostrich</english_name></species>
<species><latin_name>noname</latin_name></species></genus>
<genus extinct="yes"><latin_name>Gonus</latin_name><species><latin_name>x</latin_name><english_name>X</english_name></species></genus></family></order></list></ioclist>"""


def test_taxonomy(spark, tmp_path):
    (tmp_path / "list.xml").write_text(XML)
    (tmp_path / "map.csv").write_text("Scientific_name,AvibaseID,Birds_of_the_World_URL\nstruthio CAMELUS,avibase-1,nan\nStruthio camelus,avibase-2,https://x\nStruthio molybdophanes,avibase-3,\n,avibase-9,\n")
    species = taxonomy.flat_species(sources.xml_species(spark, str(tmp_path / "list.xml")))
    rows = {r["scientific_name"]: r for r in species.collect()}
    assert set(rows) == {"Struthio camelus", "Struthio molybdophanes"}
    assert rows["Struthio camelus"]["english_name"] == "Common Ostrich" and rows["Struthio molybdophanes"]["authority"] == "Linnaeus, 1758"
    assert rows["Struthio camelus"]["order_name"] == "Struthioniformes"
    ids = {r["scientific_name"]: (r["taxon_id"], r["url"]) for r in taxonomy.with_ids(species, sources.mapping(spark, str(tmp_path / "map.csv"))).collect()}
    assert ids == {"Struthio camelus": ("avibase-2", "https://x"), "Struthio molybdophanes": ("avibase-3", None)}
    assert sources.xml_version(spark, str(tmp_path / "list.xml")).first()["version"] == "15.1"


def test_worksheet(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "x.xlsx", "w") as book:
        book.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Name</t></si><si><r><t>Fr</t></r><r><t>ench</t></r></si><si><t>Merle</t></si></sst>")
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>German</t></is></c></row><row><c r="A2"><v>7</v></c><c r="C2" t="inlineStr"><is><t>Amsel</t></is></c></row><row><c r="B3" t="s"><v>2</v></c></row></sheetData></worksheet>')
    adapters.register(spark)
    wide = spark.read.format("worksheet").load(str(tmp_path / "x.xlsx"))
    assert [tuple(r) for r in wide.collect()] == [("7", None, "Amsel"), (None, "Merle", None)]
    assert wide.columns == ["Name", "French", "German"]
    assert [tuple(r) for r in taxonomy.long_names(wide.withColumnRenamed("Name", "id"), ["id"], ["French", "German"]).collect()] == [("7", "German", "Amsel"), (None, "French", "Merle")]


def test_sqlite(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "x.db")
    db.execute("CREATE TABLE species (id INTEGER, name TEXT)")
    db.executemany("INSERT INTO species VALUES (?, ?)", [(1, "a"), (2, None)])
    db.commit()
    db.close()
    adapters.register(spark)
    read = spark.read.format("sqlite_table").option("path", str(tmp_path / "x.db"))
    assert [tuple(r) for r in read.option("table", "species").load().collect()] == [("1", "a"), ("2", None)]
    assert [tuple(r) for r in read.option("query", "SELECT count(*) AS n FROM species").load().collect()] == [("2",)]


def test_reference_database(spark, tmp_path):
    species = spark.createDataFrame([("a1", "Struthio camelus", "Ostrich", "Struthioniformes", "Struthionidae", "Struthio", "camelus"), ("a2", "Rhea americana", "Rhea", "Rheiformes", "Rheidae", "Rhea", "americana")], "avibase_id string, scientific_name string, english_name string, order_name string, family string, genus string, species_epithet string")
    translations = spark.createDataFrame([("a1", "de", "Strauß"), ("a1", "fr", "Autruche")], "avibase_id string, language_code string, common_name string")
    languages_ = spark.createDataFrame([("de", "German", 1), ("fr", "French", 1)], "language_code string, language_name string, translation_count int")
    facts = spark.createDataFrame([("species_count", "2")], "key string, value string")
    path = str(tmp_path / "reference.db")
    tables = {"species": species, "translations": translations, "languages": languages_, "metadata": facts}
    assert reference.reference_database(tables, path) == {"species": 2, "translations": 2, "languages": 2, "metadata": 1}
    db = sqlite3.connect(path)
    assert db.execute("SELECT common_name FROM translations JOIN species USING (avibase_id) WHERE family = 'Struthionidae' ORDER BY 1").fetchall() == [("Autruche",), ("Strauß",)]
    assert len(db.execute("SELECT name FROM sqlite_master WHERE type = 'index' AND sql IS NOT NULL").fetchall()) == 5
    with pytest.raises(sqlite3.IntegrityError):
        reference.reference_database({"species": species.union(species)}, str(tmp_path / "twice.db"))
    assert not (tmp_path / "twice.db").exists()
    labels = species.select("avibase_id", "scientific_name").withColumn("wikidata_id", F.concat(F.lit("Q"), "avibase_id"))
    assert reference.reference_database({"species": labels}, str(tmp_path / "labels.db"), "labels")["species"] == 2


def test_analysis(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "species string, language string, name string")
    a = make([("s1", "de", "A"), ("s2", "de", "B"), ("s1", "fr", "C")])
    b = make([("s1", "de", "A"), ("s2", "de", "x"), ("s1", "es", "D")])
    c = make([("s1", "de", "A"), ("s2", "de", "B"), ("s1", "it", "E")])
    made = analysis.export({"first": a, "second": b, "third": c}, str(tmp_path / "analysis.json"))
    read = json.loads((tmp_path / "analysis.json").read_text())
    assert read["databases"]["first"] == {"species_count": 2, "translation_count": 3, "language_count": 2, "languages": {"de": 2, "fr": 1}}
    assert read["pairs"]["first-second"]["languages"] == {"shared": ["de"], "first_only": ["fr"], "second_only": ["es"]} and len(read["pairs"]) == 3
    assert (read["three_way"]["total_matches"], read["three_way"]["total_differences"]) == (1, 1) == (made["three_way"]["total_matches"], 1)
    assert read["three_way"]["difference_examples"] == [{"species": "s2", "language": "de", "agreement": "two", "first": "B", "second": "x", "third": "B"}]


def test_saved_answers(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.json").write_text(json.dumps({"results": {"bindings": [{"species": {"value": f"Q{k}"}, "label": {"value": "x"}}]}}))
    adapters.register(spark)
    rows = spark.read.format("query_service").option("answers", str(tmp_path / "*.json")).schema("species string, label string, lang string").load()
    assert sorted(map(tuple, rows.collect())) == [("Q0", "x", None), ("Q1", "x", None)]


def test_queries_for_services():
    assert "LIMIT 5" in adapters.species_query(5) and "LIMIT" not in adapters.species_query()
    assert "wd:Q1 wd:Q2" in adapters.label_query(["Q1", "Q2"], ["en"]) and '"en"' in adapters.label_query(["Q1"], ["en", "fr"])


def test_bands_and_checks(spark, tmp_path):
    text = spark.createDataFrame([tuple(v or None for v in line.split("\t")) for line in dump_rows(3)], schemas.OBSERVATION_TEXT)
    obs = sources.typed(text).withColumn("latitude", F.when(F.col("observation_date") < "2024", F.lit(90.0)).otherwise(F.col("latitude")))
    sinks.sorted_bands(obs, str(tmp_path / "bands"))
    back = spark.read.parquet(str(tmp_path / "bands"))
    assert {r["band"] for r in back.select("band").distinct().collect()} == {"lat_p080_to_p091", "lat_p040_to_p045"} and back.count() == obs.count()
    stats = verify.statistics(spark, str(tmp_path / "bands")).first()
    assert stats["n_rows"] == obs.count() and stats["bytes"] > 0
    files = [r["file"] for r in verify.file_counts(spark, str(tmp_path / "bands")).collect()]
    assert verify.schema_changes(spark, files) == {}
    for f in files:  # rows of a file are in location order
        rows = [(r[0], r[1], r[2] is None, r[2] or "", r[3], r[4], r[5]) for r in spark.read.parquet(f).select(*sinks.ORDERS["location"]).collect()]
        assert rows == sorted(rows)
    sinks.sorted_dates(obs, str(tmp_path / "dates"), [(2020, 2024, "pre_2024"), (2024, 2025, "year_2024"), (2025, 2026, "year_2025")])
    sinks.sorted_taxa(obs, str(tmp_path / "taxa"))
    for folder, order, names in (("dates", "date", {"pre_2024", "year_2024", "year_2025"}), ("taxa", "taxon", {f"avibase_T{k}" for k in range(1, 6)})):
        table = spark.read.parquet(str(tmp_path / folder))
        part = next(c for c in table.columns if c.endswith("_part"))
        assert {r[0] for r in table.select(part).distinct().collect()} == names and table.count() == obs.count()
        for f in table.inputFiles():
            rows = [tuple(r) for r in spark.read.parquet(f).select(*sinks.ORDERS[order]).collect()]
            assert rows == sorted(rows)
    with pytest.raises(ValueError):
        verify.reconciled({"a": 1, "b": 2})
    sinks.chunked(obs, str(tmp_path / "chunks"), rows=20)
    assert verify.file_counts(spark, str(tmp_path / "chunks")).agg(F.max("n_rows")).first()[0] <= 20


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([(k % 40, "A" if k % 2 else "B", f"2024-01-{k % 20 + 1:02d} 10:00:00") for k in range(80)], "checklist long, cell string, seen string").withColumn("seen", F.to_timestamp("seen"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.observation_stream(spark, str(tmp_path / "in"), rows.schema)
    unique = ingest.once_each(stream, ["checklist", "cell"], "seen", "400 days")
    ingest.write_batches(unique, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.dropDuplicates(["checklist", "cell"]).count()
    later = rows.limit(1).withColumn("seen", F.to_timestamp(F.lit("2025-01-01 00:00:00")))
    later.write.mode("append").parquet(str(tmp_path / "in"))
    effort = ingest.windowed_effort(ingest.observation_stream(spark, str(tmp_path / "in"), rows.schema, 1), "seen", "cell", "checklist")
    ingest.write_batches(effort, str(tmp_path / "effort"), str(tmp_path / "check2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "effort")).agg(F.sum("records")).first()[0] == 80
