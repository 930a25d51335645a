import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from covey.functions import geo, hexagon, indexer, scores, text
from covey.operators import comparing, lookups, observations, ordering, planning, taxonomy

# The ground sample: observation, taxon, cell, date, checklist, group, complete.
SAMPLE = [
    tuple(row.split())
    for row in """OBS101 T1 A 2023-01-15 S101 G101 1|OBS102 T2 A 2023-01-15 S101 G101 1|OBS103 T1 A 2023-12-31 S102 G102 1|OBS001 T1 A 2024-01-01 S001 G001 1
OBS002 T1 A 2024-01-01 S001 G001 1|OBS003 T2 A 2024-01-01 S001 G001 1|OBS004 T1 A 2024-01-02 S002 G002 1|OBS005 T4 A 2024-01-02 S003 - 1|OBS006 T1 A 2024-02-01 S004 G003 0
OBS007 T3 A 2024-02-01 S005 G004 1|OBS008 T1 A 2024-04-15 S006 G005 1|OBS009 T4 A 2024-04-15 S006 G005 1|OBS010 T1 A 2024-07-20 S007 G006 1|OBS011 T3 A 2024-10-10 S008 G007 1
OBS201 T1 A 2025-01-05 S201 G201 1|OBS020 T1 B 2024-01-02 S010 - 1|OBS021 T1 B 2024-01-02 S010 - 1|OBS022 T4 B 2024-04-10 S011 G008 1|OBS023 T5 B 2024-07-15 S012 G009 1
OBS030 T1 C 2024-01-01 S020 G010 1|OBS031 T1 C 2024-01-01 S020 G010 1|OBS032 T2 C 2024-10-01 S021 G011 1""".replace("\n", "|").split("|")
]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(SAMPLE, "obs string, taxon string, cell string, day string, checklist string, grp string, complete string")


def test_ground_sample(sample):
    """Ratio frequencies over complete checklists."""
    complete = sample.where("complete = '1'")
    found = {(r["cell"], r["taxon"]): (r["taxon_checklists"], r["cell_checklists"]) for r in observations.frequencies(complete, ["cell"], ["taxon"]).collect()}
    assert found == {("A", "T1"): (7, 10), ("A", "T2"): (2, 10), ("A", "T3"): (2, 10), ("A", "T4"): (2, 10), ("B", "T1"): (1, 3), ("B", "T4"): (1, 3), ("B", "T5"): (1, 3), ("C", "T1"): (1, 2), ("C", "T2"): (1, 2)}
    dated = complete.withColumns({"year": F.substring("day", 1, 4), "quarter": F.quarter(F.to_date("day"))})
    by = lambda c: {r[c]: (r["taxon_checklists"], r["cell_checklists"]) for r in observations.frequencies(dated.where("cell = 'A'"), ["cell", c], ["taxon"]).where("taxon = 'T1'").collect()}
    assert by("year") == {"2023": (2, 2), "2024": (4, 7), "2025": (1, 1)}
    assert by("quarter") == {1: (4, 6), 2: (1, 1), 3: (1, 1), 4: (1, 2)}


def test_null_keys_are_no_observation(spark):
    df = spark.createDataFrame([("A", 1, "x", "t"), (None, 1, "x", "t"), ("A", None, "y", "t"), ("A", 1, None, "t"), ("A", 1, "y", None)], "cell string, month int, checklist string, taxon string")
    assert [tuple(r) for r in observations.frequencies(df, ["cell", "month"], ["taxon"]).select("taxon_checklists", "cell_checklists").collect()] == [(1, 1)]


def test_quality_counts_the_taxon(spark):
    """A taxon on 3 of a cell's 200 checklists has 3 behind it, not 200."""
    rows = [("A", 1, f"s{k}", "often") for k in range(200)] + [("A", 1, f"s{k}", "seldom") for k in range(3)] + [("A", 2, "s900", "seldom")]
    df = spark.createDataFrame(rows, "cell string, month int, checklist string, taxon string")
    monthly = observations.frequencies(df, ["cell", "month"], ["taxon"])
    assert {(r["month"], r["taxon"]): (r["taxon_checklists"], r["cell_checklists"]) for r in monthly.collect()} == {(1, "often"): (200, 200), (1, "seldom"): (3, 200), (2, "seldom"): (1, 1)}
    yearly = {r["taxon"]: r for r in observations.yearly_mean(monthly, ["cell", "taxon"]).collect()}
    assert (yearly["seldom"]["checklists"], yearly["seldom"]["cell_checklists"], yearly["seldom"]["quality_score"]) == (4, 201, 0.04)
    assert yearly["often"]["quality_score"] == 1.0 and yearly["seldom"]["yearly_frequency"] == pytest.approx((3 / 200 + 1) / 2)


def test_multi_frequencies(spark):
    rng = random.Random(2)
    rows = [(c := rng.randrange(20), c // 4, rng.randrange(3), rng.randrange(40), rng.choice("xyz"), rng.choice("PQ")) for _ in range(600)]
    df = spark.createDataFrame(rows, "fine long, coarse long, month int, checklist int, part string, kind string")
    got = {tuple(r)[:4]: tuple(r)[4:6] for r in observations.multi_frequencies(df, {5: "fine", 2: "coarse"}, ["month"], {"part": "part", "kind": "kind"}).select("resolution", "cell", "month", "taxon", "taxon_checklists", "cell_checklists").collect()}
    seen, totals = {}, {}
    for fine, coarse, month, checklist, part, kind in rows:
        for place in ((5, fine, month), (2, coarse, month)):
            totals.setdefault(place, set()).add(checklist)
            for taxon in (f"part:{part}", f"kind:{kind}"):
                seen.setdefault((*place, taxon), set()).add(checklist)
    assert got == {k: (len(v), len(totals[k[:3]])) for k, v in seen.items()}


def test_cells_of_counts(spark):
    rows = [("A", "s1", "t1", 1.0, 2.0, True, "d1"), ("A", "s1", "t1", 3.0, 2.0, False, "d3"), ("A", "s2", "t2", 2.0, 9.0, None, "d2"), ("A", None, "t2", 2.0, 9.0, True, "d2"), (None, "s1", "t1", 0.0, 0.0, True, "d1"), ("B", "s1", None, 0.0, 0.0, True, "d1")]
    df = spark.createDataFrame(rows, "cell string, checklist string, taxon string, lat double, lon double, complete boolean, day string")
    found = {r["cell"]: tuple(r)[1:] for r in observations.discover_cells(df, "cell", "checklist", "taxon").collect()}
    assert found == {"A": (4, 2, 2, 1.0, 3.0, 2.0, 9.0), None: (1, 1, 1, 0.0, 0.0, 0.0, 0.0)}
    meta = {r["cell"]: tuple(r)[1:] for r in observations.cell_metadata(df, "cell", "checklist", F.col("complete"), "day").collect()}
    assert meta["A"] == (2, 1, 4, "d1", "d3", "sparse") and meta["B"] == (1, 1, 1, "d1", "d1", "sparse")


@pytest.mark.parametrize("most", [0, 100])
def test_rules(spark, most):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", None), (None, "x")], "p string, q string")
    rules = lambda rows: spark.createDataFrame(rows, "p string, q string")
    kept = lambda i, e: sorted(map(tuple, lookups.by_rules(df, rules(i), rules(e), ["p", "q"], most).collect()), key=str)
    assert kept([("a", None), ("a", None), (None, "x")], [("b", "x")]) == sorted([("a", "x"), ("a", "y"), (None, "x")], key=str)
    assert len(kept([(None, None)], [])) == 5 and kept([], []) == [] and kept([(None, None)], [(None, None)]) == []


def test_inserted(spark):
    rng = random.Random(6)
    rows = [(k, f"a{rng.randrange(30)}", rng.choice((None, f"b{rng.randrange(20)}")), f"c{rng.randrange(200)}") for k in range(150)]
    unique = [("a",), ("b",), ("a", "c")]
    df = spark.createDataFrame(rows, "k int, a string, b string, c string")
    want = lookups.insert_or_ignore([dict(zip("kabc", r)) for r in rows], unique)
    assert sorted(r["k"] for r in lookups.inserted(df, F.col("k"), unique).collect()) == [w["k"] for w in want]
    assert lookups.inserted(df.limit(0), F.col("k"), unique).count() == 0


def test_places(spark):
    rng = random.Random(8)
    rows = [(rng.choice((1, 1, 1, 2, None)), rng.random(), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g int, x double, k int")
    got = {r["k"]: r["place"] for r in ordering.placed(df, "g", [F.col("x"), F.col("k")]).collect()}
    for g in (1, 2, None):
        assert [got[k] for _, _, k in sorted(r for r in [(a, x, k) for a, x, k in rows] if r[0] == g)] == list(range(1, 1 + sum(a == g for a, _, _ in rows))) if g is not None else True
    assert sorted(got[k] for a, _, k in rows if a is None) == list(range(1, 1 + sum(a is None for a, _, _ in rows)))


def test_checklist_key(spark):
    df = spark.createDataFrame([("S1", "G1"), ("S2", "G1"), ("S3", ""), ("S4", None)], "checklist string, grp string")
    assert [r[0] for r in df.select(observations.checklist_key("checklist", "grp")).collect()] == ["G1", "G1", "S3", "S4"]


def test_tiers_fall_with_frequency(spark):
    df = spark.range(0, 1001).select((F.col("id") / 1000).alias("f"))
    rank = F.array_position(F.array(*map(F.lit, scores.TIERS)), scores.tier(F.col("f")))
    ranks = [r[0] for r in df.orderBy("f").select(rank).collect()]
    assert ranks == sorted(ranks, reverse=True) and set(ranks) == {1, 2, 3, 4}


HEX = {"8928308280fffff": {8: "8828308281fffff", 5: "85283083fffffff"}}


def test_hexagon_bits(spark):
    for cell, parents in HEX.items():
        df = spark.createDataFrame([(cell,)], "h string").withColumn("c", geo.from_hex(F.col("h")))
        for resolution, want in parents.items():
            assert df.select(geo.to_hex(geo.parent(F.col("c"), resolution))).first()[0] == want
    coarse = (1 << 59) | (2 << 52) | (4 << 45) | ((1 << 39) - 1)  # on a pentagon, all digits 0
    df = spark.createDataFrame([(coarse,), (coarse | (1 << 42),)], "c long")
    for (cell,), size in zip(df.collect(), (41, 49)):
        kids = df.where(F.col("c") == cell).select(F.explode(geo.children(F.col("c"), 2, 4)).alias("k"))
        assert kids.distinct().count() == size
        assert [r[0] for r in kids.select(geo.parent(F.col("k"), 2)).distinct().collect()] == [cell]
        assert [r[0] for r in kids.select(geo.resolution_of(F.col("k"))).distinct().collect()] == [4]


# Published cells of places.
CELLS = [(37.775938728915946, -122.41795063018799, 9, "8928308280fffff"), (37.3615593, -122.0553238, 7, "87283472bffffff"), (40.689167, -74.044444, 10, "8a2a1072b59ffff"), (37.769377, -122.388903, 9, "89283082e73ffff")]
CORNERS = [(37.271355866731895, -121.91508032705622), (37.353926450852256, -121.86222328902491), (37.42834118609435, -121.9235499963016), (37.42012867767778, -122.0377349642703), (37.33755608435298, -122.09042892904395), (37.26319797461824, -122.02910130919)]


def test_published_hexagons():
    for lat, lon, resolution, cell in CELLS:
        assert f"{hexagon.cell_of([lat], [lon], resolution)[0]:x}" == cell
    cell = np.array([0x85283473FFFFFFF])
    assert hexagon.centre_of(cell)[0] == pytest.approx((37.345793375368, -121.976375972551))
    assert hexagon.corners_of(cell)[0] == pytest.approx(np.array(CORNERS))
    assert hexagon.centre_of([0x8001FFFFFFFFFFF])[0] == pytest.approx((79.2423985098, 38.0234070080))
    assert hexagon.PENTAGONS == geo.PENTAGONS


def test_hexagons_cover_the_sphere():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(20_000, 3))
    near = np.repeat(hexagon.BASE_CENTRES[list(hexagon.PENTAGONS)], 500, 0) + rng.normal(size=(6000, 3)) * 0.02
    places = hexagon._degrees(np.concatenate([v, near]) / np.linalg.norm(np.concatenate([v, near]), axis=1, keepdims=True))
    for r in (0, 1, 2, 3, 4, 7, 11, 15):
        cells = hexagon.cell_of(*places.T, r)
        centres = hexagon.centre_of(cells)
        assert (hexagon.cell_of(*centres.T, r) == cells).all() and (hexagon.resolution_of(cells) == r).all()
        far = np.degrees(np.arccos(np.clip((hexagon.unit_vector(*np.radians(centres).T) * hexagon.unit_vector(*np.radians(places).T)).sum(1), -1, 1)))
        assert far.max() < 25 / 7 ** (r / 2) + 1e-5
        if r < 2:
            assert len(np.unique(cells)) == (122, 842)[r]
    for r in (1, 2, 3, 4):  # neighbours are mutual; pentagons have five
        cells = np.unique(hexagon.cell_of(*places.T, r))
        sides = {c: set(n) - {c} for c, n in zip(cells.tolist(), hexagon.beside(cells).tolist())}
        five = set(cells[hexagon.is_pentagon(cells)].tolist())
        assert all(len(n) == 6 - (c in five) for c, n in sides.items())
        assert all(c in sides[n] for c, ns in sides.items() for n in ns if n in sides)


def test_hexagon_columns(spark):
    rows = [(37.775938728915946, -122.41795063018799), (91.0, 0.0), (None, 1.0), (0.0, 179.99)]
    index = indexer.HexagonIndex()
    df = spark.createDataFrame(rows, "lat double, lon double").withColumn("c", index.cell(F.col("lat"), F.col("lon"), 3))
    lat, lon = index.centre(F.col("c"))
    got = df.select("c", lat.alias("y"), lon.alias("x"), index.ring(F.col("c"), 2).alias("disk"), index.boundary(F.col("c")).alias("ring")).collect()
    assert [r["c"] is None for r in got] == [False, True, True, False] == [r["y"] is None for r in got] == [r["disk"] is None for r in got]
    assert len(got[0]["disk"]) == 19 and len(got[0]["ring"]) == 6 and got[3]["ring"] is None and got[1]["ring"] is None


def test_square_cells(spark):
    grid, rng = indexer.SquareGrid(), random.Random(3)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (91.0, 0.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "lat double, lon double").withColumn("c", grid.cell(F.col("lat"), F.col("lon"), 6))
    assert df.where("c IS NULL").count() == 2
    lat, lon = grid.centre(F.col("c"), 6)
    back = df.where("c IS NOT NULL").select("lat", "lon", "c", grid.cell(lat, lon, 6).alias("again"), grid.parent(F.col("c"), 6, 3).alias("up"), grid.cell(F.col("lat"), F.col("lon"), 3).alias("direct"))
    assert back.where("c <> again OR up <> direct").count() == 0


PLACES = {(65, -20): "atlantic", (38, -28): "atlantic", (50, -170): "pacific", (60, -120): "na-north", (40, -110): "na-west", (40, -80): "na-east", (25, -80): "central-america", (10, -84): "central-america", (4, -70): "sa-north", (0, -70): "sa-south", (50, 10): "europe", (25, 45): "middle-east", (35, 120): "asia-east", (21, 90): "asia-south", (5, 110): "se-asia", (0, 20): "africa", (-25, 135): "oceania", (20, -158): "central-america", (-50, 10): "sub-antarctic", (-10, 50): "africa", (-20, 58): "indian", (-30, -25): "remote"}


def test_continents(spark):
    PLACES[20, -158] = "pacific"
    df = spark.createDataFrame([(float(a), float(b)) for a, b in PLACES], "lat double, lon double")
    assert {(r[0], r[1]): r[2] for r in df.select("lat", "lon", geo.continent(F.col("lat"), F.col("lon"))).collect()} == PLACES


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(0, 50), max_size=60), st.floats(1, 40))
def test_fill(sizes, most):
    chunks = planning.fill(sizes, most)
    assert chunks == sorted(chunks) and len(chunks) == len(sizes)
    for _, group in itertools.groupby(zip(chunks, sizes), key=lambda x: x[0]):
        held = [s for _, s in group]
        assert len(held) == 1 or sum(held) <= most + 1e-6


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=50))
def test_first_fit(sizes):
    sizes = sorted(sizes, reverse=True)
    at, room = planning.first_fit(sizes, 50), {}
    for size, k in zip(sizes, at):
        fitting = [j for j in sorted(room) if room[j] + size <= 50]
        assert k == (fitting[0] if fitting else len(room) + 1)
        room[k] = room.get(k, 0) + size


def test_date_partitions():
    years = [(1875, 3), (1890, 2), (1995, 200), (1996, 1), (2003, 90), (2011, 99), (2012, 2)]
    assert planning.date_partitions(years, 100) == [(1870, 1900, "pre_1900"), (1995, 1996, "year_1995"), (1996, 1997, "year_1996"), (2000, 2010, "pre_2010"), (2011, 2012, "year_2011"), (2012, 2013, "year_2012")]
    assert planning.date_partitions([(2100, 1)], 5) == [(2100, 2110, "decades_2100_2100")] and planning.date_partitions([], 5) == []


def test_merging():
    cells = {f"c{k}": float(k % 5 + 1) for k in range(30)}
    adjacent = {f"c{k}": {f"c{j}" for j in (k - 1, k + 1, k - 6, k + 6) if 0 <= j < 30} for k in range(30)}
    for groups in (planning.merge_greedily(cells, adjacent, 12), planning.merge_best_of(cells, adjacent, 12, 20)):
        assert sorted(itertools.chain(*groups)) == sorted(cells) and all(sum(cells[c] for c in g) <= 12 for g in groups)
        assert len(groups) >= planning.least_groups(cells, 12)


def test_insert_or_ignore():
    """A row that is ignored doesn't block later ones, and nulls never clash."""
    rows = [{"a": 1, "b": "x"}, {"a": 1, "b": "y"}, {"a": 2, "b": "y"}, {"a": 3, "b": None}, {"a": 4, "b": None}, {"a": 5, "b": "x"}]
    assert lookups.insert_or_ignore(rows, [("a",), ("b",)]) == [rows[0], rows[2], rows[3], rows[4]]


def test_header_columns():
    assert taxonomy.header_columns(["seq", "Name", "EN", " fr ", ""], ["Name"], {"seq"}) == {"EN": "en", " fr ": "fr"}
    with pytest.raises(ValueError):
        taxonomy.header_columns(["seq"], ["Name"], set())


def test_text(spark):
    df = spark.createDataFrame([("a1b2c3d4e5", 1536.0, 3725.9), ("", 182.625 * 1024**3, 59.0)], "x string, n double, s double")
    got = [tuple(r) for r in df.select(text.taxon_id(F.col("x")), text.human_size(F.col("n")), text.human_duration(F.col("s"))).collect()]
    assert got == [("avibase-A1B2C3D4", "1.50 KB", "1h 2m 5s"), ("", "182.62 GB", "59s")]


def test_bindings_and_fallbacks(spark):
    raw = spark.createDataFrame([('{"results":{"bindings":[{"species":{"value":"http://e/Q1"},"label":{"value":"Robin"},"lang":{"value":"en"}},{"species":{"value":"http://e/Q1"},"label":{"value":"Turdus x"}}]}}',)], "j string")
    from covey.sources import schemas

    rows = taxonomy.bindings(raw.select(F.from_json("j", schemas.BINDINGS).alias("r")).select("r.*"), ["species", "label", "lang"]).collect()
    assert [tuple(r) for r in rows] == [("http://e/Q1", "Robin", "en"), ("http://e/Q1", "Turdus x", None)]
    labels = spark.createDataFrame([("Q1", "en", "Robin"), ("Q1", "xx", "Turdus x"), ("Q1", "yy", "turdus x")], "species string, language string, name string")
    kept, counts = comparing.without_fallbacks(labels, spark.createDataFrame([("Q1", "Turdus x")], "species string, scientific_name string"))
    assert {r["language"] for r in kept.collect()} == {"en", "yy"} and counts.where("removed > 0").count() == 1
