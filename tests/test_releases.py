import json
import os
import re

import pytest
from pyspark.sql import functions as F

from covey.operators import planning
from covey.plans import releases

CREDIT = releases.Attribution(("First set", "Second set"), "v1", "An institute", "A town", "May 2020", "https://example.org/terms")


def test_credits():
    assert CREDIT.citation == "First set. Version: v1.\nSecond set. Version: v1.\nAn institute, A town. May 2020."
    notes = CREDIT.notes("2 packs", ["a", "b"])
    assert notes.startswith("2 packs\n\n- a\n- b\n\n") and CREDIT.citation in notes and notes.endswith("Terms of use: https://example.org/terms\n")
    assert CREDIT.citation in CREDIT.credits(["Filtered"])


@pytest.fixture
def packs(spark, tmp_path):
    rows = []
    for k in range(5):
        path = tmp_path / f"r{k}.db.gz"
        path.write_bytes(b"x" * (k + 1))
        rows.append((f"pack-bundle-00{k // 2 + 1}-v", f"r{k}", str(path)))
    return spark.createDataFrame(rows, "release_name string, region_id string, path string")


def test_publish(spark, packs, tmp_path):
    store = releases.FolderReleases(str(tmp_path / "out"), "https://example.org/")
    dry = releases.publish(packs, store, CREDIT, dry=True)
    assert (dry.created, dry.uploaded, dry.urls) == (3, 5, {}) and not os.path.exists(store.root)
    first = releases.publish(packs, store, CREDIT)
    assert (first.created, first.present, first.uploaded, first.skipped, first.errors) == (3, 0, 5, 0, [])
    assert first.urls["r2"] == "https://example.org/pack-bundle-002-v/r2.db.gz"
    assert store.assets("pack-bundle-001-v") == {"r0.db.gz", "r1.db.gz", releases.CREDITS, "NOTES.txt"}
    again = releases.publish(packs, store, CREDIT)
    assert (again.created, again.present, again.uploaded, again.skipped, again.urls) == (0, 3, 0, 5, first.urls)
    os.remove(tmp_path / "out" / "pack-bundle-002-v" / "r3.db.gz")
    os.remove(tmp_path / "r3.db.gz")
    broken = releases.publish(packs, store, CREDIT)
    assert len(broken.errors) == 1 and broken.errors[0].startswith("pack-bundle-002-v: ") and set(broken.urls) == {"r0", "r1", "r4"}
    assert releases.publish(packs.limit(0), store, CREDIT) == releases.Published()


def test_page():
    made = releases.page("A <b> & c", {"x": "</script><b>", "n": [1, 2]})
    held = re.search(r'id="data">(.*?)</script>', made).group(1)
    assert json.loads(held) == {"x": "</script><b>", "n": [1, 2]} and "<h1>A &lt;b> &amp; c</h1>" in made


def test_download(tmp_path):
    source = tmp_path / "source.xml"
    source.write_text("<a/>")
    report = releases.download({"one.xml": source.as_uri(), "two.xml": (tmp_path / "missing").as_uri()}, str(tmp_path / "got"))
    assert report["one.xml"] == {"bytes": 4, "error": None} and report["two.xml"]["bytes"] is None and report["two.xml"]["error"]
    assert os.listdir(tmp_path / "got") == ["one.xml"]


def test_merged(spark):
    cells = [("p", f"c{k}", 3.0) for k in range(6)] + [("q", "d0", 9.0), ("q", "d1", 4.0)]
    near = [("p", f"c{k}", f"c{k + 1}") for k in range(5)] + [("q", "d1", "d0")]
    a, b = spark.createDataFrame(cells, "part string, cell string, size_mb double"), spark.createDataFrame(near, "part string, cell string, other string")
    got = {(r.part, r.cell): r.merged for r in planning.merged(a, b, 6.0, tries=3).collect()}
    assert len(got) == 8 and got["q", "d0"] != got["q", "d1"]
    sizes = {}
    for (part, cell), k in got.items():
        sizes.setdefault((part, k), []).append(cell)
    assert sorted(len(x) for (part, _), x in sizes.items() if part == "p") == [2, 2, 2]
    assert planning.merged(a.limit(0), b, 6.0).count() == 0 and planning.merged(a, b.limit(0), 6.0).groupBy("part").agg(F.max("merged")).count() == 2
