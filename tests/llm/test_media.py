import hashlib
import time
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from covey.llm import media

DATA = "/root/testdata/sf0.01"


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=3000))
def test_round_trip(data):
    payload = data + b"\xff" * (-len(data) % media.WIDTH or (0 if data else media.WIDTH))
    stored = media.png(payload)
    assert media.unpng(stored) == payload
    broken = bytearray(stored)
    broken[len(broken) // 2] ^= 1
    with pytest.raises(Exception):
        media.unpng(bytes(broken))


def test_query(spark):
    out = {r["doc_id"]: r for r in media.op5_media_sequences(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(out) == len(docs)
    for d in docs:
        raw = d["text"].encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        r, stored = out[d["doc_id"]], media.png(payload)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest())
        assert r["feature"] == media.feature(payload) and r["caption"] == f"document {d['doc_id']}"
        assert (r["position"], r["again_position"], r["again_caption"], r["n_elements"]) == (1, 3, "small", 5)


PAGE = "<h1>T &amp; x</h1><p>one <b>two</b><!-- <img src='sha256:no'> --><figure><img src='sha256:ab' alt='z'><figcaption>the <i>cap</i></figcaption></figure>tail<img alt=q src=sha256:cd><script>'<p>'</script>"


def test_elements_stay_in_order():
    found = [(e["position"], e["kind"], e["text"] or e["digest"], e["caption"]) for e in media.elements(PAGE)]
    assert found == [(0, "text", "T & x", None), (1, "text", "one two", None), (2, "media", "ab", "the cap"), (3, "text", "tail", None), (4, "media", "cd", "q")]


def seen(page):
    return [(e["text"] or e["digest"], e["caption"]) for e in media.elements(page)]


def test_captions():
    img = "<img src='sha256:{}'>"
    assert seen(f"<figure><figcaption>first</figcaption>{img.format('a')}</figure>tail") == [("a", "first"), ("tail", None)]
    assert seen(f"</figure>x<figure>{img.format('a')}<figcaption>cap</figcaption></figure>") == [("x", None), ("a", "cap")]
    assert seen(f"<figure>{img.format('a')}<figcaption>open <p>cap</figure><p>one</p><p>two</p>") == [("a", "open cap"), ("one", None), ("two", None)]
    assert seen(f"<figure>{img.format('a')}<figcaption>to the <b>end") == [("a", "to the end")]
    assert seen(f"<figure>{img.format('a')}{img.format('b')}<figcaption>both</figcaption></figure>") == [("a", "both"), ("b", "both")]
    assert seen(f"<figure><figure>{img.format('a')}<figcaption>inner</figcaption></figure>{img.format('b')}<figcaption>outer</figcaption></figure>") == [("a", "inner"), ("b", "outer")]
    assert seen("<figure>words<figcaption>of no image</figcaption></figure>more") == [("words", None), ("of no image", None), ("more", None)]
    assert seen("<figcaption>no figure</figcaption><p>x</p>") == [("no figure", None), ("x", None)]
    assert seen(f"<p>a<!-- open {img.format('a')}") == [("a", None)] and seen("a<script>b") == [("a", None)]


@pytest.mark.parametrize("page", ["<!--" * 250_000, '<a "' * 250_000, "<a '\"" * 200_000, "<script>" * 120_000, "<figure>" * 120_000, "</figure>" * 110_000, "<figcaption>x" * 80_000, "<figure><figcaption>x" * 50_000, "<" * 1_000_000, "<img src='sha256:a'" * 50_000])
def test_time_grows_with_the_page(page):
    began = time.process_time()
    media.elements(page)
    assert time.process_time() - began < 8


def test_resolve(spark):
    payloads = spark.createDataFrame([("ab", b"\x01" * 576), ("ab", b"\x01" * 576), ("ee", None)], "digest string, payload binary")
    pages = spark.createDataFrame([(1, PAGE, 7), (1, PAGE, 7), (2, None, 8), (None, "", 9), (3, "<p>" + "w " * 100_000, 1)], "page_id long, html string, media int")
    rows = media.resolve(media.parse(pages), media.take(media.put(payloads))).collect()
    assert sorted(str(r["page_id"]) for r in rows) == ["1", "1", "2", "3", "None"]
    one = next(r for r in rows if r["page_id"] == 1)
    assert [e["position"] for e in one["elements"]] == [0, 1, 2, 3, 4] and one["media"] == 7
    assert one["elements"][2]["media"]["payload_bytes"] == 576 and one["elements"][2]["caption"] == "the cap"
    assert one["elements"][4]["media"] is None and one["elements"][4]["digest"] == "cd"
    assert all(not r["elements"] for r in rows if r["page_id"] in (2, None))
    assert media.resolve(media.parse(pages.limit(0)), media.take(media.put(payloads))).count() == 0
