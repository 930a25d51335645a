import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row

from covey.llm import repeats
from covey.llm.words import Words

DATA = "/root/testdata/sf0.01"


def brute(ids, texts, window):
    """For each document its words' count, how many go, and the digest of the rest, by all windows."""
    words = [(t or "").encode().split() for t in texts]
    least = {}
    for i, w in zip(ids, words):
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            least[x] = min(least.get(x, i), i)
    out = {}
    for i, w in zip(ids, words):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


def got(spark, ids, texts):
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    facts, changes = repeats.repeated_passages(df)
    found = {r["doc_id"]: (r["n_words"], 0, r["whole_sha256"]) for r in facts.collect()}
    for r in changes.collect():
        found[r["doc_id"]] = (found[r["doc_id"]][0], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest())
    return found


def test_query_against_all_windows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.op6_repeated_passages(spark, DATA).collect()}
    assert found == brute([d["doc_id"] for d in docs], [d["text"] for d in docs], 50)


def test_planted_passages(spark):
    """Passages of just the window's length and more, runs, periods and copies, in random surroundings."""
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(40)] + ["é", "Zz"]
    word = lambda: rng.choice(vocabulary)
    passages = [[word() for _ in range(rng.choice((50, 50, 51, 53, 60, 90)))] for _ in range(40)]
    passages += [["la"] * 70, ["la"] * 50, ["a", "b"] * 40, ["x", "y", "z", "x", "x"] * 30, ["one"] * 3 + ["two"] * 90]
    texts = []
    for _ in range(260):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts += [word() for _ in range(rng.randrange(0, 40))] + rng.choice(passages)[rng.choice((0, 0, 0, 1)) :]
        texts.append(rng.choice((" ", "\n", " \t ")).join(parts + [word() for _ in range(rng.randrange(0, 30))]))
    texts += texts[:40] + ["", None, "short text"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    assert got(spark, ids, texts) == brute(ids, texts, 50)


def test_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(60_000))
    rows = [Row(doc_id=None, text=text, n_words="x", tile=1), Row(doc_id=4, text=text, n_words=None, tile=1), Row(doc_id=4, text=text, n_words=None, tile=1), Row(doc_id=9, text=text + " end", n_words=None, tile=2), Row(doc_id=9, text="other words", n_words=None, tile=2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, tile long")
    facts, changes = repeats.repeated_passages(df)
    assert facts.count() == 5
    assert [(r["doc_id"], r["n_removed"], r["kept_text"]) for r in changes.collect()] == [(9, 60_000, "end")]
    assert repeats.repeated_passages(df.limit(0))[0].count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=50, max_size=120), st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30))
def test_tiles_cover_and_agree(middle, before, after):
    """Tiles lie in order, have TILE words at least, and equal windows share one."""
    texts = [" ".join(map(str, x)) for x in (before + middle + after, after + middle + before)]
    w = Words(pa.array(texts), False)
    name, start, size = repeats.tiles(w.hash, w.rows)
    assert (size >= repeats.TILE).all() and (start[1:] >= start[:-1] + size[:-1]).all()
    name, start, size = repeats.anchors(w.hash, w.rows)
    assert (size >= 2 * repeats.TILE).all()
    a = set(name[start < w.rows[1]].tolist())
    assert a & set(name[start >= w.rows[1]].tolist())


def test_window_names():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, 300).astype(np.uint64)
    h1, h2 = repeats.window_names(repeats.mixed(x), 5)
    seen = {}
    for k in range(296):
        assert seen.setdefault(tuple(x[k : k + 5]), (h1[k], h2[k])) == (h1[k], h2[k])
    assert len(set(seen.values())) == len(seen)
