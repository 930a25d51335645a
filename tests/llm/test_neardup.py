import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from covey.llm import linking, neardup

DATA = "/root/testdata/sf0.01"


def sets_of(texts, k):
    out = []
    for t in texts:
        w = [x.lower() for x in (t or "").encode().split()]
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute(ids, texts, k, percent):
    """Components by all pairs that share a shingle."""
    sets, at = sets_of(texts, k), {}
    for n, s in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(n)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    shared = {}
    for rows in at.values():
        for i, a in enumerate(rows):
            for b in rows[i + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(b)] = find(a)
    least = {}
    for n, i in enumerate(ids):
        least[find(n)] = min(least.get(find(n), i), i)
    return {i: (len(sets[n]), least[find(n)]) for n, i in enumerate(ids)}


def got(df, **how):
    rows = neardup.near_duplicates(df, **how).collect()
    for r in rows:
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    rows = neardup.op1_near_duplicates(spark, DATA).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute([d["doc_id"] for d in docs], [d["text"] for d in docs], 3, 85)


@pytest.mark.parametrize("leaf,block", [(neardup.LEAF, neardup.BLOCK), (5, 7)])
def test_families(spark, monkeypatch, leaf, block):
    """Families around the threshold, with large ones in blocks and nodes that stay large."""
    monkeypatch.setattr(neardup, "LEAF", leaf)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(4)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice((20, 60, 200)))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 20))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
            texts += [" ".join(copy)] * rng.choice((1, 1, 2))
    texts += ["one", "One", "one two", "one  two\n", "", " \t", None, "zé ZÉ", "zé zé"]
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    for k, percent in ((3, 85), (5, 80)):
        assert got(df, shingle=k, percent=percent) == brute(ids, texts, k, percent)


def test_large_families(spark, monkeypatch):
    """Copies that are only linked with what they were made from, a chain, and texts that are just not alike enough."""
    monkeypatch.setattr(neardup, "BLOCK", 40)
    monkeypatch.setattr(neardup, "PIVOTS", 8)
    monkeypatch.setattr(neardup, "MANY", 1)
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**6)}"
    base, texts = [word() for _ in range(200)], []
    for _ in range(150):  # a star: each differs from the middle at three places of its own
        copy = list(base)
        for k in rng.sample(range(5, 195, 6), 3):
            copy[k] = word()
        texts.append(" ".join(copy))
    texts.insert(77, " ".join(base))
    chain = [word() for _ in range(200)]
    for k in range(100):
        chain[k * 2 % 200] = word()
        chain[(k * 2 + 97) % 200] = word()
        texts.append(" ".join(chain))
    base = [word() for _ in range(200)]
    for _ in range(100):  # apart: two of them share about 0.75
        copy = list(base)
        for k in rng.sample(range(5, 195, 6), 5):
            copy[k] = word()
        texts.append(" ".join(copy))
    ids = rng.sample(range(1000), len(texts))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    for k, percent in ((3, 85),):
        assert got(df, shingle=k, percent=percent) == brute(ids, texts, k, percent)


def test_trees_follow_the_similarity():
    assert (neardup.needed(0.85), neardup.needed(0.8)) == (10, 12) and neardup.slack(0.8) > neardup.slack(0.85)


def test_rows_that_share_an_id(spark):
    rows = [(1, "b c d e f g h", "x"), (1, "a c d e f g h", "y"), (1, "a c d e f g h", "z"), (2, "q r s t u v", None), (None, "z", "z"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _kept string")
    a, b = (sorted(map(tuple, neardup.keep_first(d).collect()), key=str) for d in (df, df.orderBy(F.desc("_kept"))))
    assert a == b and len(a) == 4 and [r[1] for r in a if r[0] == 1] == ["a c d e f g h"]


def test_odd_rows(spark):
    long = "word " * 100_000
    rows = [Row(doc_id=None, text="a b c d", point="x"), Row(doc_id=7, text=None, point=None), Row(doc_id=5, text=long, point="y"), Row(doc_id=6, text=long, point="y"), Row(doc_id=6, text="a b c d", point="y"), Row(doc_id=8, text="a b c d", point="y")]
    out = [tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, point string")).collect()]
    assert sorted(out, key=str) == sorted([(None, 1, None, False), (7, 0, 7, True), (5, 1, 5, True), (6, 1, 5, False), (6, 1, 6, True), (8, 1, 6, False)], key=str)
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_exact_links():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25)).astype(np.uint64)) for _ in range(40)]
    a, b = neardup.exact_links([len(s) for s in sets], np.concatenate(sets), 60)
    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))}
    assert set(zip(a.tolist(), b.tolist())) == want and want


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5100)]
    found = {r["node"]: r["component"] for r in linking.components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = linking.forest(6000, np.array([a for a, _ in links]), np.array([b for _, b in links]))
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: label[x] for x in touched}
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets():
    column = pa.array(["A b c d", "a B c d", "", None, "a b", "a  b "])
    made = neardup.shingle_sets(column, 3)
    assert [len(s) for s in made] == [2, 2, 0, 0, 1, 1]
    assert (made[0] == made[1]).all() and (made[4] == made[5]).all()
