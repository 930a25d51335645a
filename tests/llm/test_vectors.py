import numpy as np
import pytest

from covey.llm import vectors

DATA = "/root/testdata/sf0.01"


def brute(ids, rows, threshold=0.95):
    """n_links and component of each row by all pairs."""
    good = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in rows]
    n, root = [0] * len(ids), list(range(len(ids)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for size in {len(v) for v, g in zip(rows, good) if g}:
        at = [k for k, g in enumerate(good) if g and len(rows[k]) == size]
        x = np.array([rows[k] for k in at], float)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, j in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            n[at[i]] += 1
            n[at[j]] += 1
            root[find(at[i])] = find(at[j])
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: (n[k], least[find(k)]) for k, i in enumerate(ids)}


def got(df, **how):
    out = vectors.near_vectors(df, **how).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}


@pytest.mark.parametrize("block,reach", [(vectors.BLOCK, vectors.NEIGHBOURS), (9, 4)])
def test_families_against_all_pairs(spark, monkeypatch, block, reach):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(8)
    rows = []
    for size in (64, 16):
        for _ in range(12):
            base = rng.normal(size=size)
            rows += [(base + rng.normal(size=size) * rng.choice((0.05, 0.15, 0.25))).tolist() for _ in range(rng.integers(1, 30))]
        rows += [rng.normal(size=size).tolist() for _ in range(150)]
    rows += rows[:5] * 9 + [[0.0] * 64, None, [], [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [1e300] * 64, [1e-300] * 64, [-0.0] * 63 + [1.0], [0.0] * 63 + [2.0]]
    ids = rng.permutation(len(rows)).tolist()
    df = spark.createDataFrame(list(zip(ids, rows)), "vec_id long, embedding array<double>")
    assert got(df, reach=reach, passes=40 if reach == 4 else vectors.PASSES) == brute(ids, rows)


def test_query(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.op4_near_vectors(spark, DATA).collect()}
    assert out == brute([r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_odd_rows(spark):
    rows = [(None, [1.0, 0.0], 5), (3, [1.0, 0.0], 5), (3, [1.0, 0.0], 6), (2, [2.0, 0.0], 7)]
    out = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, point int")).collect()
    assert sorted(map(tuple, out), key=str) == sorted([(None, 0, None, False), (3, 2, 2, False), (3, 2, 2, False), (2, 2, 2, True)], key=str)
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_crowded_around_one_direction(spark):
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    around = unit(np.sqrt(0.9) * unit(rng.normal(size=64)) + np.sqrt(0.1) * unit(rng.normal(size=(4000, 64))))
    beside = unit(rng.normal(size=(200, 64)))
    beside = unit(beside - (beside * around[:200]).sum(1, keepdims=True) * around[:200])
    rows = np.concatenate([around, 0.955 * around[:200] + np.sqrt(1 - 0.955**2) * beside]).tolist()
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    assert got(df, reach=16) == brute(range(len(rows)), rows)


def test_passes_grow_with_the_points():
    bits = [vectors.depth(n, vectors.NEIGHBOURS) for n in (0, 1000, 1_000_000, 1_000_000_000)]
    assert bits == sorted(bits) and vectors.needed(bits[0], 0.95) == vectors.PASSES < vectors.needed(bits[2], 0.95) < vectors.needed(bits[3], 0.95)
