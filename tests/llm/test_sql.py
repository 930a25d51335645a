"""Queries against their SQL, on the driver's tables and on small ones with planted cases."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from covey.llm.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.01"


def planted(folder) -> str:
    """Chains of near copies, copies, shared passages, short, empty and null texts; vectors around a few directions."""
    rng = random.Random(5)
    word = lambda: rng.choice(["Árbol", "B", "c", "Dd", "e", "ff"]) + str(rng.randrange(60))
    texts = [None, "", " \t ", "One", "one", "one two", "ONE  TWO", "one two three", "ÁRBOL one two", "árbol one two"]
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 80, 120)] + [["la"] * 75]
    for _ in range(25):
        words = [word() for _ in range(rng.randrange(60, 200))]
        for _ in range(rng.randrange(1, 8)):  # each a little further from the one before
            texts.append(rng.choice((" ", "\n", "  ")).join(words))
            if rng.random() < 0.7:
                words = list(words)
                words[rng.randrange(len(words))] = word()
    texts += [" ".join([word() for _ in range(rng.randrange(40))] + rng.choice(passages) + [word() for _ in range(rng.randrange(40))]) for _ in range(60)]
    texts += texts[20:40]
    ids = rng.sample(range(10_000), len(texts))
    pd.DataFrame({"doc_id": ids, "text": texts, "lang": "en", "source": "s", "n_chars": 0}).to_parquet(f"{folder}/documents.parquet")
    gen = np.random.default_rng(6)
    centres = gen.normal(size=(30, 24))
    vectors = [list(centres[k % 30] + gen.normal(size=24) * 0.05 * (k % 7)) for k in range(400)]
    vectors += vectors[:20] + [list(2 * v) for v in np.array(vectors[20:40])] + [None, [], [0.0] * 24, [float("nan")] * 24, [None] + [1.0] * 23, [1.0, 2.0], [1.0, 2.0], [float("inf")] + [1.0] * 23]
    pd.DataFrame({"vec_id": list(gen.permutation(len(vectors))), "embedding": vectors, "label": 0}).to_parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def rows(frame: pd.DataFrame) -> list[tuple]:
    return sorted(map(tuple, frame[sorted(frame.columns)].astype(object).to_numpy().tolist()))


@pytest.mark.parametrize("name", ["op1_near_duplicates", "op4_near_vectors", "op6_repeated_passages"])
@pytest.mark.parametrize("where", ["driver", "planted"])
def test_sql(spark, tmp_path, name, where):
    data = DATA if where == "driver" else planted(tmp_path)
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    want = db.execute(SQL[name]).df()
    assert rows(QUERIES[name](spark, data).toPandas()) == rows(want)
    if where == "planted" and name != "op6_repeated_passages":
        assert 0 < (~want["kept"]).sum() < len(want)
    if where == "planted" and name == "op6_repeated_passages":
        assert 0 < (want["n_removed"] > 0).sum() < len(want)
