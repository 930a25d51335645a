import random

import numpy as np
import pyarrow as pa
import pytest

from covey.llm import words


@pytest.mark.parametrize("block", [words.BLOCK, 16, 3])
@pytest.mark.parametrize("lower", [False, True])
def test_words_are_those_of_the_pattern(monkeypatch, block, lower):
    monkeypatch.setattr(words, "BLOCK", block)
    rng = random.Random(1)
    texts = ["", None, " a b  c\n", "Ab ab AB zé\x0bq", "x" * 10 + "\t" + "y", "a\x1cb \xa0c"] + ["".join(rng.choice("abAé \n\t") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for column in (pa.array(texts), pa.array(texts).slice(1, 200), pa.array(texts, pa.large_string())):
        w, seen = words.Words(column, lower), {}
        for k, text in enumerate(column.to_pylist()):
            want = (text or "").encode().split()
            got = [w.bytes[w.first[j] : w.end[j]].tobytes() for j in range(w.rows[k], w.rows[k + 1])]
            assert got == want
            for j, x in zip(range(w.rows[k], w.rows[k + 1]), want, strict=True):
                x = x.lower() if lower else x
                assert seen.setdefault(x, w.hash[j]) == w.hash[j]
        assert len(set(seen.values())) == len(seen)


def test_blocks_hash_alike(monkeypatch):
    column = pa.array(["some words of a text " * 50])
    whole = words.Words(column, False).hash
    monkeypatch.setattr(words, "BLOCK", 8)
    assert (words.Words(column, False).hash == whole).all()


def test_slices():
    batch = pa.RecordBatch.from_pydict({"t": ["a" * n for n in (3, 9, 2, 2, 1, 0, 0)], "k": list(range(7))})
    parts = list(words.sliced(batch, "t", 4))
    assert [p.column("k").to_pylist() for p in parts] == [[0], [1], [2, 3], [4, 5, 6]]
    assert list(words.sliced(batch.slice(0, 0), "t")) == []


def test_row_sums():
    assert words.row_sums(np.arange(6, dtype=np.uint64), np.array([0, 2, 2, 6])).tolist() == [1, 0, 14]
