import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from covey.llm import language

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = language.op2_language_id(spark, DATA).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("block", [language.BLOCK, 7, 2])
def test_code_lengths_by_hand(spark, monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK", block)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 40")
    model = language.learn(docs)
    seen = [[Counter() for _ in range(4)] for _ in model[0]]
    for lang, gram, n in zip(*model[1:]):
        b = [int(gram) >> s & 255 for s in (24, 16, 8, 0)]
        for k in range(4):
            seen[lang][k][tuple(b[3 - k : 3]), b[3]] += n

    def chance(lang, context, b):
        after = {y: n for (c, y), n in seen[lang][len(context)].items() if c == context}
        below = chance(lang, context[1:], b) if context else 1 / 257
        if not after:
            return below
        total = sum(after.values()) + len(after)
        return after[b] / total if b in after else len(after) / total * below

    texts = ["The quick ßé zz\x01", "la", "", "日"]
    found = language.Trees(*model).code_lengths(pa.array(texts))
    for text, row in zip(texts, found):
        b = [10, 10, 10, *text.encode()]
        for lang in range(len(model[0])):
            assert row[lang] == pytest.approx(-sum(math.log(chance(lang, tuple(b[k - 3 : k]), b[k])) for k in range(3, len(b))), abs=1e-3)


def test_grams(spark):
    """Counts of bytes with the three before them, line feeds standing before a text and after it."""
    docs = spark.createDataFrame([(1, "abab", "x"), (2, "ab", "x"), (3, "é", "y"), (4, "no", None), (5, None, "x"), (None, "no", "x")], "doc_id long, text string, lang string")
    langs, lang, gram, n = language.learn(docs)
    want = Counter()
    for text, name in (("abab", "x"), ("ab", "x"), ("é", "y")):
        b = b"\n\n\n" + text.encode() + b"\n"
        want.update((name, b[k : k + 4]) for k in range(len(b) - 3))
    assert {(langs[a], int(g).to_bytes(4, "big")): c for a, g, c in zip(lang, gram, n)} == dict(want)


@pytest.mark.parametrize("large", [0, 8, 1000])
def test_sample(spark, monkeypatch, large):
    """The same sample whether languages count as large or not, and all rows have their chance."""
    monkeypatch.setattr(language, "HOT", large)
    rows = [(k, "ab" * 50, "x" if k % 3 else "y") for k in range(600)] + [(k, "cd", f"z{k}") for k in range(600, 640)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, lang, gram, n = language.learn(df, sample=5000)
    texts = n[gram == int.from_bytes(b"\n\n\na", "big")]
    assert len(langs) == 42 and len(texts) == 2 and all(30 <= x <= 75 for x in texts)
    assert n[gram == int.from_bytes(b"\n\n\nc", "big")].tolist() == [1.0] * 40
    found = dict(zip(zip(lang.tolist(), gram.tolist()), n.tolist()))
    assert found == test_sample.__dict__.setdefault("found", found)


def test_letters():
    assert [language.has_letter(x) for x in (None, "", "12 _!", "²½Ⅷ", "² é", "日", "a")] == [False, False, False, False, True, True, True]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", "x"), (2, "", "en", "x"), (3, "12 !?", "en", "x"), (None, "the and the", None, "x"), (5, "the " * 100_000, "en", "x"), (5, "der die das", "de", "x")], "doc_id long, text string, lang string, score string")
    out = language.predict(docs, language.learn(docs)).collect()
    assert [r["lang_pred"] for r in out if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert {r["lang_pred"] for r in out if r["doc_id"] not in (1, 2, 3)} == {"en", "de"} and len(out) == 6
    assert language.predict(docs.limit(0), language.learn(docs.limit(0))).count() == 0
    assert {r["lang_pred"] for r in language.predict(docs, language.learn(docs.limit(0))).collect()} == {"und"}


def test_many_languages(spark):
    """Hundreds of them give a result, and tables of their own give the same code lengths as one set."""
    import random

    rng = random.Random(3)
    words = {k: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéüñ") for _ in range(rng.randrange(2, 7))) for _ in range(30)] for k in range(450)}
    rows = [(1000 * k + j, f"l{k:03d}", " ".join(rng.choice(words[k]) for _ in range(60))) for k in range(450) for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    model = language.learn(df)
    assert len(model[0]) == 450
    texts = pa.array([r[2] for r in rows[:40]] + [None, "", "zzz \u4e2d"])
    apart, whole = language.Forest(*model, most=1 << 20), language.Forest(*model, most=1 << 40)
    assert apart.all is None and whole.all is not None
    assert np.allclose(apart.code_lengths(texts), whole.code_lengths(texts), rtol=1e-5) and len(apart.held) < 450
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(df, model).select("doc_id", "lang_pred").collect()}
    assert sum(found[r[0]] == r[1] for r in rows) > 0.95 * len(rows)
