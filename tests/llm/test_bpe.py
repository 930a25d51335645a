import hashlib
import random

import pytest
from pyspark.sql import Row, functions as F

from covey.llm import bpe

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder(*bpe.vocabulary(None, None))[0]


def test_query_against_the_library(spark, enc):
    out = {r["doc_id"]: r for r in bpe.op8_bpe_round_trip(spark, DATA).collect()}
    for doc_id, text in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        ids = enc.encode_ordinary(text)
        r = out[doc_id]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("chunk,overlap", [(300, 40), (64, 16), (17, 5)])
def test_chunks_give_the_same_ids(spark, enc, chunk, overlap):
    rng = random.Random(chunk)
    bits = ["word ", " two", "  ", "\n\n", "'s", "don't", "123", "4567", "é", "日本語", "!!", "...", " \t ", "x" * 90, " " * 70, " ", "🙂", "'", "'ll I'"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 200))) for _ in range(120)] + ["", None, "a" * 2000, " " * 2000, "\n \n" * 400]
    df = spark.createDataFrame([Row(doc_id=k, text=t, ids="old") for k, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = bpe.encode(df, chunk=chunk, overlap=overlap)
    found = {r["doc_id"]: r["ids"] for r in coded.collect()}
    assert found == {k: enc.encode_ordinary(t or "") for k, t in enumerate(texts)}
    back = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(coded).collect()}
    assert back == {k: (t or "").encode() for k, t in enumerate(texts)}
    trip = {r["doc_id"]: r for r in bpe.round_trip(df, chunk=chunk, overlap=overlap, keep_ids=True).collect()}
    for k, t in enumerate(texts):
        assert trip[k]["ids"] == found[k] and trip[k]["n_tokens"] == len(found[k])
        assert trip[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, found[k])).encode()).hexdigest()
        assert trip[k]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_pieces_are_parallel(spark):
    """A long text with words is cut at about each chunk's end."""
    df = spark.createDataFrame([(1, "some words here " * 2000)], "doc_id long, text string")
    _, cut = bpe.pieces(df, "text", *bpe.vocabulary(None, None), 1000, 100)
    sizes = [r["n"] for r in cut.select(F.length("_text").alias("n")).collect()]
    assert len(sizes) == 32 and max(sizes) < 1200 and sum(sizes) == 32_000


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None), (2, "x"), (2, "x")], "doc_id long, text string")
    assert bpe.round_trip(df).count() == 4 and bpe.round_trip(df.limit(0)).count() == 0
    assert [r["decoded"] for r in bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).collect()] == [b""]
