import hashlib
from collections import Counter

from pyspark.sql import functions as F
from test_mixing import draws
from test_neardup import brute as classes

import corpus_pipeline
from covey.llm import bpe, pii

DATA = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA).cache()
        before, after = docs.collect(), out.collect()
        kept[name] = (before, after)
        if name != "token_ids":
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        docs = out
    before, after = kept["quality"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    left = {r["doc_id"] for r in after}
    assert set(after) <= set(before)
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in left for i in good) >= 0.99 * len(good) and sum(i in left for i in bad) <= 0.05 * len(bad)
    before, after = kept["near_duplicates"]
    want = classes([r["doc_id"] for r in before], [r["text"] for r in before], 5, 80)
    assert sorted(after, key=str) == sorted((r for r in before if want[r["doc_id"]][1] == r["doc_id"]), key=str)
    before, after = kept["personal_data"]
    texts = {r["doc_id"]: r for r in after}
    assert len(after) == len(before)
    for r in before:
        assert texts[r["doc_id"]]["text"] == pii.redacted(r["text"]) and texts[r["doc_id"]]["n_chars"] == len(texts[r["doc_id"]]["text"])
        assert not pii.plain(texts[r["doc_id"]]["text"])
    before, after = kept["mixing"]
    assert Counter(r["doc_id"] for r in after) == draws(before)
    before, after = kept["token_ids"]
    enc, _ = bpe.encoder(*bpe.vocabulary(None, None))
    want = Counter((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest(), tuple(enc.encode_ordinary(r["text"]))) for r in before)
    assert Counter((r["doc_id"], r["decoded_sha256"], tuple(r["ids"])) for r in after) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in after)


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.where(F.size("ids") > 0).count() == out.count() > 0


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", None, "s", 0), (1, "", None, "s", 0), (2, "Write to a@b.example.com now and then. " * 3, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        out = table
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, "/root/testdata/sf0.001")
        out.collect()
    assert corpus_pipeline.one_of_each(spark, docs, "").count() == 3
