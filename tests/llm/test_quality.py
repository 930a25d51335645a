import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from covey.llm import quality

DATA = "/root/testdata/sf0.01"


def test_features_by_hand():
    texts = ["Ab ab\nab ab", None, "", "ÉÀ ß! 12", "a | b\na | b\nc"]
    got = dict(zip(quality.FEATURES, quality.features(pa.array(texts)).T, strict=True))
    assert got["types"][0] == pytest.approx(np.log1p(1) / np.log1p(4)) and got["types"][4] == pytest.approx(np.log1p(4) / np.log1p(7))
    assert got["lines"].tolist() == pytest.approx([0.5, 0, 0, 0, 1 / 3])
    assert got["symbols"].tolist() == pytest.approx([0, 0, 0, 1 / 3, 0]) and got["bars"][4] == pytest.approx(2 / 7)
    assert got["upper"][3] == pytest.approx(2 / len("ÉÀ ß! 12".encode())) and got["digits"][3] == pytest.approx(2 / 11)
    assert got["repeats"].tolist() == pytest.approx([1 - 1 / 3, 0, 0, 0, 1 - 4 / 6])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels.where("doc_id % 3 <> 0"))
    scored = quality.evidence(quality.sited(docs), model)
    rows = quality.judge(scored, quality.posteriors(scored, model["share"])).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in rows]) >= 0.97
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert np.mean(good) >= 0.99


def brute(rows, share):
    """Host and path posteriors of (host, path, evidence) rows, site by site."""
    p = [1 / (1 + np.exp(-(e + np.log(share / (1 - share))))) for _, _, e in rows]
    mean, hosts, paths = np.mean(p), {}, {}
    for (h, q, _), x in zip(rows, p):
        hosts.setdefault(h, []).append(x)
        paths.setdefault((h, q), []).append(x)
    weigh = lambda noise, between: max(quality.PRIOR, min(1e6, noise / between - 1 if between > 1e-9 else 1e6))
    weight = weigh(mean * (1 - mean), np.mean([(np.mean(v) - mean) ** 2 - mean * (1 - mean) / len(v) for v in hosts.values()]))
    inner = [(np.mean(hosts[h]), v) for (h, _), v in paths.items() if sum(k[0] == h for k in paths) > 1]
    path_weight = weigh(np.mean([m * (1 - m) for m, _ in inner]), np.mean([(np.mean(v) - m) ** 2 - m * (1 - m) / len(v) for m, v in inner])) if inner else 1e6
    host = {h: (sum(v) + weight * mean) / (len(v) + weight) for h, v in hosts.items()}
    return host, {(h, q): (sum(v) + path_weight * host[h]) / (len(v) + path_weight) for (h, q), v in paths.items()}, (weight, path_weight)


@pytest.mark.parametrize("apart", [0.0, 4.0])
def test_posteriors_by_hand(spark, apart):
    share, rng = 0.8, np.random.default_rng(5)
    sites = (("a", "x", 60, 2), ("a", "y", 80, 2 - apart), ("b", None, 40, -3), ("b", "w", 30, -3 + apart), (None, "x", 1, 0), ("c", "z", 25, 1))
    rows = [(h, p, float(e)) for h, p, n, m in sites for e in rng.normal(m, 1, n)]
    df = spark.createDataFrame(rows, "_covey_host string, _covey_path string, evidence double")
    host, path, (weight, path_weight) = brute(rows, share)
    assert (path_weight > 100) == (apart == 0)  # paths that differ are shrunk less
    for r in quality.posteriors(df, share).collect():
        assert r["host_posterior"] == pytest.approx(host[r["_covey_host"]])
        assert r["path_posterior"] == pytest.approx(path[r["_covey_host"], r["_covey_path"]])
    judged = quality.judge(df, quality.posteriors(df, share)).collect()
    joined = quality.judge(df, quality.posteriors(df, share), max_broadcast=0).collect()
    assert len(judged) == len(rows) == len(joined)
    assert sorted(map(repr, judged)) == sorted(map(repr, joined))


def test_query(spark):
    """The query against site by site arithmetic on its evidence, and the evidence against the classifier on each text alone."""
    out = {r["doc_id"]: r for r in quality.op10_site_quality(spark, DATA).collect()}
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels)
    rows = docs.collect()
    assert len(out) == len(rows)
    host, path, _ = brute([(r["source"], r["lang"], out[r["doc_id"]]["evidence"]) for r in rows], model["share"])
    centre, scale, beta = model["weights"]
    for r in rows:
        got, site = out[r["doc_id"]], (r["source"], r["lang"])
        z = (quality.expanded(quality.features(pa.array([r["text"]]))) - centre) / scale
        assert got["evidence"] == pytest.approx(float(np.clip(z @ beta[:-1] + beta[-1], -20, 20)[0] - quality.logit(model["share"])))
        assert (got["host"], got["path"]) == site and got["path_posterior"] == pytest.approx(path[site]) and got["host_posterior"] == pytest.approx(host[site[0]])
        odds = got["evidence"] + np.log(path[site] / (1 - path[site]))
        assert got["quality_score"] == pytest.approx(1 / (1 + np.exp(-odds))) and got["kept"] == (got["quality_score"] >= quality.THRESHOLD)


def test_odd_rows(spark):
    rows = [Row(doc_id=1, text=None, lang=None, source=None, kept="x"), Row(doc_id=None, text="", lang="en", source="s", kept=None), Row(doc_id=3, text="One two three. " * 20000, lang="en", source="s", kept=None)]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string, source string, kept string")
    labels = spark.createDataFrame([(1, None), (3, 1)], "doc_id long, quality int")
    model = quality.learn(df, labels)
    assert model["weights"] is None
    scored = quality.evidence(quality.sited(df), model)
    got = quality.judge(scored, quality.posteriors(scored, 0.5)).collect()
    assert len(got) == 6 and {r["evidence"] for r in got} == {0.0}
    assert quality.keep_good(df.select("doc_id", "text", "lang", "source"), labels).count() == 6
    empty = df.limit(0)
    assert quality.keep_good(empty, labels).count() == 0
    trained = quality.learn(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"))
    assert quality.evidence(df, trained).where(F.isnan("evidence")).count() == 0
