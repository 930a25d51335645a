"""Quality classification by hierarchical empirical Bayes.

A logistic classifier on shape features of the whole text (FEATURES) gives each document's own evidence,
the log odds of being good against the share of good labels. Sites are grouped: a host, and a path in it.
Over all documents, whatever their label, the mean probability of a host is shrunk towards the global
mean by a prior worth PRIOR documents or more, and a path's mean in the same way towards its host's
posterior. The weight of each prior is estimated by moments: what the site means vary beyond what their
size explains makes the prior lighter, never below PRIOR documents; hosts are weighed by how host means
vary, paths by how the paths of a host with several of them vary around it. A document's quality is its own
evidence on top of its path's posterior odds; below THRESHOLD it is rejected.

The classifier is fitted on about SAMPLE labelled documents, chosen by a hash of their id; counts and
posteriors take all documents in. Without both kinds of labels in the sample all evidence is 0.

Defined results: a null or wordless text has features of 0 and so the evidence of an empty text; a null
host or path is a site of its own; a document with both labels counts with each; of rows that share an id
the smallest text is learned from; rows that repeat are
scored as often as they come and count so in their sites; an empty table gives an empty table; columns of
the input that are called like a result column are replaced, all others are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import stored
from .columns import others
from .words import Words, row_sums, sliced

FEATURES = ("types", "lines", "symbols", "upper", "digits", "length", "long_words", "repeats", "stops", "bars")
SAMPLE = 30_000
PRIOR = 20.0
THRESHOLD = 0.5
#: The table of sites is broadcast up to this count of sites, which is checked; beyond it, it is joined.
MAX_BROADCAST = 20_000
_CLASS = np.zeros(256, np.uint8)
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'\"()-:;?"]] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[ord("|")]] = 4
_CLASS[[ord("."), ord("?")]] = 5


def features(column: pa.Array) -> np.ndarray:
    """FEATURES of each row of texts, as shares or logarithms."""
    w = Words(column, lower=True)
    n_rows = len(w.rows) - 1
    size = np.diff(w.starts).astype(float) - 1
    words = np.diff(w.rows).astype(float)
    kinds = _CLASS[w.bytes]
    share = lambda k, of: np.add.reduceat(kinds == k, w.starts[:-1], dtype=np.int64) / np.maximum(of, 1)
    upper_letters = w.bytes == 0xC3  # accented letters: the second byte below 0xA0 is a capital
    accented = np.zeros(len(w.bytes), bool)
    accented[:-1] = upper_letters[:-1] & (w.bytes[1:] < 0x9F)
    upper = np.add.reduceat((kinds == 2) | accented, w.starts[:-1], dtype=np.int64) / np.maximum(size, 1)
    row = w.row_of()
    types, lines, repeats = np.zeros(n_rows), np.zeros(n_rows), np.zeros(n_rows)
    if len(w):
        pairs = w.hash.copy()
        pairs[:-1] += w.hash[1:] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(n_rows):
            a, b = w.rows[k], w.rows[k + 1]
            if b > a:
                types[k] = np.log1p(len(np.unique(w.hash[a:b]))) / np.log1p(b - a)
                repeats[k] = 1 - len(np.unique(pairs[a : b - 1])) / (b - a - 1) if b - a > 1 else 0
        # lines: from one line feed to the next, as sums of their words' hashes
        feeds = np.concatenate([[0], np.cumsum(w.bytes == 10)])
        line = feeds[w.first]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(line) > 0]))
        sums = row_sums(w.hash, np.append(starts, len(w)))
        of = row[starts]
        bounds = np.searchsorted(of, np.arange(n_rows + 1))
        for k in range(n_rows):
            a, b = bounds[k], bounds[k + 1]
            if b > a + 1:
                lines[k] = 1 - len(np.unique(sums[a:b])) / (b - a)
    length = np.zeros(n_rows)
    chars = (w.end - w.first).astype(float)
    long_words = np.bincount(row, chars > 14, n_rows) / np.maximum(words, 1) if len(w) else length
    mean = np.bincount(row, chars, n_rows) / np.maximum(words, 1) if len(w) else length
    out = np.stack([types, lines, np.minimum(share(1, words), 3), upper, share(3, size), np.log1p(words) / 10, long_words, repeats, np.minimum(share(5, words), 1), np.minimum(share(4, words), 1)], 1)
    out[words == 0] = 0
    out[:, 5] += np.minimum(mean, 30) / 100
    return out


def expanded(x: np.ndarray) -> np.ndarray:
    """Features with their squares, as both ends of a feature may be bad."""
    return np.concatenate([x, x * x], 1)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> tuple:
    """Centre, scale, and weights of a logistic regression by Newton's method; the intercept last."""
    x = expanded(x)
    centre, scale = x.mean(0), x.std(0) + 1e-6
    z = np.concatenate([(x - centre) / scale, np.ones((len(x), 1))], 1)
    beta = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + ridge * len(z) / 100 * np.eye(len(beta))
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge * len(z) / 100 * beta)
        beta += step * min(1, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return centre, scale, beta


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> dict:
    """The classifier, from about sample labelled documents, and the share of good ones."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).where("_key IS NOT NULL AND _label IN (0, 1)")
    share = min(1.0, sample / max(1, known.count()))
    drawn = F.pmod(F.xxhash64(F.lit("quality"), "_key"), F.lit(1 << 30)) < int((1 << 30) * share)
    known = known.where(drawn).distinct()
    few = known.limit(4 * sample + 1).count() <= 4 * sample  # about sample are expected
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(drawn)
    labelled = texts.join(F.broadcast(known) if few else known, "_key")
    labelled = labelled.groupBy("_key", "_label").agg(F.min("_text").alias("_text")).select("_text", "_label")  # no more than there are labels

    def run(batches):
        for batch in batches:
            for part in sliced(batch, "_text"):
                yield pa.RecordBatch.from_arrays([pa.array(list(features(part.column("_text"))), pa.list_(pa.float64())), part.column("_label")], ["_x", "_label"])

    rows = labelled.mapInArrow(run, "_x array<double>, _label int").toPandas()
    if rows["_label"].nunique() < 2:
        return {"weights": None, "share": 0.5}
    x, y = np.stack(rows["_x"].to_numpy()), rows["_label"].to_numpy(float)
    order = np.lexsort([*x.T, y])  # rows come in any order
    return {"weights": fit(x[order], y[order]), "share": float(np.clip(y.mean(), 0.01, 0.99))}


def logit(p):
    return np.log(p / (1 - p))


def evidence(df: DataFrame, model: dict, text: str = "text", name: str = "evidence", keep_text: bool = False) -> DataFrame:
    """df with each whole text's log odds against the share of good labels, in place of it or beside it."""
    kept = others(df, name, *([] if keep_text else [text]))
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part in sliced(batch, text):
                if model["weights"] is None:
                    score = np.zeros(part.num_rows)
                else:
                    centre, scale, beta = model["weights"]
                    z = (expanded(features(part.column(text))) - centre) / scale
                    score = np.clip(z @ beta[:-1] + beta[-1], -20, 20) - logit(model["share"])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(score)], schema.names)

    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def _expit(x) -> F.Column:
    return 1 / (1 + F.exp(-x))


def posteriors(scored: DataFrame, share: float, name: str = "evidence") -> DataFrame:
    """For each path (_covey_host, _covey_path) of scored documents: the host's and its own posterior mean."""
    p = _expit(F.col(name) + float(logit(share)))
    paths = scored.groupBy("_covey_host", "_covey_path").agg(F.count(F.lit(1)).alias("_n"), F.sum(p).alias("_s"))
    hosts = paths.groupBy("_covey_host").agg(F.sum("_n").alias("_hn"), F.sum("_s").alias("_hs"), F.count(F.lit(1)).alias("_paths"))
    total = hosts.agg(F.sum("_hn").alias("_tn"), F.sum("_hs").alias("_ts"), F.count(F.lit(1)).alias("_hosts"))
    # Variance between means, less what means of so many draws vary by themselves: of hosts around the global
    # mean, and of paths around the mean of their host.
    mean = F.col("_ts") / F.col("_tn")
    spread = hosts.crossJoin(F.broadcast(total)).agg(
        F.avg(F.pow(F.col("_hs") / F.col("_hn") - mean, 2) - mean * (1 - mean) / F.col("_hn")).alias("_between"),
        F.first(mean).alias("_mean"),
    )
    of_host = paths.join(hosts.where("_paths > 1").withColumnRenamed("_covey_host", "_h"), F.col("_covey_host").eqNullSafe(F.col("_h")))
    own, least = F.col("_hs") / F.col("_hn"), F.lit(1e-9)
    inner = of_host.agg(F.avg(F.pow(F.col("_s") / F.col("_n") - own, 2) - own * (1 - own) / F.col("_n")).alias("_within"), F.avg(own * (1 - own)).alias("_noise"))
    weighed = lambda noise, between: F.greatest(F.lit(PRIOR), F.least(F.coalesce(F.when(between > least, noise / between - 1), F.lit(1e6)), F.lit(1e6)))
    prior = spread.crossJoin(F.broadcast(inner)).select("_mean", weighed(F.col("_mean") * (1 - F.col("_mean")), F.col("_between")).alias("_weight"), weighed(F.col("_noise"), F.col("_within")).alias("_path_weight"))
    hosts = hosts.crossJoin(F.broadcast(prior)).select(F.col("_covey_host").alias("_h"), "_path_weight", ((F.col("_hs") + F.col("_weight") * F.col("_mean")) / (F.col("_hn") + F.col("_weight"))).alias("host_posterior"))
    joined = paths.join(hosts, F.col("_covey_host").eqNullSafe(F.col("_h")))
    return joined.select("_covey_host", "_covey_path", "host_posterior", ((F.col("_s") + F.col("_path_weight") * F.col("host_posterior")) / (F.col("_n") + F.col("_path_weight"))).alias("path_posterior"))


def judge(scored: DataFrame, sites: DataFrame, name: str = "evidence", threshold: float = THRESHOLD, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """scored with host_posterior, path_posterior, quality_score and kept."""
    sites = stored(sites.withColumnsRenamed({"_covey_host": "_covey_sh", "_covey_path": "_covey_sp"}), "sites")
    few = sites.select("_covey_sh").limit(max_broadcast + 1).count() <= max_broadcast
    met = scored.drop("host_posterior", "path_posterior", "quality_score", "kept")
    met = met.join(F.broadcast(sites) if few else sites, F.col("_covey_host").eqNullSafe(F.col("_covey_sh")) & F.col("_covey_path").eqNullSafe(F.col("_covey_sp")))
    odds = F.log(F.col("path_posterior") / (1 - F.col("path_posterior")))
    return met.drop("_covey_sh", "_covey_sp").withColumn("quality_score", _expit(F.col(name) + odds)).withColumn("kept", F.col("quality_score") >= threshold)


def sited(df: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    return df.withColumns({"_covey_host": F.col(host).cast("string"), "_covey_path": F.col(path).cast("string")})


def op10_site_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = learn(docs, labels)
    scored = stored(evidence(sited(docs.select("doc_id", "source", "lang", "text")), model), "evidence")
    found = judge(scored, posteriors(scored, model["share"]))
    return found.select("doc_id", F.col("_covey_host").alias("host"), F.col("_covey_path").alias("path"), "evidence", "host_posterior", "path_posterior", "quality_score", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rejected ones, in their own columns. The text is read twice, so that it never is shuffled."""
    columns = docs.columns
    model = learn(docs, labels)
    narrow = evidence(sited(docs).select("_covey_host", "_covey_path", "text"), model)
    found = judge(evidence(sited(docs), model, keep_text=True), posteriors(narrow, model["share"]))
    return found.where("kept").select(*columns)
