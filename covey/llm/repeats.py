"""Removal of passages that repeat across documents, by recompression.

Each text is a sequence of words. Rounds rewrite all sequences alike: a run of one symbol becomes symbols
for blocks of it, then, symbols being split by a hash of the round into left and right ones, each left
symbol followed by a right one becomes a symbol for the pair. A symbol's name is a hash of what it stands
for, so that names are global without a dictionary: equal passages get equal symbols, but for a few at
either end, where the neighbours differ. A symbol of TILE words or more, a tile, is rewritten no more;
after ROUNDS rounds hardly any two neighbours are shorter. The topmost symbols, anchors, are each two
tiles that follow each other. Every window of WINDOW words holds several, of which those inside are the
same wherever its words occur.

1. Rounds name the anchors of all texts. Documents with the same sequence of words are one, that with the
   smallest id, from here on; all the others' words go.
2. Anchors that more than one document has are found by one aggregation, and met with the documents again.
3. Windows that hold such an anchor are named by two hashes; one aggregation finds the smallest id for each
   name, which verifies the repeat word by word, and windows of larger ids are marked.
4. Words under a marked window go.

Hashes that name a window have 96 bits, those that name a sequence 128. A passage of just WINDOW words all
of whose anchors reach into what surrounds it would be overlooked: of 30,000 random ones in random
surroundings, none had fewer than two anchors that were the same (17 had two), and longer ones have more.

Defined results: a null text has no words; a document of fewer than WINDOW words loses none; a row without
an id is left whole and isn't compared; rows that share an id don't count as a smaller one; an empty table
gives an empty table; columns beside the id and the text don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..storage import runtime_filters, stored
from .words import Words, mixed, powers, row_sums, sliced

WINDOW, TILE, ROUNDS = 50, 5, 16
_P = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
_C = [np.uint64(x) for x in _P]


def tiles(hashes: np.ndarray, rows: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first word, words) of each tile; rows: the bounds of each sequence in hashes."""
    name, size = hashes.copy(), np.ones(len(hashes), np.int64)
    start = np.arange(len(hashes))
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    for k in range(ROUNDS):
        if len(name) < 2:
            break
        # Runs: blocks of as many equal symbols as make a tile, and what is left of the run.
        short = size < tile
        same = np.concatenate([[False], (name[1:] == name[:-1]) & (row[1:] == row[:-1]) & short[1:]])
        if same.any():
            here = np.arange(len(name))
            place = here - np.maximum.accumulate(np.where(same, 0, here))
            first = np.flatnonzero(~same | (place % -(-tile // size) == 0))
            count = np.diff(np.append(first, len(name)))
            name = np.where(count > 1, mixed(name[first] * _C[0] + count.astype(np.uint64)), name[first])
            size, start, row = size[first] * count, start[first], row[first]
            short = size < tile
        # Pairs: a left symbol and a right one after it.
        right = mixed(name + np.uint64(_P[1] * (k + 1) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(63) == 1
        near = short[:-1] & short[1:] & (row[:-1] == row[1:])
        if not near.any():  # the only end before the last round that all texts agree on
            break
        pair = np.flatnonzero(near & ~right[:-1] & right[1:])
        if len(pair):
            name[pair] = mixed(name[pair] * _C[2] + mixed(name[pair + 1] + _C[3]))
            size[pair] += size[pair + 1]
            keep = np.ones(len(name), bool)
            keep[pair + 1] = False
            name, size, start, row = name[keep], size[keep], start[keep], row[keep]
    whole = size >= tile
    return name[whole], start[whole], size[whole]


def anchors(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first word, words) of the topmost symbols: each two tiles that follow each other in a sequence."""
    name, start, size = tiles(hashes, rows)
    row = np.searchsorted(rows, start, "right")
    pair = np.flatnonzero(row[1:] == row[:-1])
    both = mixed(name[pair] * _C[1] + mixed(name[pair + 1] ^ _C[4]))
    return both, start[pair], start[pair + 1] + size[pair + 1] - start[pair]


def window_names(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes, of 64 and 32 bits, of the words from each word on that fill a window."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    out = []
    for base, values in ((_P[0], hashes), (_P[4], mixed(hashes ^ _C[1]))):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(base, len(values)), dtype=np.uint64)])
        out.append(mixed((sums[window:] - sums[:-window]) * powers(pow(base, -1, 1 << 64), n)))
    return out[0].view(np.int64), (out[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sequence_names(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each row's sequence of words."""
    place = (np.arange(len(w)) - np.repeat(w.rows[:-1], np.diff(w.rows))).astype(np.uint64)
    count = np.diff(w.rows).astype(np.uint64)
    a = row_sums(mixed(w.hash * _C[1] + place * _C[0]), w.rows)
    b = row_sums(mixed(mixed(w.hash + _C[4]) + place * _C[3]), w.rows)
    return mixed(a + count).view(np.int64), mixed(b ^ count).view(np.int64)


def _words(w: Words, k: int) -> list[bytes]:
    return w.bytes[w.starts[k] : w.starts[k + 1]].tobytes().split()


def read(df: DataFrame, text: str, key: str, window: int) -> DataFrame:
    """For each row its words' count and digest, the names of its sequence, and its tiles' names."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch, "_text"):
                w = Words(part.column("_text"), lower=False)
                s1, s2 = sequence_names(w)
                name, start, _ = anchors(w.hash, w.rows)
                at = np.searchsorted(start, w.rows)
                long = np.diff(w.rows) >= window
                own = [np.unique(name[a:b]).view(np.int64) if some else [] for a, b, some in zip(at[:-1], at[1:], long, strict=True)]
                digests = [hashlib.sha256(b" ".join(_words(w, k))).hexdigest() for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(w.rows).astype(np.int64)), pa.array(digests, pa.string()), pa.array(s1), pa.array(s2), pa.array(own, pa.list_(pa.int64()))],
                    ["doc_id", "n_words", "whole_sha256", "s1", "s2", "tiles"],
                )

    source = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return source.mapInArrow(run, "doc_id long, n_words long, whole_sha256 string, s1 long, s2 long, tiles array<long>")


def candidates(df: DataFrame, facts: DataFrame, firsts: DataFrame, text: str, key: str) -> DataFrame:
    """(doc_id, the text, the names of its tiles that come twice) of first documents with such tiles.

    A tile that only copies of one sequence have counts as well, which costs some windows and changes nothing."""
    named = facts.select("doc_id", F.explode("tiles").alias("tile"))
    shared = named.groupBy("tile").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("tile")
    held = named.join(shared, "tile").groupBy("doc_id").agg(F.collect_set("tile").alias("tiles"))
    held = stored(held.join(firsts.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("_n", F.size("tiles")), "shared-tiles")
    texts = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    with runtime_filters(df.sparkSession):
        return stored(texts.join(held.where("_n > 0").drop("_n"), "doc_id"), "shared-texts")


def windows(found: DataFrame, window: int) -> DataFrame:
    """(h1, h2, doc_id, place) of the windows that hold a shared tile."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch, "_text"):
                w = Words(part.column("_text"), lower=False)
                known = part.column("tiles")
                name, start, size = anchors(w.hash, w.rows)
                at = np.searchsorted(start, w.rows)
                ids = np.asarray(part.column("doc_id"))
                for k in range(part.num_rows):
                    a, b = w.rows[k], w.rows[k + 1]
                    if b - a < window:
                        continue
                    x, y = at[k], at[k + 1]
                    hit = np.isin(name[x:y].view(np.int64), known[k].values.to_numpy())
                    low = np.maximum(start[x:y][hit] + size[x:y][hit] - window, a) - a
                    high = np.minimum(start[x:y][hit], b - window) - a
                    some = low <= high
                    edge = np.zeros(b - a + 2, np.int64)
                    np.add.at(edge, low[some], 1)
                    np.add.at(edge, high[some] + 1, -1)
                    place = np.flatnonzero(np.cumsum(edge) > 0)
                    if len(place):
                        h1, h2 = window_names(w.hash[a:b], window)
                        yield pa.RecordBatch.from_arrays([pa.array(h1[place]), pa.array(h2[place]), pa.array(np.full(len(place), ids[k])), pa.array(place.astype(np.int32))], ["h1", "h2", "doc_id", "place"])

    return found.select("doc_id", "tiles", "_text").mapInArrow(run, "h1 long, h2 int, doc_id long, place int")


def cut(found: DataFrame, marked: DataFrame, window: int) -> DataFrame:
    """(doc_id, s1, s2, n_removed, kept text) of documents with marked windows (doc_id, array of place and h1).

    A mark holds for that text of its id whose window has its name."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch, "_text"):
                w = Words(part.column("_text"), lower=False)
                s1, s2 = sequence_names(w)
                removed, kept = [], []
                for k in range(part.num_rows):
                    a, b = w.rows[k], w.rows[k + 1]
                    h1, _ = window_names(w.hash[a:b], window)
                    marks = part.column("marks")[k].values
                    places, names = marks.field("place").to_numpy(), marks.field("h1").to_numpy()
                    own = places < len(h1)
                    own[own] = h1[places[own]] == names[own]
                    edge = np.zeros(b - a + 1, np.int64)
                    np.add.at(edge, places[own], 1)
                    np.add.at(edge, places[own] + window, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed.append(int(gone.sum()))
                    kept.append(b" ".join([x for x, g in zip(_words(w, k), gone.tolist(), strict=True) if not g]).decode())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s1), pa.array(s2), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "s1", "s2", "n_removed", "kept_text"])

    joined = found.select("doc_id", "_text").join(marked, "doc_id")
    return joined.mapInArrow(run, "doc_id long, s1 long, s2 long, n_removed long, kept_text string")


def repeated_passages(df: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(facts of all rows: doc_id, n_words, whole_sha256, s1, s2; changes: doc_id, s1, s2, n_removed, kept_text).

    Rows without a change keep all their words. One change serves all rows of its doc_id, s1 and s2."""
    facts = stored(read(df, text, key, window), "sequences")
    compared = facts.where(f"n_words >= {window} AND doc_id IS NOT NULL")
    groups = stored(compared.groupBy("s1", "s2").agg(F.min("doc_id").alias("first")), "first-of-sequences")
    found = candidates(df, compared, groups.select(F.col("first").alias("doc_id")), text, key)
    named = windows(found, window)
    least = named.groupBy("h1", "h2").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most")).where("_least < _most")
    # Stored, so that either side of the join is dealt out alone, and what one passage has most of can be split.
    least = stored(least.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "_least"), "repeated-windows")
    later = named.join(least, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).where("doc_id > _least")
    marked = later.groupBy("doc_id").agg(F.collect_list(F.struct("place", "h1")).alias("marks"))
    marked = stored(marked.withColumn("_n", F.size("marks")), "marks").where("_n > 0").drop("_n")
    with runtime_filters(df.sparkSession):
        changes = stored(cut(found, marked, window), "changes").where("n_removed > 0")
    again = facts.drop("tiles").join(groups, ["s1", "s2"]).where("doc_id > first")
    again = again.select("doc_id", "s1", "s2", F.col("n_words").alias("n_removed"), F.lit("").alias("kept_text"))
    # Dealt out anew, so that the join may split the copies of a sequence that very many documents have.
    again = again.repartition("doc_id", "s1", "s2").dropDuplicates(["doc_id", "s1", "s2"])
    return facts.drop("tiles"), changes.dropDuplicates(["doc_id", "s1", "s2"]).unionByName(again)


def op6_repeated_passages(spark, sf_dir: str) -> DataFrame:
    facts, changes = repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    changes = changes.select("doc_id", "s1", "s2", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("_sha"))
    met = facts.join(changes, ["doc_id", "s1", "s2"], "left")
    return met.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("_sha", "whole_sha256").alias("kept_sha256"))


# All windows, named by their words.
OP6_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS place, unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS name FROM words WHERE len(w) >= 50),
first AS (SELECT name, min(doc_id) AS least FROM windows GROUP BY name HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, place + k AS place FROM windows JOIN first USING (name), (SELECT unnest(range(50)) AS k) WHERE doc_id > least),
removed AS (SELECT doc_id, count(*) AS n, list(place) AS places FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM words LEFT JOIN removed USING (doc_id)
"""
