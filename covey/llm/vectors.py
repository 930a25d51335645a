"""Near-duplicate embeddings by sorted projection passes.

Equal vectors are one point from the start, with a count. In each pass every point gets a key of 62 bits,
which are the signs of its products with random directions of that pass. Points are ordered by these keys
and dealt out by ranges of their first bits, so that no range ends within a bucket, the points that share
the first depth() bits. Each point is compared with the next NEIGHBOURS points in order; pairs with a
cosine of at least the threshold, in double precision, are links. A bucket of more points than these is
too crowded to be met by windows: its points are strung together, whatever their cosines. The union of all
passes' links gives families. In a family all pairs are then compared, a family of more than BLOCK points
in blocks, each with each, so that its links and their counts are whole even where a family is larger than
any window of neighbours, and what was only strung together counts for nothing.

Recall: two vectors at the threshold agree in a bit with a chance of 1 - acos(threshold) / pi, 0.9 at 0.95,
and share a bucket with that to the power of depth(). A pair that shares a bucket in any pass is compared,
in a window or in a family, however many others lie around it. depth() grows with the logarithm of the
points and needed() gives as many passes as leave out a share of MISS of such pairs, at least PASSES; nearer
pairs and pairs of one family are met more often. Where many vectors lie around one direction their buckets
make one family, which costs the square of its size.

Defined results: a vector that is null, empty, of length zero, or holds a null or a number that is not
finite, is linked with nothing; vectors of different lengths are not compared; rows without an id have no
component and aren't kept, and don't count; rows that share an id and a vector count as two vectors; an
empty table gives an empty table; columns beside the id and the vector don't matter.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..storage import scratch, stored
from .linking import components, forest

PASSES, NEIGHBOURS, BLOCK, BITS = 24, 256, 4000, 62
#: Bytes of points that a partition of sorted keys should hold, which bounds a task's memory.
PART = 24 << 20
#: Buckets of vectors that are spread evenly hold about 2 ** -SPARE of a window; share of pairs at the threshold never met.
SPARE, MISS = 3, 1e-4


def depth(points: int, reach: int) -> int:
    """Bits of a key that name its bucket."""
    return min(BITS, max(0, math.ceil(math.log2(max(1, points) / reach)) + SPARE))


def needed(bits: int, threshold: float) -> int:
    """Passes after which all but MISS of the pairs at the threshold have shared a bucket of so many bits."""
    meet = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return PASSES if meet >= 1 else max(PASSES, math.ceil(math.log(MISS) / math.log1p(-meet)))


def directions(turn: int, size: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([4711, turn, size])).normal(size=(size, BITS))


def units(rows: list[bytes]) -> np.ndarray:
    """The vectors, of one length, as doubles of length one."""
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def read(df: DataFrame, vector: str, key: str) -> DataFrame:
    """(vec_id, vector as bytes of doubles scaled by a power of two, or null where it is linked with nothing)."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                out = []
                for x in part.column("_vector").to_pylist():
                    v = None if not x or any(c is None for c in x) else np.array(x, np.float64)
                    good = v is not None and np.isfinite(v).all() and (v != 0).any()
                    # Exact, and keeps squares of very large or small components in range; -0.0 becomes 0.0.
                    out.append((np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) + 0.0).tobytes() if good else None)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "vector"])

    return df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("_vector")).mapInArrow(run, "vec_id long, vector binary")


def keyed(points: DataFrame, passes: int) -> DataFrame:
    """(turn, key, point, vector) for each pass."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                ids, raw = np.asarray(part.column("point")), part.column("vector").to_pylist()
                sizes = np.array([len(x) for x in raw])
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    x = units([raw[k] for k in at])
                    for turn in range(passes):
                        signs = x @ directions(turn, x.shape[1]) > 0
                        key = signs.astype(np.int64) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), turn, np.int32)), pa.array(key), pa.array(ids[at]), part.column("vector").take(pa.array(at))],
                            ["turn", "key", "point", "vector"],
                        )

    return points.select("point", "vector").mapInArrow(run, "turn int, key long, point long, vector binary")


def neighbours(rows: DataFrame, threshold: float, reach: int, bits: int) -> DataFrame:
    """Links that hold families together: verified ones among points at most reach apart, and those along a crowded bucket.

    In a bucket of more than reach points, each from there on is tied to the one before it and the one reach
    before it; a point that neither ties is at most reach apart from all others of its bucket.
    """

    def run(batches):
        state = None

        def links(x: np.ndarray, ids: np.ndarray, bucket: np.ndarray, new: int):
            """Of the last new points with all before them in reach."""
            a, b = [], []
            for start in range(max(0, len(x) - new), len(x), reach):
                stop, low = min(start + reach, len(x)), max(0, start - reach)
                cos = x[start:stop] @ x[low:stop].T
                i, j = np.nonzero(cos >= threshold)
                i, j = i + start, j + low
                keep = (j < i) & (i - j <= reach)
                a.append(i[keep])
                b.append(j[keep])
            late = np.arange(max(reach, len(x) - new), len(x))
            late = late[bucket[late] == bucket[late - reach]]
            a += [late, late]
            b += [late - 1, late - reach]
            label = forest(len(x), np.concatenate(a), np.concatenate(b))
            far = np.flatnonzero(label != np.arange(len(x)))
            return pa.RecordBatch.from_arrays([pa.array(ids[label[far]]), pa.array(ids[far])], ["a", "b"]) if len(far) else None

        for batch in batches:
            turns, keys, ids, raw = np.asarray(batch.column("turn")), np.asarray(batch.column("key")), np.asarray(batch.column("point")), batch.column("vector").to_pylist()
            sizes = np.array([len(x) for x in raw], np.int64)
            ends = [*(np.flatnonzero((np.diff(turns) != 0) | (np.diff(sizes) != 0)) + 1), len(raw)] if raw else []
            for start, stop in zip([0, *ends], ends):
                mine = (turns[start], sizes[start])
                x, own, bucket = units(raw[start:stop]), ids[start:stop], keys[start:stop] >> (BITS - bits)
                if state is not None and state[0] == mine:
                    x, own, bucket = (np.concatenate(pair) for pair in zip(state[1:], (x, own, bucket)))
                out = links(x, own, bucket, stop - start)
                state = (mine, x[-reach:], own[-reach:], bucket[-reach:])
                if out is not None:
                    yield out

    return rows.select("turn", "key", "point", "vector").mapInArrow(run, "a long, b long")


def counted(families: DataFrame, points: DataFrame, threshold: float) -> DataFrame:
    """For each point of a family: how many vectors of other points are linked with it, and its links (as a star)."""
    size = families.groupBy("family").agg(F.count(F.lit(1)).alias("_size"))
    placed = families.join(size, "family").withColumn("_blocks", F.ceil(F.col("_size") / F.lit(BLOCK)).cast("int"))
    placed = placed.withColumn("_block", F.pmod(F.hash("point", F.lit("block")), F.col("_blocks"))).drop("_size")
    tasks = placed.join(points.select("point", "vector", "n"), "point").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    tasks = tasks.withColumns({"_i": F.least("_block", "_other"), "_j": F.greatest("_block", "_other")})

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_block", "point"])
        x, ids, n = units(list(frame["vector"])), frame["point"].to_numpy(), frame["n"].to_numpy()
        first = int((frame["_block"] == frame["_i"].iloc[0]).sum())
        across = frame["_i"].iloc[0] != frame["_j"].iloc[0]
        total, a, b = np.zeros(len(x), np.int64), [], []
        for start in range(0, len(x), 512):
            hit = x[start : start + 512] @ x.T >= threshold
            rows = np.arange(start, start + len(hit))
            hit[rows - start, rows] = False
            if across:
                hit[rows < first, :first] = False
                hit[np.ix_(rows >= first, np.arange(len(x)) >= first)] = False
            total[rows] = (hit.astype(np.float64) @ n).round().astype(np.int64)
            i, j = np.nonzero(hit)
            a.append(i + start)
            b.append(j)
        label = forest(len(x), np.concatenate(a), np.concatenate(b))
        return pd.DataFrame({"point": ids, "n_links": total, "least": ids[label]})

    return tasks.groupBy("family", "_i", "_j").applyInPandas(run, "point long, n_links long, least long")


def near_vectors(df: DataFrame, vector: str = "embedding", key: str = "vec_id", threshold: float = 0.95, passes: int | None = None, reach: int = NEIGHBOURS) -> DataFrame:
    """For each row vec_id, n_links, component_id (the smallest id reachable by links) and kept; passes are needed() unless given."""
    rows = read(df, vector, key)
    # Two hashes of 64 bits name a vector; a point has a number of its own, given once, as its table is stored.
    marked = stored(rows.withColumns({"name": F.xxhash64("vector"), "check": F.xxhash64(F.lit("check"), "vector")}), "vectors")
    known = marked.where("vector IS NOT NULL AND vec_id IS NOT NULL")
    points = known.groupBy("name", "check").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
    points = stored(points.withColumn("point", F.monotonically_increasing_id()), "points")
    total = points.agg(F.count(F.lit(1)), F.sum(F.octet_length("vector"))).first()
    bits = depth(total[0], reach)
    passes = passes or needed(bits, threshold)
    parts = max(spark_parts(df), -(-(total[1] or 0) * passes // PART))
    rows = keyed(points, passes).withColumns({"_size": F.octet_length("vector"), "_bucket": F.shiftright("key", BITS - bits)})
    ordered = rows.repartitionByRange(parts, "turn", "_size", "_bucket").sortWithinPartitions("turn", "_size", "key", "point")
    with scratch(df.sparkSession):
        families = stored(components(neighbours(ordered, threshold, reach, bits)).withColumnsRenamed({"node": "point", "component": "family"}), "families", keep=True)
    whole = stored(counted(families, points, threshold), "links")
    links = whole.groupBy("point").agg(F.sum("n_links").alias("_links"))
    linked = components(whole.select(F.col("point").alias("a"), F.col("least").alias("b")).where("a <> b")).withColumnsRenamed({"node": "point", "component": "group"})
    linked = linked.join(points.select("point", "first"), "point")
    least = linked.groupBy("group").agg(F.min("first").alias("_class"))
    classes = linked.join(least, "group").select("point", "_class")
    facts = points.select("point", "name", "check", "first", "n").join(links, "point", "left").join(classes, "point", "left")
    facts = stored(facts.select(F.col("name").alias("_name"), F.col("check").alias("_check"), (F.col("n") - 1 + F.coalesce("_links", F.lit(0))).alias("_n"), F.coalesce("_class", "first").alias("_of")), "vector-classes")
    named = F.col("vector").isNotNull() & F.col("vec_id").isNotNull()
    met = marked.select("vec_id", F.when(named, F.col("name")).alias("name"), F.when(named, F.col("check")).alias("check"))
    met = met.join(facts, (F.col("name") == F.col("_name")) & (F.col("check") == F.col("_check")), "left")
    out = met.select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_of", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def spark_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def op4_near_vectors(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


# All pairs of vectors.
OP4_SQL = r"""
WITH RECURSIVE vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS MATERIALIZED (SELECT * FROM vectors WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached AS (SELECT a AS vec_id, a AS other FROM links UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a),
classes AS (SELECT vec_id, min(other) AS least FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least, vec_id) AS component_id, coalesce(least, vec_id) = vec_id AS kept
FROM vectors LEFT JOIN counts USING (vec_id) LEFT JOIN classes USING (vec_id)
"""
