"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct shingles of SHINGLE words. Equal sets are one point from the start.

1. Each set is embedded as TOKENS minwise tokens: for each of as many hash functions, the smallest hash
   of its shingles, cut to 16 bits. The share of equal tokens of two sets estimates their similarity.
2. Independent trees branch the points: at a node, one coordinate is chosen by the node's hash, and
   a second one so often that 1 / similarity are chosen on average; a point goes on to the child that its
   token at a chosen coordinate names. Similar points share a path of any length with good chances, others
   hardly ever. The first DEPTH levels need no look at others, so each point names its nodes of that level
   at once. Nodes with one point end there. Nodes with more than LEAF points go on branching, up to
   the level deepest(), which grows with the logarithm of the points.
3. In a small node all pairs of embeddings are compared; those whose share of equal tokens is up to SPREAD
   deviations below the similarity are candidates. A node still large at the deepest level has points that agree
   at that many chosen tokens; all of them are candidates with its first point. Candidates hang
   together in families, the components of these links.
4. Families are verified by exact sizes of intersections of full sets. All pairs are compared in a family of
   up to MANY blocks of BLOCK points, each block with each, so that a set moves MANY times at most. A larger
   one is first met with pivots, block by block, in rounds: points that were
   linked most often before, and some by chance of those that stand apart. As long as a round gathers more of
   the family's points in its largest component, another follows; then the points outside of that component
   are compared with all of the family's, block by block. Pairs inside of it need no look, as they change no
   class. So a family whose points hang together costs a few times its points, and only what stays apart
   costs the product of both counts. A document's class is the component of these exact links.

Recall: two sets at the very threshold meet in a tree's nodes of level DEPTH with a chance of 0.64 at a
similarity of 0.85 and of 0.58 at 0.8; needed() gives as many trees as leave out a share of MISS of such
pairs, 10 and 12. Nodes that stay large lose some more of them at each level. A candidate that meets is
overlooked if its estimate is SPREAD deviations too low. Families join what is linked by chains of others too.

Defined results: a text without words, or null, has 0 shingles and is linked with nothing; documents of
fewer words than SHINGLE have their whole sequence as one shingle; rows that share an id are one point for
each different set; a row without an id has no component and isn't kept; an empty table gives an empty
table; columns beside the id and the text don't matter.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..storage import runtime_filters, scratch, stored
from .linking import components, forest
from .words import Words, mixed, sliced

TOKENS, DEPTH = 128, 4
LEAF, BLOCK, MANY = 400, 1000, 8
MISS, SPREAD = 5e-5, 4.2
#: Pivots of a family in a round; a round must gather this share of what stands apart to be followed by another.
PIVOTS, GAIN = 64, 0.2
#: Shingles that a block should hold, which bounds the memory of a task that compares two.
BLOCK_SHINGLES = 2 << 20
_A = np.random.Generator(np.random.PCG64(99)).integers(1, 1 << 31, TOKENS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = np.random.Generator(np.random.PCG64(77)).integers(0, 1 << 32, TOKENS, dtype=np.uint32)
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_SIGNATURE = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("point", pa.int64()), ("check", pa.int64()), ("tokens", pa.binary())])


def shingle_sets(column: pa.Array, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row's words."""
    w = Words(column, lower=True)
    n = len(w)
    hashes = np.zeros(n, np.uint64)
    for k in range(shingle):
        hashes[: n - k] += w.hash[k:] * np.uint64(pow(int(_C[0]), k + 1, 1 << 64))
    hashes = mixed(hashes)
    out = []
    for a, b in zip(w.rows[:-1].tolist(), w.rows[1:].tolist(), strict=True):
        if b - a >= shingle:
            out.append(np.unique(hashes[a : b - shingle + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for h in w.hash[a:b]:
                whole = mixed(np.array([whole], np.uint64) * _C[1] + h)[0]
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def embedded(one: np.ndarray) -> np.ndarray:
    """TOKENS minwise tokens of a set."""
    low = np.full(TOKENS, np.uint32(0xFFFFFFFF))
    x = (one >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(x), 2048):
        np.minimum(low, (x[k : k + 2048, None] * _A[None, :] + _B[None, :]).min(0), out=low)
    return (mixed(low.astype(np.uint64) * _C[2] + np.arange(TOKENS, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def names_of(one: np.ndarray) -> tuple[int, int]:
    """Two numbers that name a set: a point's name, and what tells two points of one name apart."""
    with np.errstate(over="ignore"):
        a, b = mixed(one ^ _C[3]).sum(dtype=np.uint64), mixed(one * _C[4]).sum(dtype=np.uint64)
    return int((a >> np.uint64(1)).astype(np.int64)), int(b.view(np.int64))


def signatures(df: DataFrame, text: str, key: str, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, point, check, tokens) of each row."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch, "_text"):
                sets = shingle_sets(part.column("_text"), shingle)
                names = [names_of(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()), pa.array([embedded(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                    schema=_SIGNATURE,
                )

    return df.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text")).mapInArrow(run, "doc_id long, n_shingles long, point long, check long, tokens binary")


def needed(similarity: float) -> int:
    """Trees after which all but MISS of the pairs at the threshold have met at level DEPTH."""
    apart = 0.0
    for _ in range(DEPTH):  # a pair goes on along each chosen coordinate with the chance that its tokens are equal
        lost = 1 - similarity + similarity * apart
        apart = lost * (1 - (1 / similarity - 1) * (1 - lost))
    return max(1, int(np.ceil(np.log(MISS) / np.log(apart)))) if apart > 0 else 1


def slack(similarity: float) -> float:
    """How far below the similarity an estimate may be."""
    return SPREAD * float(np.sqrt(similarity * (1 - similarity) / TOKENS))


def branched(nodes: np.ndarray, tokens: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The children (index of the row, node) of rows at nodes."""
    first = mixed(nodes ^ _C[2])
    second = mixed(first + _C[3])
    rows = np.arange(len(nodes))
    again = (second >> np.uint64(11)).astype(np.float64) / float(1 << 53) < 1 / similarity - 1
    out_rows, out_nodes = [], []
    for chosen, some, salt in ((first, np.ones(len(nodes), bool), _C[0]), (second, again, _C[1])):
        at = (chosen % np.uint64(TOKENS)).astype(np.int64)[some]
        value = tokens[rows[some], at].astype(np.uint64)
        out_rows.append(rows[some])
        out_nodes.append(mixed(nodes[some] * _C[4] + salt + value * _C[0]))
    return np.concatenate(out_rows), np.concatenate(out_nodes)


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, TOKENS)


def once(rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and their nodes without the few that come twice, as a second path led to the same node."""
    order = np.lexsort((nodes, rows))
    rows, nodes = rows[order], nodes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (nodes[1:] != nodes[:-1])
    return rows[new], nodes[new]


def rooted(points: DataFrame, similarity: float, trees: int, depth: int) -> DataFrame:
    """(node, point) of level depth in all trees."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                tokens, ids = _tokens(part.column("tokens")), np.asarray(part.column("point"))
                for tree in range(trees):
                    rows = np.arange(len(ids))
                    nodes = np.full(len(ids), mixed(np.array([tree + 1], np.uint64))[0])
                    for _ in range(depth):
                        kept, nodes = branched(nodes, tokens[rows], similarity)
                        rows = rows[kept]
                    rows, nodes = once(rows, nodes)
                    yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(ids[rows])], ["node", "point"])

    return points.select("point", "tokens").mapInArrow(run, "node long, point long")


def deeper(rows: DataFrame, similarity: float) -> DataFrame:
    """The children of rows (node, point, tokens)."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                kept, nodes = once(*branched(np.asarray(part.column("node")).view(np.uint64), _tokens(part.column("tokens")), similarity))
                at = pa.array(kept)
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), part.column("point").take(at), part.column("tokens").take(at)], ["node", "point", "tokens"])

    return rows.select("node", "point", "tokens").mapInArrow(run, "node long, point long, tokens binary")


def deepest(points: int) -> int:
    """The level at which nodes that are still large hold points alike, not chance: it grows with the points' logarithm."""
    return max(DEPTH + 1, int(np.ceil(np.log(max(1, points / LEAF)) / np.log(3))))


def sized(rows: DataFrame) -> DataFrame:
    """Of each node with more than one point: its size, first point, and a number that names its set of points."""
    return rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("point").alias("first"), F.sum(F.shiftright(F.xxhash64("point"), 20)).alias("members")).where("size > 1")


def candidates(points: DataFrame, similarity: float, trees: int, depth: int = DEPTH) -> DataFrame:
    """Links (a, b) that hang together whatever candidates there are; star by star, not pair by pair."""
    spark, last = points.sparkSession, deepest(points.count())
    with runtime_filters(spark):
        level = stored(rooted(points, similarity, trees, depth), "nodes")
        found = []
        for k in range(depth, last + 1):
            nodes = stored(sized(level), "sizes")
            # Trees find the same groups again and again: each set of points is looked at once.
            small = nodes.where(F.col("size") <= LEAF).groupBy("size", "first", "members").agg(F.min("node").alias("node")).select("node", "size")
            small = stored(small, "leaves").where("size > 1")
            large = nodes.where(F.col("size") > LEAF).select("node", "size", "first")
            leaves = level.join(small, "node")
            rest = level.join(large, "node")
            if k == depth:  # from here on rows have their tokens with them
                leaves = points.select("point", "tokens").join(stored(leaves, "leaf-points").where("size > 1"), "point")
            found.append(stored(compared(leaves.select("node", "point", "tokens"), similarity), "candidates"))
            if not large.limit(1).count():
                break
            if k == last:
                found.append(rest.where("point <> first").select(F.col("first").alias("a"), F.col("point").alias("b")))
            else:
                if k == depth:
                    rest = points.select("point", "tokens").join(stored(rest.select("node", "point", "size"), "large-nodes").where("size > 1"), "point")
                level = stored(deeper(rest, similarity), "nodes")
    links = found[0]
    for x in found[1:]:
        links = links.unionByName(x)
    return links


def alike(nodes: np.ndarray, tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one node with at least so many equal tokens; rows are ordered by node."""
    a, b = [], []
    here = np.arange(len(nodes))
    shift = 1
    while True:
        here = here[: np.searchsorted(here, len(nodes) - shift)]
        here = here[nodes[here] == nodes[here + shift]]  # what has no partner at this distance has none farther on
        if not len(here):
            return np.concatenate(a or [here]), np.concatenate(b or [here])
        for start in range(0, len(here), 8192):
            part = here[start : start + 8192]
            same = part[(tokens[part] == tokens[part + shift]).sum(1, dtype=np.int16) >= least]
            a.append(same)
            b.append(same + shift)
        shift += 1


def compared(leaves: DataFrame, similarity: float) -> DataFrame:
    """Links between points of small nodes (node, point, tokens) whose embeddings are alike."""
    least = int(np.ceil((similarity - slack(similarity)) * TOKENS))

    def links(nodes, ids, tokens):
        label = forest(len(ids), *alike(nodes, tokens, least))
        far = np.flatnonzero(label != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[label[far]]), pa.array(ids[far])], ["a", "b"])

    def run(batches):
        held = None  # rows of the last node seen, which may go on in the next batch
        for batch in batches:
            for start in range(0, batch.num_rows, 8192):
                part = batch.slice(start, 8192)
                rows = [np.asarray(part.column("node")), np.asarray(part.column("point")), _tokens(part.column("tokens"))]
                if held is not None:
                    rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
                cut = int(np.searchsorted(rows[0], rows[0][-1]))
                held = [x[cut:] for x in rows]
                if cut:
                    yield links(*(x[:cut] for x in rows))
        if held is not None:
            yield links(*held)

    return leaves.repartition("node").sortWithinPartitions("node").mapInArrow(run, "a long, b long")


def exact_links(sizes: list[int], values: np.ndarray, percent: int, only: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets, given one after the other, with 100 * intersection >= percent * union.

    only: of pairs among the first so many sets and pairs among the rest, none; of pairs across, all.
    """
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    size = np.asarray(sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    edge = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
    shared = np.repeat(np.diff(edge) > 1, np.diff(edge))  # what one set has alone is in no intersection
    column = np.repeat(np.arange(len(edge) - 1), np.diff(edge))[shared]
    owner = owner[shared]
    _, column = np.unique(column, return_inverse=True)
    common = np.zeros((n, n), np.float32)
    columns = int(column.max(initial=-1)) + 1
    width = min(columns, max(1, (8 << 20) // max(1, n)))
    for start in range(0, columns, max(1, width)):
        at = (column >= start) & (column < start + width)
        dense = np.zeros((n, width), np.float32)
        dense[owner[at], column[at] - start] = 1
        common += dense @ dense.T
    both = common.astype(np.int64)
    hit = np.triu(100 * both >= percent * (size[:, None] + size[None, :] - both), 1)
    if only is not None:
        hit[:only, :only] = False
        hit[only:, only:] = False
    return np.nonzero(hit)


def verified(families: DataFrame, df: DataFrame, text: str, key: str, shingle: int, percent: int) -> DataFrame:
    """(a, b): exact links that connect all of a family's points that any exact links connect.

    families: (point, check, doc_id of one document with that set, n_shingles, family). The sets are made again from that text."""
    size = families.groupBy("family").agg(F.count(F.lit(1)).alias("_size"), F.sum("n_shingles").alias("_shingles"))
    blocks = F.greatest(F.ceil(F.col("_size") / F.lit(BLOCK)), F.ceil(F.col("_shingles") / F.lit(BLOCK_SHINGLES))).cast("int")
    placed = families.join(size, "family").withColumn("_blocks", blocks).drop("_shingles", "n_shingles")
    placed = stored(placed.withColumn("_block", F.pmod(F.hash("point", F.lit("block")), F.col("_blocks"))), "blocks")
    texts = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text")).join(placed.where("_size > 1").drop("_size"), "doc_id")

    def sets(batches):
        for batch in batches:
            for part in sliced(batch, "_text"):
                made = shingle_sets(part.column("_text"), shingle)
                names = [names_of(s) for s in made]
                own = [n == (p, c) for n, p, c in zip(names, part.column("point").to_pylist(), part.column("check").to_pylist(), strict=True)]
                keep = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).filter(keep) for c in ("family", "point", "_blocks", "_block")), pa.array([s.tobytes() for s, o in zip(made, own, strict=True) if o], pa.binary())],
                    ["family", "point", "_blocks", "_block", "set"],
                )

    # Block i meets block j in the task (i, j), i <= j.
    made = texts.where(F.col("_blocks") <= MANY).mapInArrow(sets, "family long, point long, _blocks int, _block int, set binary")
    pairs = made.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    pairs = pairs.withColumns({"_one": F.col("_block") >= F.col("_other"), "_j": F.greatest("_block", "_other"), "_block": F.least("_block", "_other")})
    found = [met(pairs, percent, False)]
    if placed.where(F.col("_blocks") > MANY).limit(1).count():
        large = texts.where(F.col("_blocks") > MANY).mapInArrow(sets, "family long, point long, _blocks int, _block int, set binary")
        found += gathered(stored(large, "sets"), percent)
    links = found[0].select("a", "b")
    for x in found[1:]:
        links = links.unionByName(x.select("a", "b"))
    return links


def met(rows: DataFrame, percent: int, across: bool) -> DataFrame:
    """(a, b, n): links of the sets of each (family, _block, _j), as a star for each component, with how many a point b has.

    across: only those between rows with _one and the others are looked for, as they are where two blocks meet."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["point", "_one"]).sort_values(["_one", "point"])
        ids, first = frame["point"].to_numpy(), int((~frame["_one"]).sum())
        split = first if across or frame["_block"].iloc[0] != frame["_j"].iloc[0] else None
        a, b = exact_links([len(s) // 8 for s in frame["set"]], np.frombuffer(b"".join(frame["set"]), np.uint64), percent, split)
        label, n = forest(len(ids), a, b), np.bincount(np.concatenate([a, b]), minlength=len(ids))
        some = np.flatnonzero(n)
        return pd.DataFrame({"a": ids[label[some]], "b": ids[some], "n": n[some]})

    return rows.select("family", "_block", "_j", "_one", "point", "set").groupBy("family", "_block", "_j").applyInPandas(run, "a long, b long, n long")


def gathered(large: DataFrame, percent: int) -> list[DataFrame]:
    """Links of families of several blocks, see the module's point 4."""
    both = ["family", "_block", "_j", "_one", "point", "set"]
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block")
    state = large.select("family", "point").distinct().withColumns({"label": F.col("point"), "n": F.lit(0).cast("long")})
    links, found, before = [], [], None
    while True:
        # Where a family's points are: those of its largest component, and those that stand apart.
        main = state.groupBy("family", "label").agg(F.count(F.lit(1)).alias("_n")).groupBy("family").agg(F.max_by("label", F.struct("_n", "label")).alias("_main"))
        placed = stored(state.join(main, "family").withColumn("_apart", F.col("label") != F.col("_main")).drop("_main"), "family-points")
        left = placed.where("_apart").groupBy("family").agg(F.count(F.lit(1)).alias("_left"))
        left = stored(left.withColumn("_going", F.lit(True)) if before is None else left.join(before, "family").withColumn("_going", (F.col("_left") > BLOCK) & (F.col("_left") < F.col("_before") * (1 - GAIN))), "apart")
        done, going = left.where("NOT _going"), left.where("_going")
        if done.limit(1).count():
            turns = F.ceil(F.col("_left") / F.lit(BLOCK)).cast("int")
            queries = placed.where("_apart").join(done, "family").select("point", F.pmod(F.hash("point", F.lit("apart")), turns).alias("_j"))
            queries = large.drop("_block").join(queries, "point").withColumn("_one", F.lit(True)).select("family", every, "_j", "_one", "point", "set")
            others = large.join(done, "family").withColumns({"_one": F.lit(False), "_j": F.explode(F.sequence(F.lit(0), turns - 1))})
            found.append(stored(met(others.select(*both).unionByName(queries), percent, True), "apart-links"))
        if not going.limit(1).count():
            return [*links, *found]
        open_ = placed.join(going.select("family"), "family", "left_semi")
        pivots = stored(first_of(open_, [F.desc("n")]).unionByName(first_of(open_.where("_apart"), [])).distinct(), "pivots")
        queries = large.drop("_block").join(pivots, "point", "left_semi").withColumns({"_one": F.lit(True), "_j": F.lit(0)}).select("family", every, "_j", "_one", "point", "set")
        others = large.join(going.select("family"), "family", "left_semi").withColumns({"_one": F.lit(False), "_j": F.lit(0)})
        links.append(stored(met(others.select(*both).unionByName(queries), percent, True), "pivot-links"))
        joined = components(reduce(DataFrame.unionByName, [x.select("a", "b") for x in links])).withColumnsRenamed({"node": "point", "component": "_to"})
        degrees = links[-1].groupBy(F.col("b").alias("point")).agg(F.sum("n").alias("_more"))
        state = open_.select("family", "point", "n").join(joined, "point", "left").join(degrees, "point", "left")
        state = state.select("family", "point", F.coalesce("_to", "point").alias("label"), (F.col("n") + F.coalesce("_more", F.lit(0))).alias("n"))
        before = going.select("family", F.col("_left").alias("_before"))


def first_of(rows: DataFrame, order: list) -> DataFrame:
    """The points of each family that come first, half as many as there are pivots; ties by a hash. Only so many of each part move."""
    place = F.row_number().over(Window.partitionBy("family").orderBy(*order, F.xxhash64(F.lit("pivot"), "point")))
    return rows.withColumn("_place", place).where(F.col("_place") <= PIVOTS // 2).select("point")


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, percent: int = 80, trees: int | None = None) -> DataFrame:
    """For each row doc_id, n_shingles, component_id (the smallest id reachable by links) and kept."""
    similarity = percent / 100
    marked = stored(signatures(df, text, key, shingle), "signatures")
    points = marked.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("point", "check").agg(F.min("doc_id").alias("doc_id"), F.first("tokens").alias("tokens"), F.first("n_shingles").alias("n_shingles"))
    points = stored(points, "points")
    with scratch(df.sparkSession):
        families = components(candidates(points, similarity, trees or needed(similarity))).withColumnsRenamed({"node": "point", "component": "family"})
        families = stored(families.join(points.select("point", "check", "doc_id", "n_shingles"), "point"), "families", keep=True)
    with scratch(df.sparkSession), runtime_filters(df.sparkSession):
        exact = stored(verified(families, df, text, key, shingle, percent), "exact-links", keep=True)
    linked = components(exact).withColumnsRenamed({"node": "point", "component": "group"})
    linked = linked.join(families.select("point", "doc_id"), "point")
    least = linked.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    classes = linked.join(least, "group").select("point", "component_id")
    alone = points.select("point", F.col("doc_id").alias("_own")).join(classes, "point", "left")
    known = stored(alone.select(F.col("point").alias("_point"), F.coalesce("component_id", "_own").alias("_class")), "classes")
    met = marked.select("doc_id", "n_shingles", "point").join(known, (F.col("point") == F.col("_point")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_class", "doc_id"))
    out = met.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_first(df: DataFrame, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """df with one row of each class, that of the smallest id. Rows that share an id are one document; rows without one stay.

    Of rows that share an id the one with the smallest text stays, and of those with the same text the
    smallest in its other columns, so that the result is the same each time."""
    kept = near_duplicates(df, text, key, **how).where("kept").select(F.col("doc_id").alias("_covey_kept")).groupBy("_covey_kept").agg(F.count(F.lit(1)).alias("_covey_n"))
    met = df.join(stored(kept, "kept"), F.col(key).cast("long") == F.col("_covey_kept"))
    once, more = met.where("_covey_n = 1").select(*df.columns), met.where("_covey_n > 1")
    rest = [c for c in df.columns if c not in (key, text)]
    order = F.struct(F.col(text), F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0))
    least = more.groupBy("_covey_kept").agg(F.min_by(F.struct(*df.columns), order).alias("_covey_row")).select("_covey_row.*")
    return once.unionByName(least).unionByName(df.where(F.col(key).isNull()))


def op1_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, percent=85)


# Sets with the similarity share one of their rarest shingles, of which each looks at as many as it may lack and one more.
OP1_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) ELSE [array_to_string(w, ' ')] END) AS shingle FROM words WHERE len(w) > 0),
names AS (SELECT shingle, row_number() OVER (ORDER BY count(*), shingle) AS s FROM shingles GROUP BY shingle),
owned AS (SELECT doc_id, list(s ORDER BY s) AS items FROM shingles JOIN names USING (shingle) GROUP BY doc_id),
sets AS (SELECT min(doc_id) AS id, items, len(items) AS n FROM owned GROUP BY items),
rare AS (SELECT id, unnest(items[1:n - (85 * n + 99) // 100 + 1]) AS s FROM sets),
pairs AS (SELECT DISTINCT x.id AS a, y.id AS b FROM rare x JOIN rare y ON x.s = y.s AND x.id < y.id),
met AS (SELECT a, b, x.n + y.n AS total, len(list_intersect(x.items, y.items)) AS common FROM pairs JOIN sets x ON x.id = a JOIN sets y ON y.id = b WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)),
linked AS (SELECT a, b FROM met WHERE 100 * common >= 85 * (total - common)),
links AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached AS (SELECT id, id AS other FROM sets UNION SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a),
classes AS (SELECT id, min(other) AS least FROM reached GROUP BY id),
known AS (SELECT o.doc_id, s.n, c.least FROM owned o JOIN sets s USING (items) JOIN classes c ON c.id = s.id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(least, doc_id) AS component_id, coalesce(least, doc_id) = doc_id AS kept FROM words LEFT JOIN known USING (doc_id)
"""
