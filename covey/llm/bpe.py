"""Byte-level BPE by overlapping chunk encoding.

A text of up to CHUNK characters is one piece. A longer one is cut into chunks of CHUNK characters that
overlap by OVERLAP. All chunks are pre-tokenised in parallel, each from its own first character; of each
only the pre-token boundaries in its first OVERLAP characters and in its overlap with the next chunk are
kept. Two neighbours are stitched at the first boundary that both have: from there on both see the same
text from the same place, so their pre-tokens agree. Where they share none, the chunks stay together in
one piece, which keeps the result exact. The pieces between stitches are encoded in parallel, and a
text's ids are those of its pieces in order. Decoding concatenates the raw bytes of the ids.

Defined results: a null text is an empty text, with no ids; rows that repeat are encoded as often as they
come; an empty table gives an empty table. Columns of the input are carried along, except those that are
called like a result column.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import stored
from .columns import others

CHUNK, OVERLAP = 1 << 16, 1 << 11
#: Boundaries this near a chunk's end may depend on what follows it.
GUARD = 8


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    """The library's encoder for a file of ranks, and each id's decimal text; made once in a worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    made = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return made, [str(i) for i in range(max(ranks.values()) + 1)]


def vocabulary(path: str | None, pattern: str | None) -> tuple[str, str]:
    if path is None:
        path = default_vocabulary()
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return path, pattern


def _ids(texts, path, pattern):
    """The ids of each text."""
    enc, _ = encoder(path, pattern)
    for text in texts:
        yield enc.encode_ordinary(text or "")


def _with(df: DataFrame, text: str, name: str, kind: str, make) -> DataFrame:
    """df with its column text replaced by a column name, made by make from the batch's texts."""
    kept = others(df, text, name)
    schema = T.StructType([*(T.StructField(c, df.schema[c].dataType) for c in kept), T.StructField(name, T.DataType.fromDDL(kind))])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), make(part.column(text))], [*kept, name])

    return df.mapInArrow(run, schema)


def pieces(df: DataFrame, text: str, path: str, pattern: str, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """df's long texts with a row number _row, and their pieces (_row, _piece, _text) by the stitches found."""
    long = stored(df.withColumn("_covey_row", F.monotonically_increasing_id()), "bpe-long")
    length = F.length(text)
    starts = F.sequence(F.lit(0), length - 1, F.lit(chunk))
    chunks = long.select("_covey_row", length.alias("_length"), F.explode(F.transform(starts, lambda s: F.struct(s.alias("start"), F.substring(F.col(text), s + 1, F.lit(chunk + overlap)).alias("text")))).alias("c"))
    chunks = chunks.select("_covey_row", "_length", F.col("c.start").alias("_start"), F.col("c.text").alias("_chunk")).repartition("_covey_row", "_start")

    def bounds(column):
        import regex

        find = regex.compile(pattern).finditer
        heads, tails = [], []
        for t in column.to_pylist():
            ends = [m.start() for m in find(t)]
            heads.append([e for e in ends if e <= overlap])
            tails.append([e - chunk for e in ends if chunk <= e < len(t) - GUARD])
        return pa.StructArray.from_arrays([pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], ["head", "tail"])

    seen = _with(chunks, "_chunk", "_bounds", "struct<head:array<int>,tail:array<int>>", bounds)
    ahead = seen.select("_covey_row", (F.col("_start") + chunk).alias("_start"), F.col("_bounds.tail").alias("_tail"))
    joined = seen.join(ahead, ["_covey_row", "_start"])
    # A chunk's own boundaries are right after its own stitch, which lies in its first OVERLAP characters;
    # the position 0 of a chunk is no boundary it has found, but where it was cut.
    common = F.array_min(F.filter(F.array_intersect(F.col("_bounds.head"), F.col("_tail")), lambda e: e > 0))
    found = joined.select("_covey_row", "_start", (F.col("_start") + common).alias("_cut"))
    cuts = found.groupBy("_covey_row").agg(F.array_sort(F.collect_list(F.struct("_start", "_cut"))).alias("_all"))
    # A chunk that isn't stitched to what stands before it has no sure boundaries: the rest is one piece.
    sure = F.expr("coalesce(nullif(array_position(transform(_all, x -> x._cut IS NULL), true), 0) - 1, size(_all))")
    cuts = cuts.select("_covey_row", F.expr("transform(_all, x -> x._cut)").alias("_cuts"), sure.cast("int").alias("_sure"))
    cuts = cuts.select("_covey_row", F.slice("_cuts", F.lit(1), F.col("_sure")).alias("_cuts"))
    whole = long.select("_covey_row", F.col(text).alias("_whole")).join(cuts, "_covey_row", "left")
    edges = F.concat(F.array(F.lit(0)), F.coalesce(F.col("_cuts"), F.array().cast("array<int>")), F.array(F.length("_whole")))
    parts = F.expr("transform(sequence(1, size(_edges) - 1), i -> struct(i AS i, substring(_whole, _edges[i - 1] + 1, _edges[i] - _edges[i - 1]) AS t))")
    cut = whole.withColumn("_edges", edges).select("_covey_row", F.explode(parts).alias("p"))
    return long, cut.select("_covey_row", F.col("p.i").alias("_piece"), F.col("p.t").alias("_text")).repartition("_covey_row", "_piece")


def encode(df: DataFrame, text: str = "text", name: str = "ids", path: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """df with the array of ids of each whole text in place of its column text."""
    path, pattern = vocabulary(path, pattern)
    df = df.drop(name) if name != text else df
    make = lambda column: pa.array(list(_ids(column.to_pylist(), path, pattern)), pa.list_(pa.int32()))
    short = _with(df.where(F.coalesce(F.length(text), F.lit(0)) <= chunk), text, name, "array<int>", make)
    long, cut = pieces(df.where(F.length(text) > chunk), text, path, pattern, chunk, overlap)
    done = _with(cut, "_text", "_ids", "array<int>", make)
    gathered = done.groupBy("_covey_row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_piece", "_ids"))), lambda x: x["_ids"])).alias(name))
    return short.unionByName(long.drop(text).join(gathered, "_covey_row").drop("_covey_row"))


def decode(df: DataFrame, ids: str = "ids", name: str = "decoded", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """df with the bytes of each array of ids, a null one as no bytes, in place of it."""
    path, pattern = vocabulary(path, pattern)
    df = df.drop(name) if name != ids else df

    def make(column):
        enc, _ = encoder(path, pattern)
        return pa.array([enc.decode_bytes(x or []) for x in column.to_pylist()], pa.binary())

    return _with(df, ids, name, "binary", make)


def round_trip(df: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, keep_ids: bool = False) -> DataFrame:
    """df with, in place of its column text, what encoding and then decoding gives: n_tokens, ids_sha256, decoded_sha256, and ids if asked for.

    Texts of one piece are encoded, decoded and digested in one go."""
    path, pattern = vocabulary(path, pattern)
    df = df.drop("n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else []))
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), *([("ids", pa.list_(pa.int32()))] if keep_ids else [])]
    kind = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string" + (",ids:array<int>>" if keep_ids else ">")

    def digests(column):
        enc, names = encoder(path, pattern)
        rows = []
        for ids in _ids(column.to_pylist(), path, pattern):
            row = (len(ids), hashlib.sha256(" ".join([names[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
            rows.append((*row, ids) if keep_ids else row)
        return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(fields)], [n for n, _ in fields])

    def raw(column):
        enc, _ = encoder(path, pattern)
        rows = list(_ids(column.to_pylist(), path, pattern))
        return pa.StructArray.from_arrays([pa.array(rows, pa.list_(pa.int32())), pa.array([enc.decode_bytes(r) for r in rows], pa.binary())], ["ids", "bytes"])

    short = _with(df.where(F.coalesce(F.length(text), F.lit(0)) <= chunk), text, "_covey_made", kind, digests)
    long, cut = pieces(df.where(F.length(text) > chunk), text, path, pattern, chunk, overlap)
    done = _with(cut, "_text", "_covey_made", "struct<ids:array<int>,bytes:binary>", raw)
    all_of = F.array_sort(F.collect_list(F.struct("_piece", F.col("_covey_made.ids").alias("ids"), F.hex("_covey_made.bytes").alias("bytes"))))
    one = done.groupBy("_covey_row").agg(all_of.alias("_all")).withColumn("_ids", F.flatten(F.transform("_all", lambda x: x["ids"])))
    made = [
        F.size("_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("_ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.unhex(F.array_join(F.transform("_all", lambda x: x["bytes"]), "")), 256).alias("decoded_sha256"),
        *([F.col("_ids").alias("ids")] if keep_ids else []),
    ]
    one = one.select("_covey_row", F.struct(*made).alias("_covey_made"))
    return short.unionByName(long.drop(text).join(one, "_covey_row").drop("_covey_row")).select("*", "_covey_made.*").drop("_covey_made")


def op8_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
