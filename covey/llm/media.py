"""Interleaved document sequences with media columns.

parse() turns HTML into an ordered array of elements, each a text or a reference to media by the digest
of its payload, with the caption that belongs to it. put() stores payloads as 8-bit greyscale PNG files
in a binary column of a table in the shared folder; take() reads the stored bytes back, decodes them and
computes features. resolve() joins the references of sequences with what was read back by digest; the
elements stay in the order of the page, and captions with their references.

Defined results: a null page or text has no elements, a null payload is an empty one; a reference to a
digest that isn't stored keeps its place with null values; equal payloads have equal stored forms, so it
doesn't matter which of them a digest meets; rows that repeat are resolved as often as they come; columns
of the input that are called like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import html
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..storage import stored
from .columns import others
from .mainpage import BLOCKS, TOKEN

WIDTH = 576
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SCHEME = "sha256:"
#: What helper columns are called, which no input column is.
ROW = "_covey_media_row"
ELEMENT = "array<struct<position:int,kind:string,text:string,digest:string,caption:string>>"


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png(payload: bytes) -> bytes:
    """The payload, a multiple of WIDTH bytes, as a greyscale image whose samples are its bytes."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)  # each line starts with its filter, 0
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def unpng(data: bytes) -> bytes:
    """The samples of an image that png() made."""
    if data[:8] != _SIGNATURE:
        raise ValueError("no PNG signature")
    at, body, width, height = 8, [], 0, 0
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        held = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + held) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("a chunk's checksum is wrong")
        if kind == b"IHDR":
            width, height = struct.unpack(">II", held[:8])
        elif kind == b"IDAT":
            body.append(held)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("a line is filtered")
    return lines[:, 1:].tobytes()


def feature(samples: bytes) -> str:
    """Height, mean, deviation and entropy of the samples."""
    n = np.bincount(np.frombuffer(samples, np.uint8), minlength=256)
    values, share = np.arange(256), n / n.sum()
    mean = float(values @ share)
    deviation = float(np.sqrt(((values - mean) ** 2) @ share))
    some = share[share > 0]
    return f"h={len(samples) // WIDTH};mean={mean:.4f};dev={deviation:.4f};bits={float(-(some * np.log2(some)).sum()):.4f}"


def elements(page: str | None) -> list[dict]:
    """A page's texts and media references in order.

    A figure's caption belongs to the references in it that have no nearer one, wherever in the figure it
    stands; other references have their alt text. A caption ends with its end tag, its figure or the page, and
    is a text in its place if its figure has no reference. End tags of nothing are markup."""
    out: list[dict] = []
    words: list[str] = []
    figures: list[dict] = []  # open ones: their references, the parts of their caption, whether it is open, where it goes as text

    def flush() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            out.append({"kind": "text", "text": text, "digest": None, "caption": None})

    def end_figure() -> None:
        flush()
        done = figures.pop()
        caption = " ".join("".join(done["caption"]).split())
        if caption and done["refs"]:
            for ref in done["refs"]:
                ref["caption"] = caption
        elif caption:
            out.insert(done["at"], {"kind": "text", "text": caption, "digest": None, "caption": None})
        if figures and not caption:
            figures[-1]["refs"] += done["refs"]

    page, at = page or "", 0
    while m := TOKEN.match(page, at):
        at = m.end()
        closing, tag, attributes, closing2, tag2, attributes2, text = m.groups()
        if text is not None:
            (figures[-1]["caption"] if figures and figures[-1]["open"] else words).append(html.unescape(text))
            continue
        closing, tag, attributes = (closing, tag, attributes) if tag else (closing2, tag2, attributes2)
        if not tag:
            continue
        tag = tag.lower()
        if tag in _RAW_END and not closing:
            stop = _RAW_END[tag].search(page, at)
            if stop is None:
                break  # raw text to the end of the page
            at = stop.end()
        elif tag == "figcaption":
            if figures:
                flush()
                if not closing and not figures[-1]["caption"]:
                    figures[-1]["at"] = len(out)
                figures[-1]["open"] = not closing
                figures[-1]["caption"].append(" ")
        elif tag == "figure":
            flush()
            if not closing:
                figures.append({"refs": [], "caption": [], "open": False, "at": len(out)})
            elif figures:
                end_figure()
        elif tag in ("img", "audio", "video", "source"):
            found = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)}
            if not closing and found.get("src", "").startswith(_SCHEME):
                flush()
                ref = {"kind": "media", "text": None, "digest": found["src"][len(_SCHEME) :], "caption": found.get("alt")}
                out.append(ref)
                if figures:
                    figures[-1]["refs"].append(ref)
        elif tag in BLOCKS or tag == "br":
            if figures and figures[-1]["open"]:
                figures[-1]["caption"].append(" ")
            else:
                flush()
    while figures:
        end_figure()
    flush()
    return [{"position": k, **x} for k, x in enumerate(out)]


def _mapped(df: DataFrame, column: str, fields: dict[str, str], make) -> DataFrame:
    """df with the fields that make gives for batches of a column's values, in place of that column."""
    kept = others(df, column, *fields)
    added = T.StructType.fromDDL(", ".join(f"{k} {v}" for k, v in fields.items()))
    schema = T.StructType([*(df.schema[c] for c in kept), *added])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in added]
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                made = [make(x) for x in part.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *(pa.array([m[k] for m in made], t) for k, t in enumerate(types))], schema.names)

    return df.select(*kept, column).mapInArrow(run, schema)


def parse(df: DataFrame, page: str = "html", name: str = "elements") -> DataFrame:
    """df with the ordered elements of each page in place of it."""
    return _mapped(df, page, {name: ELEMENT}, lambda x: (elements(x),))


def put(df: DataFrame, payload: str = "payload", digest: str = "digest") -> DataFrame:
    """The table (digest, media) of the payloads' stored forms, written to the shared folder and read from there."""
    return stored(_mapped(df.select(F.col(digest).alias("digest"), F.col(payload).alias("payload")), "payload", {"media": "binary"}, lambda x: (png(x or b"\xff" * WIDTH),)), "media")


def take(store: DataFrame) -> DataFrame:
    """For each digest what its stored bytes hold."""

    def read(data: bytes) -> tuple:
        samples = unpng(data)
        return len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature(samples)

    fields = {"payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"}
    return _mapped(store, "media", fields, read).dropDuplicates(["digest"])


def resolve(sequences: DataFrame, taken: DataFrame, name: str = "elements") -> DataFrame:
    """sequences with each element of the array name joined, by digest, with what was read back; in order."""
    facts = [c for c in taken.columns if c != "digest"]
    kept = others(sequences, name)
    rows = sequences.withColumn(ROW, F.monotonically_increasing_id())
    flat = rows.select(ROW, *kept, F.explode_outer(name).alias(f"{ROW}_e"))
    known = stored(taken.select(F.col("digest").alias(f"{ROW}_digest"), F.struct(*facts).alias(f"{ROW}_media")), "media-facts")
    met = flat.join(known, F.col(f"{ROW}_e.digest") == F.col(f"{ROW}_digest"), "left")
    element = F.when(F.col(f"{ROW}_e").isNotNull(), F.struct(*(f"{ROW}_e.{c}" for c in ("position", "kind", "text", "digest", "caption")), F.col(f"{ROW}_media").alias("media")))
    whole = met.groupBy(ROW).agg(*(F.first(c).alias(c) for c in kept), F.array_sort(F.collect_list(element)).alias(name))
    return whole.drop(ROW)


def payloads(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_bytes, payload (UTF-8, padded by bytes 255 to a positive multiple of WIDTH) and its digest in place of text."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    pad = F.when(F.length(raw) == 0, F.lit(WIDTH)).otherwise(F.pmod(-F.length(raw), F.lit(WIDTH)))
    filled = F.concat(raw, F.unhex(F.repeat(F.lit("FF"), pad)))
    kept = others(docs, text, "n_bytes", "payload", "digest")
    return docs.select(*kept, F.length(raw).cast("bigint").alias("n_bytes"), filled.alias("payload")).withColumn("digest", F.sha2("payload", 256))


def op5_media_sequences(spark, sf_dir: str) -> DataFrame:
    """Each document as a page: a heading, a figure whose payload is its text, words, and the payload again in a line of text.

    The row is what the figure's reference met, which is the one with a caption of its own; place and caption
    of both references show that they stayed where they were."""
    docs = payloads(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    name = F.concat(F.lit("document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    src = F.concat(F.lit("src='sha256:"), F.col("digest"), F.lit("'"))
    page = F.concat(
        F.lit("<article><h1>"), name, F.lit("</h1><figure><img "), src, F.lit("><figcaption>"), name, F.lit("</figcaption></figure><p>It holds "),
        F.col("n_bytes").cast("string"), F.lit(" bytes, as <img alt='small' "), src, F.lit("> shows.</p></article>"),
    )
    sequences = parse(docs.select("doc_id", "n_bytes", page.alias("html")))
    found = resolve(sequences, take(put(docs)))
    media = F.filter("elements", lambda e: e["kind"] == "media")
    figure, again = media[0], media[1]
    whole = found.select("doc_id", "n_bytes", figure.alias("f"), again.alias("a"), F.size("elements").alias("n_elements"))
    return whole.select("doc_id", "n_bytes", "f.media.*", "f.position", "f.caption", F.col("a.position").alias("again_position"), F.col("a.caption").alias("again_caption"), "n_elements")
