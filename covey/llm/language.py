"""Language identification by prediction by partial matching.

For each language a byte context tree of order ORDER is learned from a bounded sample of labelled texts:
how often each byte followed each context of up to ORDER bytes. With c occurrences of the byte among t in
a context that d different bytes follow, the byte has the probability c / (t + d) there; a byte that never
followed has the escape probability d / (t + d) times its probability in the context that is shorter by
one byte, down to the uniform distribution. A context that the language never showed passes the question
on without a charge. The statistics are frozen, so the exact code length of any byte is a number known
beforehand; a text's code length in a language is the sum over all its bytes, and the language with the
shortest is predicted. The score is that language's share of the likelihoods, all languages being equally
likely beforehand.

Sample: of each language, texts are taken by a hash of their id so that about SAMPLE bytes are expected, or
an equal share of TOTAL bytes where there are very many languages. Trees of all languages are held as one
set of tables if these fit TABLES bytes; else each language has its own, as large as what it has shown, and
as many as fit are held. Both give the same code lengths.

Defined results: a null text, or one without a letter, is und with score 0; equal code lengths go to the
language that sorts first; without any labelled text all are und; a row without an id isn't held out and
isn't learned from; rows that repeat are predicted as often as they come.
"""

from __future__ import annotations

import re
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..storage import scratch, stored
from .columns import others
from .words import joined, sliced

ORDER = 3  # the tables below are laid out for it
SAMPLE = 6 << 20
#: Bytes whose code lengths are looked up at once.
BLOCK = 1 << 21
#: Bytes of text in all languages' samples, and bytes of tables that a worker holds.
TOTAL, TABLES = 64 * SAMPLE, 400 << 20
#: A language with one in so many bytes of all labelled texts is a large one; there are at most so many.
HOT = 1000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether a text has a character that Unicode calls a letter; numerals such as a superscript 2 are none."""
    found = _LETTER.search(text) if text else None
    return found is not None and (found.group().isalpha() or any(map(str.isalpha, text)))


def _grams(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each byte of the rows with the three before it, as one number; line feeds stand before a row."""
    padded = np.concatenate([np.full(ORDER, 10, np.uint8), data]).astype(np.uint32)
    grams = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    place = np.arange(len(data)) - np.repeat(starts[:-1], np.diff(starts))
    for k in range(ORDER):  # what lies before a row belongs to another
        masks = np.uint32([0x000000FF, 0x0000FFFF, 0x00FFFFFF][k])
        fill = np.uint32([0x0A0A0A00, 0x0A0A0000, 0x0A000000][k])
        at = place == k
        grams[at] = grams[at] & masks | fill
    return grams


def counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """How often each run of ORDER + 1 bytes occurs in each language's texts."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch, "text"):
                names = np.array(part.column("lang").to_pylist(), object)
                for name in sorted(set(names)):
                    data, starts = joined(part.column("text").filter(pa.array(names == name)))
                    found, n = np.unique(_grams(data, starts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(found)), pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    found = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """All languages' context trees as tables that are looked up by numbers."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        size = len(langs)
        seen = np.unique(np.concatenate([gram >> s & 255 for s in (0, 8, 16, 24)])).astype(np.int64)
        self.symbol = np.zeros(256, np.int64)  # 0: a byte never seen
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.a = a = len(seen) + 1
        s3, s2, s1, b = (self.symbol[gram >> s & 255] for s in (24, 16, 8, 0))

        two = np.unique(s2 * a + s1)
        self.pair = np.zeros(a * a, np.int64)
        self.pair[two] = np.arange(1, len(two) + 1)
        of_two = self.pair[s2 * a + s1]
        three = np.unique(of_two * a + s3)
        self.triple = np.zeros((len(two) + 1) * a, np.int64)
        self.triple[three] = np.arange(1, len(three) + 1)
        of_three = self.triple[of_two * a + s3] - 1
        self.second, self.third = a * a, a * a + len(two) * a

        def level(context: np.ndarray, rows: int, below: np.ndarray, own: np.ndarray) -> np.ndarray:
            """Log probabilities (context, byte) in one language from its counts and the level below."""
            c = np.bincount(context[own] * a + b[own], n[own], rows * a).astype(np.float32).reshape(rows, a)
            t, d = c.sum(1, keepdims=True), (c > 0).sum(1, keepdims=True).astype(np.float32)
            with np.errstate(divide="ignore", invalid="ignore"):
                out = np.where(t > 0, np.log(d / (t + d)) + below, below)
                return np.where(c > 0, np.log(c / (t + d)), out)

        self.table = []
        for k in range(size):  # one at a time, as the tables of all would fill a worker
            own = np.flatnonzero(lang == k)
            order0 = level(np.zeros_like(b), 1, np.full((1, 1), -np.log(257.0), np.float32), own)
            order1 = level(s1, a, order0, own)
            order2 = level(of_two - 1, len(two), order1[two % a], own)
            order3 = level(of_three, len(three), order2[three // a - 1], own)
            self.table.append(np.concatenate([*(x.ravel() for x in (order1, order2, order3)), [0.0]]).astype(np.float32))

    def nbytes(self) -> int:
        return sum(t.nbytes for t in (self.pair, self.triple, *self.table))

    def code_lengths(self, column: pa.Array) -> np.ndarray:
        """Nats of each row of texts in each language."""
        data, starts = joined(column)
        a, pad, out = self.a, self.symbol[10], np.zeros((len(column), len(self.langs)))
        for low in range(0, len(data), BLOCK):  # a block's memory is bounded however long a text is
            high = min(low + BLOCK, len(data))
            rows = slice(int(np.searchsorted(starts, low, "right")) - 1, int(np.searchsorted(starts, high)))
            before = np.full(ORDER, pad, np.int64)
            before[ORDER - min(ORDER, low) :] = self.symbol[data[low - min(ORDER, low) : low]]
            s = np.concatenate([before, self.symbol[data[low:high]]])
            edges = np.append(np.maximum(starts[rows], low), high)
            place = np.arange(low, high) - np.repeat(starts[rows], np.diff(edges))
            b, s1, s2, s3 = s[3:], *(np.where(place < k, pad, s[3 - k : len(s) - k]) for k in (1, 2, 3))
            two = self.pair[s2 * a + s1]
            three = self.triple[two * a + s3]
            three[two == 0] = 0
            at = np.where(three > 0, self.third + (three - 1) * a, np.where(two > 0, self.second + (two - 1) * a, s1 * a)) + b
            ends = starts[1:][rows] - 1 - low  # each row's line feed is a byte of no text and costs nothing
            at[ends[ends < high - low]] = len(self.table[0]) - 1
            for k, table in enumerate(self.table):
                out[rows, k] -= np.add.reduceat(table[at], edges[:-1] - low, dtype=np.float64)
        return out


def cells(lang: np.ndarray, gram: np.ndarray) -> int:
    """Bytes of the tables of all languages as one set."""
    symbols = len(np.unique(np.concatenate([gram >> s & 255 for s in (0, 8, 16, 24)]))) + 1
    contexts = len(np.unique(gram >> 8)) + len(np.unique(gram >> 8 & 0xFFFF)) + symbols
    return 4 * contexts * symbols * len(np.unique(lang))


class Forest:
    """The trees of a model: one set of tables, or one for each language, of which those used last are held."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray, most: int = TABLES):
        self.langs, self.most, self.held = langs, most, OrderedDict()
        self.all = Trees(langs, lang, gram, n) if cells(lang, gram) <= most else None
        if self.all is None:
            order = np.argsort(lang, kind="stable")
            self.gram, self.n, self.edges = gram[order], n[order], np.searchsorted(lang[order], np.arange(len(langs) + 1))

    def one(self, k: int) -> Trees:
        if k in self.held:
            self.held.move_to_end(k)
            return self.held[k]
        rows = slice(self.edges[k], self.edges[k + 1])
        made = Trees([self.langs[k]], np.zeros(rows.stop - rows.start, np.int64), self.gram[rows], self.n[rows])
        while self.held and sum(t.nbytes() for t in self.held.values()) + made.nbytes() > self.most:
            self.held.popitem(last=False)
        self.held[k] = made
        return made

    def code_lengths(self, column: pa.Array) -> np.ndarray:
        if self.all is not None:
            return self.all.code_lengths(column)
        return np.concatenate([self.one(k).code_lengths(column) for k in range(len(self.langs))], 1)


def learn(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> tuple:
    """(languages, language, gram and count of what was seen) from about sample bytes of each language."""
    rows = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull())
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    with scratch(df.sparkSession):
        sizes = stored(rows.groupBy(F.col(lang).alias("_covey_lang")).agg(F.sum(F.octet_length(text)).alias("_covey_size")), "language-sizes")
        languages, total = sizes.agg(F.count("*"), F.coalesce(F.sum("_covey_size"), F.lit(0))).first()
        each = min(sample, TOTAL // max(1, languages))
        hot = sizes.where(F.col("_covey_size") * float(HOT) >= max(1, total)).select(F.col("_covey_lang").alias("_covey_hot"), F.col("_covey_size").alias("_covey_most"))

        def drawn(size: str) -> F.Column:
            return F.col("_covey_draw") * F.greatest(F.col(size), F.lit(1)) < each

        # Texts of large languages, which are few, are drawn where they are read; what moves by language is small.
        named = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), draw.alias("_covey_draw"))
        named = named.join(F.broadcast(hot), F.col("lang") == F.col("_covey_hot"), "left").where(F.col("_covey_most").isNull() | drawn("_covey_most"))
        chosen = named.join(sizes, F.col("lang") == F.col("_covey_lang")).where(drawn("_covey_size"))
        found = counts(chosen, "text", "lang").toPandas()
    langs = sorted(found["lang"].unique())
    number = {x: k for k, x in enumerate(langs)}
    return langs, found["lang"].map(number).to_numpy(np.int64), found["gram"].to_numpy(np.int64), found["n"].to_numpy(np.float64)


_made: dict = {}


def predict(df: DataFrame, model: tuple, text: str = "text") -> DataFrame:
    """df with lang_pred and score in place of its column text."""
    kept = others(df, text, "lang_pred", "score")
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        if _made.get("of") is not sent.value:
            _made.update(of=sent.value, trees=Forest(*sent.value) if sent.value[0] else None)
        trees = _made["trees"]
        for batch in batches:
            for part in sliced(batch, text, 1 << 20 if trees is None or trees.all is not None else 1 << 23):
                column = part.column(text)
                letters = np.array([has_letter(x) for x in column.to_pylist()], bool)
                names, scores = np.array([UNKNOWN] * len(column), object), np.zeros(len(column))
                if trees is not None and letters.any():
                    bits = trees.code_lengths(column)
                    best = bits.argmin(1)
                    share = 1 / np.exp(bits.min(1, keepdims=True) - bits).sum(1)
                    names = np.where(letters, np.array(trees.langs, object)[best], UNKNOWN)
                    scores = np.where(letters, share, 0.0)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores)], [*kept, "lang_pred", "score"])

    schema = df.select(*kept).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return df.select(*kept, text).mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
