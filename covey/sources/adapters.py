"""Python data sources for formats that Spark doesn't read: dumps in tar files, worksheets, SQLite tables, query services."""

from __future__ import annotations

import glob
import gzip
import io
import json
import re
import sqlite3
import tarfile
import urllib.parse
import urllib.request
import warnings
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .schemas import OBSERVATION_COLUMNS


def dump_member(names: list[str]) -> str:
    """The first gzip text file of an archive that is no resource fork; raises where there is none."""
    found = [n for n in names if n.endswith(".txt.gz") and not n.rsplit("/", 1)[-1].startswith("._")]
    if not found:
        raise ValueError("the archive has no .txt.gz file")
    if len(found) > 1:
        warnings.warn(f"the archive has {len(found)} .txt.gz files, {found[0]} is read", stacklevel=2)
    return found[0]


class _One(DataSource):
    """A source that one task reads, as its format has no splits; repartition what it gives."""

    fields = ""

    def schema(self) -> str:
        return self.fields

    def reader(self, schema: StructType) -> DataSourceReader:
        return _OneReader(self.rows, dict(self.options), schema)

    @staticmethod
    def rows(options: dict, schema: StructType):
        raise NotImplementedError


class _OneReader(DataSourceReader):
    def __init__(self, rows, options, schema):
        self.rows, self.options, self.schema = rows, options, schema

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        yield from self.rows(self.options, self.schema)


#: Bytes of text that become one Arrow batch.
BLOCK = 8 << 20


def text_blocks(stream, size: int = BLOCK):
    """Whole lines of a stream, as lists of bytes without their line feeds, about size bytes at a time."""
    held = b""
    while block := stream.read(size):
        *lines, held = (held + block).split(b"\n")
        if lines:
            yield lines
    if held:
        yield [held]


def split_fields(lines: list[bytes], names: list[str]) -> pa.RecordBatch:
    """Tab-separated lines as columns: empty and missing fields are null, further ones go."""
    kind = pa.large_string()
    text = pc.utf8_rtrim(pa.array(lines, pa.large_binary()).cast(kind), "\r")
    padded = pc.binary_join_element_wise(text, pa.scalar("\t" * len(names), kind), pa.scalar("", kind))
    fields = pc.split_pattern(padded, "\t")
    columns = (pc.list_element(fields, k) for k in range(len(names)))
    return pa.RecordBatch.from_arrays([pc.if_else(pc.equal(c, ""), None, c).cast(pa.string()) for c in columns], names)


class ObservationTar(_One):
    """Rows of the dump in a tar file, as text by position; option path. Text is streamed block by block, nothing is unpacked to disk.

    The dump is one gzip stream, which only one task can read; what follows is to repartition."""

    fields = ", ".join(f"{n} string" for n, _ in OBSERVATION_COLUMNS)

    @classmethod
    def name(cls) -> str:
        return "observation_tar"

    @staticmethod
    def rows(options, schema):
        head = options.get("header", "true").lower() == "true"
        with tarfile.open(options["path"]) as archive, gzip.open(archive.extractfile(dump_member(archive.getnames()))) as stream:
            for lines in text_blocks(stream):
                if head:
                    del lines[0]
                    head = False
                if lines:
                    yield split_fields(lines, schema.names)


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(reference: str) -> int:
    out = 0
    for c in re.match("[A-Z]+", reference).group():
        out = out * 26 + ord(c) - 64
    return out - 1


def worksheet(data: bytes) -> list[list[str | None]]:
    """The first worksheet's rows as text."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        sheet = min(n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))
        rows = []
        for row in ElementTree.fromstring(book.read(sheet)).iter(f"{_MAIN}row"):
            cells: dict[int, str] = {}
            for cell in row.iter(f"{_MAIN}c"):
                value, kind = cell.find(f"{_MAIN}v"), cell.get("t")
                if kind == "inlineStr":
                    text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                else:
                    text = None if value is None else shared[int(value.text)] if kind == "s" else value.text
                if text is not None:
                    cells[_column(cell.get("r"))] = text
            rows.append([cells.get(k) for k in range(max(cells, default=-1) + 1)])
        return rows


class Worksheet(_One):
    """Rows of an xlsx file's first sheet as text, columns named by its first row; option path."""

    @classmethod
    def name(cls) -> str:
        return "worksheet"

    def schema(self) -> str:
        with open(self.options["path"], "rb") as f:
            head = worksheet(f.read())[0]
        return ", ".join(f"`{h}` string" for h in head if h)

    @staticmethod
    def rows(options, schema):
        with open(options["path"], "rb") as f:
            head, *rows = worksheet(f.read())
        at = [head.index(n) for n in schema.names]
        for row in rows:
            yield tuple(row[k] if k < len(row) else None for k in at)


class SqliteTable(_One):
    """Rows of a table or query of an SQLite file, as text; options path, and table or query."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    @staticmethod
    def _query(options) -> str:
        return options.get("query") or 'SELECT * FROM "{}"'.format(options["table"].replace('"', '""'))

    @staticmethod
    def _open(options):
        return sqlite3.connect(f"file:{urllib.parse.quote(options['path'])}?mode=ro", uri=True)

    def schema(self) -> str:
        db = self._open(self.options)
        try:
            return ", ".join(f"`{d[0]}` string" for d in db.execute(self._query(self.options)).description)
        finally:
            db.close()

    @staticmethod
    def rows(options, schema):
        db = SqliteTable._open(options)
        try:
            for row in db.execute(SqliteTable._query(options)):
                yield tuple(None if v is None else str(v) for v in row)
        finally:
            db.close()


def species_query(limit: int | None = None) -> str:
    """A query for living taxa of species rank with an identifier, for a service that speaks SPARQL."""
    return f"""SELECT ?species ?avibaseID ?scientificName WHERE {{
  ?species wdt:P2026 ?avibaseID ; wdt:P225 ?scientificName ; wdt:P105 wd:Q7432 .
  FILTER NOT EXISTS {{ ?species wdt:P141 wd:Q237350 }}
  FILTER NOT EXISTS {{ ?species wdt:P141 wd:Q239509 }}
  FILTER NOT EXISTS {{ ?species wdt:P582 ?end }}
  FILTER NOT EXISTS {{ ?species wdt:P31 wd:Q23038290 }}
}}{f" LIMIT {limit}" if limit else ""}"""


def label_query(entities: list[str], languages: list[str]) -> str:
    """A query for the labels of entities in languages."""
    values = " ".join(f"wd:{e}" for e in entities)
    tags = ", ".join(f'"{x}"' for x in languages)
    return f"SELECT ?species ?label ?lang WHERE {{ VALUES ?species {{ {values} }} ?species rdfs:label ?label . BIND(LANG(?label) AS ?lang) FILTER(?lang IN ({tags})) }}"


class _Batch(InputPartition):
    def __init__(self, query: str):
        super().__init__(query)


class _ServiceReader(DataSourceReader):
    def __init__(self, options, schema):
        self.options, self.names = options, schema.names

    def partitions(self):
        if "answers" in self.options:
            return [_Batch(path) for path in sorted(glob.glob(self.options["answers"]))]
        return [_Batch(q) for q in json.loads(self.options["queries"])]

    def read(self, partition):
        if "answers" in self.options:
            with open(partition.value, encoding="utf-8") as answer:
                yield from self.rows(answer)
            return
        data = urllib.parse.urlencode({"query": partition.value, "format": "json"}).encode()
        request = urllib.request.Request(self.options["endpoint"], data, {"Accept": "application/sparql-results+json", "User-Agent": "covey"})
        with urllib.request.urlopen(request, timeout=float(self.options.get("timeout", "300"))) as answer:  # a failed batch fails the job
            yield from self.rows(answer)

    def rows(self, answer):
        for row in json.load(answer)["results"]["bindings"]:
            yield tuple(row.get(n, {}).get("value") for n in self.names)


class QueryService(DataSource):
    """Answers of a SPARQL service, a task for each query; options endpoint, queries (a JSON list), timeout. Give a schema of its variables.

    With the option answers, a pattern of files, saved answers are read instead, a task for each file."""

    @classmethod
    def name(cls) -> str:
        return "query_service"

    def schema(self):
        return "species string, label string, lang string"

    def reader(self, schema):
        return _ServiceReader(dict(self.options), schema)


def register(spark) -> None:
    for source in (ObservationTar, Worksheet, SqliteTable, QueryService):
        spark.dataSource.register(source)
