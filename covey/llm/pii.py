"""Personal data with offsets that survive deobfuscation.

Plain identifiers are found in the text itself. Then transducers rewrite disguised text: characters that
look like ASCII ones (other scripts, full width, mathematical), digits of any script, invisible
characters, bracketed or spaced at and dot, digits spelled as words. Each rewriting keeps, for every
character it gives, the range of source characters that it came from, and two are chained by mapping
ranges through. Identifiers are detected in the rewritten text and their spans are mapped back to the
source. Spans found so are added where they reach beyond each plain one that they meet, which may be a part
of the disguised one; plain ones always stay, and redaction takes overlapping spans as one.

A span is (kind, start, end) in code points, the end exclusive. Kinds, in the order of results: email, ip,
card, phone.

All patterns go through a text a bounded number of times, whatever it holds.

Defined results: a null text is an empty one, without spans; rows that repeat are scanned as often as they
come; an empty table gives an empty table; columns of the input that are called like a result column are
replaced, all others are carried along.
"""

from __future__ import annotations

import bisect
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .columns import others

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: From a run's first digit only: no other one of it can do better, and a long run is gone through once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def plain(text: str) -> list[Span]:
    """Identifiers as they stand in the text: leftmost matches that don't overlap, by kind; failing ones are dropped."""
    found: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:  # an address has its first @ right after the run of local characters
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append(("email", start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


# Letters of other scripts that look like the ASCII letter below them.
_LOOKS = "АВЕЗКМНОРСТХУаеорсухіјѕԁԛԝһΑΒΕΖΗΙΚΜΝΟΡΤΥΧοιν"
_LIKE_ = "ABE3KMHOPCTXYaeopcyxijsdqwhABEZHIKMNOPTYXoiv"
_MAP: dict[str, str] = dict(zip(_LOOKS, _LIKE_, strict=True))
_MAP |= dict.fromkeys(map(chr, (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)), "")  # invisible
_MAP |= dict.fromkeys(map(chr, (*range(0x2010, 0x2016), 0x2212, 0xFE63)), "-")  # dashes
_MAP |= dict.fromkeys(map(chr, (0xA0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)), " ")  # spaces
_MAP |= dict.fromkeys(map(chr, (0x3002, 0xFF61, 0x2024)), ".")  # full stops
#: Ranges that the first transducer may rewrite; accented Latin letters are in none of them.
_RANGES = (
    (0xA0, 0xA0), (0xAD, 0xAD), (0x370, 0x52F), (0x660, 0x669), (0x6F0, 0x6F9), (0x966, 0x96F), (0x2000, 0x2015), (0x2024, 0x2024),
    (0x202F, 0x202F), (0x205F, 0x2060), (0x2212, 0x2212), (0x2460, 0x24FF), (0x3000, 0x3002), (0xFE50, 0xFE6F), (0xFEFF, 0xFEFF),
    (0xFF01, 0xFF65), (0x1D400, 0x1D7FF),
)
_ODD = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _RANGES) + "]")
_ZERO_TO_NINE = (
    "zero one two three four five six seven eight nine",
    "oh eins zwei drei vier fünf sechs sieben acht neun",
    "null un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
_WORD: dict[str, str] = {w: str(d) for line in _ZERO_TO_NINE for d, w in enumerate(line.split())} | {"zéro": "0", "ein": "1", "une": "1"}
#: Digits that are ordinary words too give no cause to look closer.
_SURE = frozenset(_WORD) - {"oh", "null", "ein", "un", "une", "uno"}
_NAMES = "|".join(sorted(_WORD, key=len, reverse=True))
_UNIT = rf"(?:{_NAMES}|[0-9]++)"
_GAP = r"[\x20,;/_-]{1,3}"
_DOTS = r"(?:dot|point|punkt|punto)"
_ATS = r"(?:at|arroba)"
#: A chain of digits in words, which may be parted by dots or a plus that are spelled too, and its units.
_CHAIN = re.compile(rf"(?<!\w)(?:(?:plus|\+){_GAP}?)?(?:{_NAMES})(?:{_GAP}(?:{_DOTS}{_GAP})?{_UNIT})*+", re.I)
_UNITS = re.compile(_UNIT, re.I)
_TOKEN = re.compile(rf"(plus|\+)|({_DOTS})|({_NAMES})|([0-9]+)", re.I)
_BRACKET = re.compile(rf"[\[({{<]\s*(?:({_ATS}|@)|({_DOTS}|\.))\s*[\])}}>]", re.I)
_SPACED_DOT = re.compile(rf"(?<!\s)\s++{_DOTS}\s++", re.I)
_NO_SPACE = re.compile(r"\S|\Z")
_SPACED = re.compile(rf"(?<![\w.%@+-])[A-Za-z0-9._%+-]+(\s+{_ATS}\s+|\s*@\s*)[A-Za-z0-9-]+((?:(?:\s+{_DOTS}\s+|\s*\.\s*)[A-Za-z0-9-]+)*?\s+{_DOTS}\s+)[A-Za-z0-9-]{{2,}}(?![\w-])", re.I)
_SPACED_AT = re.compile(rf"(?<![\w.%@+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*(\s+{_ATS}\s+)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?:com|org|net|edu|gov|info|io|de|fr|es)(?![\w-])", re.I)
#: What a text must have for the patterns above to match; never narrower than they are.
_AT_WORD, _DOT_WORD = re.compile(rf"\s{_ATS}\s", re.I), re.compile(_DOTS, re.I)


class Rewritten:
    """A text and, for each of its characters, the range of source characters it came from."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, range(len(text)), range(1, len(text) + 1)

    def replace(self, changes: list[tuple[int, int, str]]) -> Rewritten:
        """With the ranges of characters, in order, replaced; each new character comes from its whole range."""
        out, start, end, at = [], [], [], 0
        for a, b, new in changes:
            out += [self.text[at:a], new]
            start += [*self.start[at:a], *([self.start[a]] * len(new))]
            end += [*self.end[at:a], *([self.end[b - 1]] * len(new))]
            at = b
        made = Rewritten("")
        made.text = "".join([*out, self.text[at:]])
        made.start, made.end = [*start, *self.start[at:]], [*end, *self.end[at:]]
        return made


def _ascii(c: str) -> str:
    if c in _MAP:
        return _MAP[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if folded.isascii() else c


def look_alikes(text: Rewritten) -> Rewritten:
    """Characters that stand for ASCII ones; letters of other scripts only in a word that has ASCII in it too."""
    changes = []
    for m in re.finditer(r"\S+|\s+", text.text):
        if not _ODD.search(m.group()):
            continue
        mixed = any(c.isascii() and c.isalnum() for c in m.group()) or "@" in m.group() or "＠" in m.group()
        for k, c in enumerate(m.group(), m.start()):
            if _ODD.match(c) and (mixed or c not in _MAP or not c.isalpha()):
                new = _ascii(c)
                if new != c:
                    changes.append((k, k + 1, new))
    return text.replace(changes)


def chains(text: str) -> list[tuple[int, int]]:
    """Runs of at least four digits in words, which end where no word goes on; each chain is gone through once."""
    out = []
    for m in _CHAIN.finditer(text):
        ends = [u.end() for u in _UNITS.finditer(text, *m.span())]
        while len(ends) >= 4 and ends[-1] < len(text) and (text[ends[-1]].isalnum() or text[ends[-1]] == "_"):
            ends.pop()
        if len(ends) >= 4:
            out.append((m.start(), ends[-1]))
    return out


def spelled_digits(text: Rewritten) -> Rewritten:
    changes = []
    for a, b in chains(text.text):
        new = "".join("+" if plus else "." if dot else _WORD[word.lower()] if word else digits for plus, dot, word, digits in _TOKEN.findall(text.text[a:b]))
        changes.append((a, b, new))
    return text.replace(changes)


def bracketed(text: str) -> list[tuple[int, int, str]]:
    """At and dot in brackets, with the white space on both sides."""
    changes, last = [], 0
    for m in _BRACKET.finditer(text):
        start = m.start()
        while start > last and text[start - 1].isspace():
            start -= 1
        last = _NO_SPACE.search(text, m.end()).start()
        changes.append((start, last, "@" if m.group(1) else "."))
    return changes


def separators(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """Dots, spelled or not, with the white space around them, in a range that is nothing but names and these."""
    out = []
    for m in re.finditer(r"[^A-Za-z0-9-]+", text[start:end]):
        if "." in m.group():
            out.append((start + m.start(), start + m.end(), "."))
    return sorted([*out, *((*m.span(), ".") for m in _SPACED_DOT.finditer(text, start, end))])


def at_and_dot(text: Rewritten) -> Rewritten:
    text = text.replace(bracketed(text.text))
    changes = [(*m.span(1), "@") for m in _SPACED_AT.finditer(text.text)]
    taken = {a for a, _, _ in changes}
    for m in _SPACED.finditer(text.text):
        if m.start(1) not in taken:
            changes.append((*m.span(1), "@"))
            changes += separators(text.text, *m.span(2))
    return text.replace(sorted(changes))


def disguised(text: str) -> list[Span]:
    """Identifiers that only show after rewriting, mapped back to the text."""
    low = text.lower()
    odd = not text.isascii() and _ODD.search(text) is not None
    dots = any(w in low for w in ("dot", "point", "punkt", "punto")) or not text.isascii() and _DOT_WORD.search(text) is not None
    ats = "@" in text or _AT_WORD.search(text) is not None
    marks = any(c in text for c in "[({<") and _BRACKET.search(text) is not None or ats and (dots or _SPACED_AT.search(text) is not None)
    for c in ",;/_-.":
        low = low.replace(c, " ")
    words = not _SURE.isdisjoint(low.split()) and bool(chains(text))
    if not (odd or marks or words):
        return []
    made = Rewritten(text)
    for step, on in ((look_alikes, odd), (spelled_digits, words or odd), (at_and_dot, True)):
        if on:
            made = step(made)
    if made.text == text:
        return []
    return [(kind, made.start[a], made.end[b - 1]) for kind, a, b in plain(made.text)]


def spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """The plain spans of a text and all its spans, each in the order of kinds and then starts."""
    text = text or ""
    order = lambda found: sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))
    base = plain(text)
    extra: list[Span] = []
    found = disguised(text)
    if found:
        starts, reach = sorted(s[1] for s in base), []
        for _, _, end in sorted(base, key=lambda s: s[1]):
            reach.append(max(end, reach[-1] if reach else 0))
        taken: list[tuple[int, int]] = []  # in order, apart from each other
        for s in found:
            before = bisect.bisect_right(starts, s[1])
            if before and reach[before - 1] >= s[2]:
                continue  # it lies in a plain one
            k = bisect.bisect_left(taken, (s[1], s[2]))
            if (k == 0 or taken[k - 1][1] <= s[1]) and (k == len(taken) or taken[k][0] >= s[2]):
                taken.insert(k, (s[1], s[2]))
                extra.append(s)
    return order(base), order(base + extra)


def detect(df: DataFrame, text: str = "text", name: str = "spans", keep_text: bool = False) -> DataFrame:
    """df with plain_<name> and <name>, arrays of (kind, start, end), in place of its column text or beside it."""
    added = T.StructType.fromDDL(f"`plain_{name}` array<struct<kind:string,start:int,end:int>>, `{name}` array<struct<kind:string,start:int,end:int>>")
    kept = others(df, *added.names, *([] if keep_text else [text]))
    schema = T.StructType([*(df.schema[c] for c in kept), *added])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        as_rows = lambda found: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in found]
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = [spans(t) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *(pa.array([as_rows(f[k]) for f in found], kind) for k in (0, 1))], schema.names)

    return df.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


def redacted(text: str | None) -> str | None:
    """The text with each span, overlapping ones as one, replaced by its kind."""
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in sorted(spans(text)[1], key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """df with personal data in its column text replaced by [EMAIL], [IP], [CARD] or [PHONE]."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                yield part.set_column(at, text, pa.array([redacted(t) for t in part.column(text).to_pylist()], pa.string()))

    return df.mapInArrow(run, df.schema)


def _joined(column: str) -> F.Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_personal_data(spark, sf_dir: str) -> DataFrame:
    found = detect(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    of_kind = lambda kind: F.size(F.filter("plain_spans", lambda s: s["kind"] == kind))
    counts = [of_kind(k).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("plain_spans").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
