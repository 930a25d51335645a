"""Main text of HTML pages by maximum-scoring subsequence.

A page is read as a sequence of tokens, words and tags. Each has a weight: a word counts for the content
as far as words of its class (its block element, whether it is in a link, whether it stands in the page's
article, whether in an element that is boilerplate by its tag or role) were content in labelled pages, and,
outside of a marked article, as far as words under the names of the elements around it (classes and ids,
whole ones) were; a tag counts against it. One linear scan finds the contiguous range of tokens with the
largest sum; its words are the main text. Words of holes in that range are left out: elements that are
boilerplate by tag or role, are hidden, or are containers (CONTAINERS) whose names labelled pages show to
hold no content. In a marked article such a name must have had CUT_WORDS words or more, on CUT_PAGES pages or
more, of which at most CUT_SHARE were content; without a mark its weight must be -HOLE or less.

Labels: a page that marks its article by <article>, or without one by <main>, is a labelled page; words in
it, outside boilerplate, are content. Each labelled page is counted twice, as it is and with that mark
overlooked, so that there are weights for pages without the mark as well. Weights are log odds with a count
of one added to each side, for names against those of all words, from a sample of about SAMPLE pages chosen
by a hash; a word's weight is at least -LIMIT and at most LIMIT, a tag's at least -LIMIT and below 0.
Elements that HTML doesn't have are of one class, so the number of classes is bounded; names count if they
are on NAME_PAGES of the sample's pages and a NAME_SHARE of them, so their number is at most that of an
average page's names over that share. Boilerplate words cost BRIDGE each, LIMIT outside a marked article and
nothing within. Without a weight FALLBACK is used; names of which labelled pages tell nothing weigh nothing,
but for a few (TELLING), which start at -PRIOR and only count on pages without a mark.

Character references are decoded, white space in a block becomes one space, blocks are joined by an empty
line. A line break is white space. Runs of words are scored at once, as all words of a text node have the
same class. A button is a control, and left out, unless it stands in a heading or a paragraph.

Defined results: a null, empty or wordless page has an empty text; a tag or comment that is cut off at the
end of the page is markup; an element that is left out, but isn't raw text, is read as any other if it has no
end tag, and is empty if its tag closes itself; ties go to the range that starts first, and then to the shorter one; rows that
repeat are read as often as they come; columns of the input that are called like a result column are
replaced, all others are carried along.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .columns import others

SAMPLE = 20_000
LIMIT = 4.0
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"  # with a quote that isn't closed
    r"|([^<]+|<)",
    re.S | re.I,
)
#: Elements that are left out up to their end tag; without one, those of raw text go to the end of the page.
_RAW = frozenset("script style textarea title iframe".split())
_LEFT_OUT = _RAW | frozenset("noscript template svg select button object canvas audio video".split())
_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in _LEFT_OUT}
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
#: Elements and roles that HTML and ARIA define as something else than the article.
_BOILERPLATE_TAGS = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "fieldset"))
_BOILERPLATE_ROLES = frozenset("navigation complementary contentinfo search dialog alertdialog alert form menu menubar toolbar tablist".split())
#: Names that weigh against content on pages without a mark until labelled pages tell more.
TELLING = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie cookies footer header menu nav navbar navigation "
    "newsletter notice pagination popup promo related share sidebar social sponsored subscribe widget".split()
)
#: Elements that group blocks, and so can be a hole by their names.
CONTAINERS = frozenset("div section ul ol dl details center".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: All other elements of HTML that can hold words.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br caption cite code data del dfn em font hgroup i img input ins kbd label legend mark optgroup "
    "output progress q rp rt ruby s samp search small span strike strong sub sup time tt u var wbr button canvas svg video audio".split()
)
_ARTICLE = re.compile(r"<article[\s>/]", re.I)
_TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p summary".split())
#: Open elements that a new block element ends, as browsers do.
_CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
#: Weights of what no labelled page showed; the least that a tag costs; what a word of boilerplate costs without a mark.
FALLBACK: dict[str, float] = {"in": 2.0, "out": -2.0, "link": -1.0, "free": 1.0, "tag": -0.25}
LEAST, BRIDGE, PRIOR, HOLE = 0.01, 1.0, 5.0, 3.0
NAME_PAGES, NAME_SHARE = 5, 0.001
CUT_WORDS, CUT_PAGES, CUT_SHARE = 200, 20, 0.01


def _named(attributes: str) -> tuple[list[str], str]:
    """The classes and ids of an element, each once, and its role."""
    names, role = [], ""
    for key, *values in _NAMES.findall(attributes):
        if key.lower() == "role":
            role = "".join(values).strip().lower()
        else:
            names += "".join(values).lower().split()
    return list(dict.fromkeys(names)), role


def read(page: str | None, weights: dict[str, float] | None = None, spans: list | None = None) -> list[tuple]:
    """A page as ("tag", name, breaks a block, marked) and ("text", text, block, in a link, marked, a hole, names' weight), in order.

    weights: those of names. spans: takes (name, words of content, words) of each outermost element of a name."""
    out: list[tuple] = []
    open_: list[tuple] = []  # name, boilerplate, marked, links it is in, its block element, names' weight, own names, words before
    held: Counter[str] = Counter()  # how many elements of a name are open
    named: Counter[str] = Counter()  # how many elements of a class or id are open
    none = ("", False, False, 0, "body", 0.0, (), (0, 0))
    endless: set[str] = set()  # names without an end tag from here on
    page, at, weights = page or "", 0, weights or {}
    mark = "article" if _ARTICLE.search(page) else "main"
    content = words = 0

    def end(k: int) -> None:
        while len(open_) > k:
            tag, *_, names, before = open_.pop()
            held[tag] -= 1
            for n in names:
                named[n] -= 1
                if spans is not None and not named[n]:
                    spans.append((n, content - before[0], words - before[1]))

    while m := TOKEN.match(page, at):
        at = m.end()
        closing, tag, attributes, closing2, tag2, attributes2, text = m.groups()
        if text is not None:
            _, bad, marked, links, block, evidence, _, _ = open_[-1] if open_ else none
            out.append(("text", text, block, links > 0, marked, bad, evidence))
            if spans is not None:
                size = len(text.split())
                words += size
                content += size * (marked and not bad)
            continue
        closing, tag, attributes = (closing, tag, attributes) if tag else (closing2, tag2, attributes2)
        if not tag:
            continue
        tag = tag.lower()
        if not closing and tag in _LEFT_OUT and not (tag == "button" and open_ and open_[-1][4] in _TEXTUAL):
            if attributes.endswith("/") and (tag == "iframe" or tag not in _RAW):
                continue
            if tag not in endless and (stop := _END[tag].search(page, at)):
                at = stop.end()
                continue
            if tag in _RAW:
                break
            endless.add(tag)
        breaks = tag in BLOCKS
        marked = bool(open_ and open_[-1][2]) or not closing and tag == mark
        out.append(("tag", "/" + tag if closing else tag, breaks, marked))
        if closing:
            if not held[tag]:
                continue
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag:
                    end(k)
                    break
                if open_[k][0] == mark and tag not in ("body", "html"):
                    break  # a stray end tag doesn't end what surrounds it
        elif tag not in _VOID and not attributes.endswith("/"):
            if ends := _CLOSES.get(tag):
                while open_ and open_[-1][0] in ends:
                    end(len(open_) - 1)
            elif breaks and open_ and open_[-1][0] == "p":
                end(len(open_) - 1)
            _, bad, marked, links, block, evidence, _, _ = open_[-1] if open_ else none
            inside = marked or tag == mark
            names, role = _named(attributes) if attributes and tag not in ("html", "body") else ((), "")
            if not bad and tag != mark:
                bad = tag in _BOILERPLATE_TAGS or tag == "header" and not inside or role in _BOILERPLATE_ROLES or bool(attributes and _HIDDEN.search(attributes)) and tag not in ("html", "body")
            if names:
                own = sum(weights.get(f"name {n}", -PRIOR if n in TELLING else 0.0) for n in names if not named[n])
                evidence += own
                if not bad and spans is None and tag in CONTAINERS:  # labels come from tags and roles alone
                    bad = any(f"cut {n}" in weights for n in names) if inside else own <= -HOLE
                for n in names:
                    named[n] += 1
            open_.append((tag, bad, inside, links + (tag == "a"), tag if breaks else block, evidence, names, (content, words)))
            held[tag] += 1
    end(0)
    return out


def _kind(tag: str) -> str:
    """The element, or one name for all that HTML doesn't have."""
    name = tag.removeprefix("/")
    return tag if name in BLOCKS or name in _INLINE else "/other" if tag != name else "other"


def tag_class(name: str, marked: bool, has_mark: bool) -> str:
    return f"tag {'in' if has_mark and marked else 'out' if has_mark else 'free'} {_kind(name)}"


def word_class(block: str, link: bool, marked: bool, bad: bool, has_mark: bool) -> str:
    return f"word {'in' if has_mark and marked else 'out' if has_mark else 'free'} {'link' if link else 'text'} {'boilerplate' if bad else block}"


def observed(page: str | None) -> list[tuple[str, int, int]]:
    """(class or name, words or tags in the content, all) of a labelled page, read with its mark and without."""
    spans: list[tuple[str, int, int]] = []
    tokens = read(page, spans=spans)
    if not any(t[3] for t in tokens if t[0] == "tag"):
        return []
    found: dict[str, list[int]] = {}
    for t in tokens:
        for has_mark in (True, False):
            if t[0] == "tag":
                name, size, content = tag_class(t[1], t[3], has_mark), 1, t[3]
            else:
                _, text, block, link, marked, bad, _ = t
                name, size, content = word_class(block, link, marked, bad, has_mark), len(text.split()), marked and not bad
                if has_mark:
                    n = found.setdefault("all", [0, 0])
                    n[0] += size * content
                    n[1] += size
            n = found.setdefault(name, [0, 0])
            n[0] += size * content
            n[1] += size
    for name, content, size in spans:
        n = found.setdefault(f"name {name}", [0, 0])
        n[0] += content
        n[1] += size
    return [(k, *v) for k, v in found.items()]


def learn(df: DataFrame, page: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights by class and by name from about sample of df's rows, and which names make a hole in an article."""
    rows = df.where(F.col(page).isNotNull())
    share = min(1.0, sample / max(1, rows.count()))
    draw = F.pmod(F.xxhash64(F.lit("page"), *df.columns), F.lit(1 << 30))
    chosen = rows.where(draw < int((1 << 30) * share)).select(F.col(page).alias("page"))
    fields = ("content", "n", "pages")

    def run(batches):
        for batch in batches:
            sums: dict[str, list[int]] = {}
            for p in batch.column("page").to_pylist():
                for name, content, all_ in observed(p):
                    n = sums.setdefault(name, [0, 0, 0])
                    n[0] += content
                    n[1] += all_
                    n[2] += 1
            yield pa.RecordBatch.from_pydict({"name": list(sums), **{f: [n[k] for n in sums.values()] for k, f in enumerate(fields)}}, schema=pa.schema([("name", pa.string()), *((f, pa.int64()) for f in fields)]))

    seen = chosen.mapInArrow(run, "name string, content long, n long, pages long").groupBy("name").agg(*(F.sum(f).alias(f) for f in fields))
    # What is collected is bounded: classes by the elements of HTML, names by the pages that each must be on.
    least = max(NAME_PAGES, int(NAME_SHARE * sample))
    few = seen.where((~F.col("name").startswith("name ") & (F.col("n") >= 5)) | (F.col("pages") >= (least if share < 1 else NAME_PAGES))).orderBy("name").collect()
    odds = lambda content, n: math.log((content + 1) / (n - content + 1))
    clip = lambda x, high: max(-LIMIT, min(high, x))
    base = next((odds(r["content"], r["n"]) for r in few if r["name"] == "all"), 0.0)
    out: dict[str, float] = {}
    for name, content, n, pages in few:
        if name.startswith("name "):
            out[name] = clip(odds(content, n) - base, LIMIT)
            if n >= CUT_WORDS and pages >= CUT_PAGES and content <= CUT_SHARE * n:
                out["cut " + name.removeprefix("name ")] = 1.0
        elif name != "all":
            out[name] = clip(odds(content, n), LIMIT if name[0] == "w" else -LEAST)
    return out


def weight(weights: dict[str, float], name: str) -> float:
    kind, mark, rest = name.split(" ", 2)
    if rest.endswith(" boilerplate"):  # it is left out anyway; an article may span a few words of it
        return {"in": 0.0, "out": -LIMIT, "free": -BRIDGE}[mark]
    found = weights.get(name)
    if found is not None:
        return found
    if kind == "tag":
        return -LEAST if mark == "in" else FALLBACK["tag"]
    return FALLBACK[mark] + (FALLBACK["link"] if rest.startswith("link ") else 0.0)


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The page's main text: its blocks, joined by an empty line."""
    tokens = read(page, weights)
    has_mark = any(t[0] == "text" and t[4] and not t[5] and t[1].strip() for t in tokens)
    best, best_range, total, start = 0.0, (0, -1), 0.0, 0
    for k, t in enumerate(tokens):
        if t[0] == "tag":
            total += weight(weights, tag_class(t[1], t[3], has_mark))
        else:
            each = weight(weights, word_class(t[2], t[3], t[4], t[5], has_mark))
            if t[6] and not t[5] and not (has_mark and t[4]):
                each = max(-LIMIT, min(LIMIT, each + t[6]))
            total += len(t[1].split()) * each
        if total <= 0:
            total, start = 0.0, k + 1
        elif total > best:
            best, best_range = total, (start, k)
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        block = " ".join("".join(parts).split())
        parts.clear()
        if block:
            blocks.append(block)

    for t in tokens[best_range[0] : best_range[1] + 1]:
        if t[0] == "tag":
            if t[2]:
                flush()
            elif t[1] == "br":
                parts.append(" ")
        elif not t[5]:
            parts.append(references.unescape(t[1]))
    flush()
    return "\n\n".join(blocks)


def main_text(df: DataFrame, weights: dict[str, float], page: str = "html", name: str = "text") -> DataFrame:
    """df with the main text of each whole page in place of it."""
    kept = others(df, page, name)
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, T.StringType())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = pa.array([extract(p, weights) for p in part.column(page).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), texts], schema.names)

    return df.select(*kept, page).mapInArrow(run, schema)


def op9_main_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = main_text(pages.select("page_id", "url", "html"), learn(pages))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
