"""HTML and Markdown structure, by the standard library's parser in vectorised functions over whole pages."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser
from operator import itemgetter
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

DROPPED = {"script", "style", "noscript", "svg", "iframe"}
BOILERPLATE = {"nav", "footer", "header", "aside", "form"}
BLOCKS = {"p", "div", "section", "article", "main", "table", "tr", "ul", "ol", "dl", "dd", "dt", "blockquote", "pre", "body", "html"}
HEADINGS = {f"h{i}": i for i in range(1, 7)}
VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}


class _Page(HTMLParser):
    """Title, headings, anchors, JSON-LD scripts and Markdown of a page in one pass; unclosed tags are tolerated."""

    def __init__(self, main_only: bool = True):
        super().__init__(convert_charrefs=True)
        self.main_only = main_only
        self.title: list[str] = []
        self.h1: list[str] = []
        self.anchors: list[tuple[str, list[str]]] = []
        self.ld: list[str] = []
        self.out: list[str] = []
        self.skip: list[str] = []
        self.within: dict[str, int] = {}
        self.script: str | None = None
        self.rows, self.cells, self.cell = 0, 0, 0  # of the table at hand; cell: how many tables deep its open cell is

    def _close_row(self) -> None:
        if self.cells:
            self.out.append(" |\n")
            if not self.rows:
                self.out.append("|" + " - |" * self.cells + "\n")
            self.rows += 1
        self.cells = self.cell = 0

    def _table(self, tag: str, begins: bool) -> bool:
        """Writes tables as pipe tables, the first row over a line of dashes; what a cell holds stays on its line, and a
        table within a cell is its text. Whether the tag is done with."""
        if self.cell:
            if tag == "table":
                self.cell += 1 if begins else -1
                if not self.cell:
                    self._close_row()
                    self.out.append("\n")
            elif self.cell == 1 and tag == "tr":
                self._close_row()
            elif self.cell == 1 and begins and tag in ("td", "th"):
                self.cells += 1
                self.out.append(" | ")
            elif tag in BLOCKS or tag in HEADINGS or tag in ("li", "dt", "br"):
                self.out.append(" ")
            return True
        if tag == "table":
            self.rows = self.cells = 0
            self.out.append("\n\n")
        elif tag in ("td", "th") and begins:
            self.cells, self.cell = self.cells + 1, 1
            self.out.append("| " if self.cells == 1 else " | ")
        elif tag == "tr":
            self._close_row()
        return tag in ("table", "tr", "td", "th", "tbody", "thead", "tfoot")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        named = dict(attrs)
        if tag in VOID:
            if tag == "br":
                self.out.append(" " if self.cell else "\n")
            return
        if tag == "dd" and self.within.get("dt"):  # the term was not closed
            self.handle_endtag("dt")
        self.within[tag] = self.within.get(tag, 0) + 1
        if tag == "script" and named.get("type") == "application/ld+json":
            self.script = ""
        if tag in DROPPED or (self.main_only and tag in BOILERPLATE):
            self.skip.append(tag)
        if tag == "a":
            self.anchors.append((named.get("href") or "", []))
        if self.skip or self._table(tag, True):
            return
        if tag in HEADINGS:
            self.out.append("\n\n" + "#" * HEADINGS[tag] + " ")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag == "dt":
            self.out.append("\n\n**")
        elif tag in BLOCKS and tag != "dd":
            self.out.append("\n\n")

    def handle_endtag(self, tag: str) -> None:
        if self.within.get(tag):
            self.within[tag] -= 1
        if tag == "script" and self.script is not None:
            self.ld.append(self.script)
            self.script = None
        if self.skip:
            if tag in self.skip:
                while self.skip and self.skip.pop() != tag:
                    pass
            return
        if self._table(tag, False):
            return
        if tag == "dt":
            self.out.append(":** ")
        elif tag in HEADINGS or (tag in BLOCKS and tag != "dt"):
            self.out.append("\n\n")

    def handle_data(self, data: str) -> None:
        if self.script is not None:
            self.script += data
        if self.within.get("title") and not self.skip:
            self.title.append(data)
            return
        if self.within.get("h1") and len(self.h1) < 64:
            self.h1.append(data)
        if self.within.get("a") and self.anchors:
            self.anchors[-1][1].append(data)
        if not self.skip:
            self.out.append(re.sub(r"\s+", " ", data))

    def markdown(self) -> str:
        text = "".join(self.out)
        text = re.sub(r"[ \t]*\n[ \t]*", "\n", re.sub(r"[ \t]{2,}", " ", text))
        text = re.sub(r"\n#{1,6}\s*(?=\n)|\n-\s*(?=\n)|\*\*:\*\*", "\n", text)
        return re.sub(r"\n{3,}", "\n\n", text).strip()


def parsed(html: str | None, main_only: bool = True) -> _Page:
    page = _Page(main_only)
    page.feed(html or "")
    page.close()
    return page


def joined(parts: list[str]) -> str:
    return re.sub(r"\s+", " ", " ".join(parts)).strip()


def to_markdown(html: Column, main_only: bool = True) -> Column:
    """Markdown of a page's content: ATX headings, "-" bullets, terms of lists in bold; without boilerplate if wished."""
    return F.pandas_udf(lambda s: s.map(lambda h: parsed(h, main_only).markdown()), StringType())(html)


def ld_scripts(html: Column) -> Column:
    """The page's JSON-LD scripts as an array of texts."""
    return F.pandas_udf(lambda s: s.map(lambda h: parsed(h).ld), ArrayType(StringType()))(html)


def anchors_parsed(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """key, pos, url, text of all anchors, whatever their quoting, resolved by the standard library's rules."""
    kind = StructType([StructField("pos", IntegerType()), StructField("url", StringType()), StructField("text", StringType())])

    def one(bases: pd.Series, sources: pd.Series) -> pd.Series:
        return pd.Series([[(n, resolved(base, href), joined(text)) for n, (href, text) in enumerate(parsed(h, False).anchors)] for base, h in zip(bases, sources, strict=True)])

    found = F.pandas_udf(one, ArrayType(kind))(F.col(url), F.col(html))
    return pages.select(key, F.explode(found).alias("a")).select(key, "a.*")


def resolved(base: str, href: str) -> str | None:
    try:
        return urldefrag(urljoin(base or "", (href or "").strip()))[0].strip("/")
    except ValueError:
        return None


def resolve_any(base: Column, href: Column) -> Column:
    """urljoin without fragment and slashes at the ends, for references with dot segments and odd forms."""
    return F.pandas_udf(lambda b, h: pd.Series([resolved(x, y) for x, y in zip(b, h, strict=True)]), StringType())(base, href)


BLOCK = "`{key}` {kind}, block int, type string, level int, content string"


def markdown_blocks(text: str) -> Iterator[tuple[str, int, str]]:
    """(type, level, content) of a Markdown text's blocks: headings (ATX, or a line over === or ---), tables, code, text.

    Pipe tables are runs of lines with a leading pipe; HTML tables end where as many are closed as opened; fenced code
    is kept whole.
    """
    lines = (text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n")
    held: list[str] = []

    def flush() -> Iterator[tuple[str, int, str]]:
        body = "\n".join(held).strip()
        held.clear()
        if body:
            yield "text", 0, body

    i = 0
    while i < len(lines):
        line = lines[i]
        if m := re.match(r"(#{1,6})[ \t]+(\S.*)", line):
            yield from flush()
            yield "heading", len(m[1]), m[2].strip().rstrip("#").strip()
        elif line.strip() and i + 1 < len(lines) and re.fullmatch(r"\s*(=+|-{3,})\s*", lines[i + 1]):
            yield from flush()
            yield "heading", 1 if "=" in lines[i + 1] else 2, line.strip()
            i += 1
        elif line.lstrip().startswith("```"):
            yield from flush()
            end = next((k for k in range(i + 1, len(lines)) if lines[k].lstrip().startswith("```")), len(lines) - 1)
            yield "code", 0, "\n".join(lines[i : end + 1])
            i = end
        elif line.lstrip().startswith("|"):
            yield from flush()
            end = i
            while end + 1 < len(lines) and lines[end + 1].lstrip().startswith("|"):
                end += 1
            yield "table", 0, "\n".join(lines[i : end + 1])
            i = end
        elif "<table" in line.lower():
            yield from flush()
            depth, end = 0, i
            while end < len(lines):
                low = lines[end].lower()
                depth += low.count("<table") - low.count("</table")
                if depth <= 0:
                    break
                end += 1
            yield "table", 0, "\n".join(lines[i : end + 1])
            i = end
        else:
            held.append(line)
        i += 1
    yield from flush()


def blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, block (from 0), type, level, content of every document's Markdown."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, n, *b) for k, t in zip(pdf[key], pdf[text], strict=True) for n, b in enumerate(markdown_blocks(t))]
            yield pd.DataFrame(rows, columns=[key, "block", "type", "level", "content"])

    return docs.select(key, text).mapInPandas(run, BLOCK.format(key=key, kind=kind))


def page_chunks(text: str, target: int = 6500, most: int = 9000, least: int = 250, overlap: int = 350) -> Iterator[tuple[str, str, bool]]:
    """(section title, content, has a table) of a layout document's chunks.

    Blocks are packed to target within a section; a table is never split, and is alone where it exceeds most; long text
    is split at sentence ends, or in slices of most; parts after the first repeat the heading and the last overlap
    characters (from a word's start) of the part before. Text chunks under least join the one before in their section.
    """
    title, section, first = "Document overview", [], True
    sections: list[tuple[str, list[tuple[str, str]]]] = []
    for kind, _, content in markdown_blocks(text):
        if kind == "heading":
            if section or not first:
                sections.append((title, section))
            title, section, first = content, [], False
        else:
            section.append((kind, content))
    sections.append((title, section))
    for name, body in sections:
        parts: list[tuple[str, bool]] = []
        open_ = ""
        for kind, content in body:
            if kind == "table":
                if open_:
                    parts.append((open_, False))
                    open_ = ""
                parts.append((content, True))
                continue
            for piece in _pieces(content, most):
                if open_ and len(open_) + 2 + len(piece) > target:
                    parts.append((open_, False))
                    tail = open_[-overlap:]
                    open_ = tail[tail.find(" ") + 1 :] if overlap and " " in tail else ""
                    open_ = f"{open_}\n\n{piece}" if open_ and len(open_) + 2 + len(piece) <= most else piece
                else:
                    open_ = f"{open_}\n\n{piece}" if open_ else piece
        if open_:
            if parts and not parts[-1][1] and len(open_) < least and len(parts[-1][0]) + 2 + len(open_) <= most:
                parts[-1] = (f"{parts[-1][0]}\n\n{open_}", False)
            else:
                parts.append((open_, False))
        for n, (content, table) in enumerate(parts):
            yield name, content if n == 0 else f"{name}\n\n{content}", table


def _pieces(content: str, most: int) -> Iterator[str]:
    """Paragraphs; longer ones by sentences packed to most, and longer sentences in slices."""
    for paragraph in filter(None, (p.strip() for p in re.split(r"\n\s*\n", content))):
        if len(paragraph) <= most:
            yield paragraph
            continue
        held = ""
        for sentence in re.split(r"(?<=[.!?])\s+", paragraph):
            for piece in [sentence[i : i + most] for i in range(0, len(sentence), most)] or [""]:
                if held and len(held) + 1 + len(piece) > most:
                    yield held
                    held = piece
                else:
                    held = f"{held} {piece}" if held else piece
        if held:
            yield held


def layout_chunks(docs: DataFrame, key: str, text: str, **limits: int) -> DataFrame:
    """key, chunk, chunk_id, section, content, contains_table, content_sha256 of every layout document."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, n, f"pdf_{k}_{n + 1:04d}", *c) for k, t in zip(pdf[key], pdf[text], strict=True) for n, c in enumerate(page_chunks(t or "", **limits))]
            yield pd.DataFrame(rows, columns=[key, "chunk", "chunk_id", "section", "content", "contains_table"])

    rows = docs.select(key, text).mapInPandas(run, f"`{key}` {kind}, chunk int, chunk_id string, section string, content string, contains_table boolean")
    return rows.withColumn("content_sha256", F.sha2("content", 256))


_NUMBER = re.compile(r"(?:page|seite)?\s*[0-9]{1,4}(?:\s*(?:of|von|/)\s*[0-9]{1,4})?")
_MARKERS = ("page ", "seite ", "copyright", "www.", "http", "module handbook", "modulhandbuch", "version ")


def _droppable(line: str) -> bool:
    """A page number, or a few words with a sign of a header or footer."""
    return len(line) <= 120 and (_NUMBER.fullmatch(line) is not None or len(line.split()) <= 14 and any(m in line for m in _MARKERS))


def without_noise(text: str, spans: list[tuple[int, int, int]], share: float = 0.35, least: int = 3) -> tuple[str, list[tuple[int, int | None]]]:
    """The text without page labels and repeated headers and footers, and (offset, page) of each of its lines.

    spans: (page, start, end) of the text. A line goes if it is a page number or label, or if it may be dropped and stands,
    in any case and spacing, on at least max(least, share of pages) pages; documents of fewer than least pages keep such
    lines. A line's page is that of the span it begins in.
    """
    ordered = sorted(spans, key=lambda s: s[1])
    starts = [s[1] for s in ordered]
    lines, at = [], 0
    for line in text.split("\n"):
        k = bisect_right(starts, at) - 1
        page = ordered[k][0] if k >= 0 and at < max(ordered[k][2], ordered[k][1] + 1) else None
        lines.append((line, " ".join(line.lower().split()), page))
        at += len(line) + 1
    held: dict[str, set] = {}
    for _, normal, page in lines:
        if normal and page is not None:
            held.setdefault(normal, set()).add(page)
    needed = max(least, int(len(ordered) * share)) if len(ordered) >= least else None
    kept, places, at = [], [], 0
    for line, normal, page in lines:
        if normal and (_NUMBER.fullmatch(normal) or needed and len(held.get(normal, ())) >= needed and _droppable(normal)):
            continue
        kept.append(line)
        places.append((at, page))
        at += len(line) + 1
    return "\n".join(kept), places


def _pages_of(text: str, places: list[tuple[int, int | None]], body: str, cursor: int) -> tuple[list[int], int]:
    """The sorted pages of the lines from where body's first line stands, at or after cursor, to where its last one does."""
    filled = [x for x in body.split("\n") if x.strip()]
    if not filled:
        return [], cursor
    start = text.find(filled[0], cursor)
    start = start if start >= 0 else max(0, text.find(filled[0]))
    end = text.find(filled[-1], start)
    end = start if end < 0 else end
    first = bisect_right(places, start, key=itemgetter(0)) - 1
    last = bisect_right(places, end, key=itemgetter(0)) - 1
    return sorted({p for _, p in places[max(0, first) : last + 1] if p is not None}), start


def evidence(docs: DataFrame, key: str, text: str, pages: str, **limits: int) -> DataFrame:
    """key, chunk, chunk_id, section (the title), content, contains_table, pages and content_sha256 of layout documents'
    chunks, their repeated page noise taken out first.

    pages is an array of struct(page, start, end). A document is folded as a whole, in batches of documents; null texts and
    empty ones have no chunks, documents without pages have chunks without.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, t, spans in zip(pdf[key], pdf[text], pdf[pages], strict=True):
                spans = [(s["page"], s["start"], s["end"]) for s in (spans if spans is not None else [])]
                clean, places = without_noise(t or "", spans)
                cursor, title = 0, None
                for n, (name, content, table) in enumerate(page_chunks(clean, **limits)):
                    body = content[len(name) + 2 :] if title == name and content.startswith(f"{name}\n\n") else content
                    found, cursor = _pages_of(clean, places, body, cursor)
                    title = name
                    rows.append((k, n, f"pdf_{k}_{n + 1:04d}", name, content, table, found))
            yield pd.DataFrame(rows, columns=[key, "chunk", "chunk_id", "section", "content", "contains_table", "pages"])

    rows = docs.select(key, text, pages).mapInPandas(run, f"`{key}` {kind}, chunk int, chunk_id string, section string, content string, contains_table boolean, pages array<int>")
    return rows.withColumn("content_sha256", F.sha2("content", 256))
