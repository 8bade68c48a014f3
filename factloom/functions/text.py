"""Text scalars: cleaning, keys, matching forms, splitting, counts, similarity and page labels."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from factloom.functions.expr import lookup, strip

PAGE_LABEL = r"(?i)^\s*(?:page|seite)\s+[0-9]{1,4}(?:\s*(?:of|von)\s*[0-9]{1,4})?\s*$"
PAGE_NUMBER = r"(?i)^\s*(?:page|seite)?\s*[0-9]{1,4}(?:\s*(?:of|von)\s*[0-9]{1,4})?\s*$"
WORD = r"[\p{L}\p{N}_]+"
SENTENCE_END = r"([.!?])\s+"

#: German terms and their English form; a parameter of translate().
TERMS = {"deutsch": "German", "englisch": "English", "vollzeit": "full-time", "teilzeit": "part-time", "wintersemester": "winter semester", "sommersemester": "summer semester", "bestanden": "passed", "nicht bestanden": "not passed", "pflicht": "compulsory", "wahlpflicht": "elective", "prüfung": "examination", "klausur": "written examination", "vorlesung": "lecture", "seminar": "seminar", "übung": "exercise", "praktikum": "internship"}


def clean(text: Column, blank_lines: int = 2) -> Column:
    """LF line ends, no-break spaces as spaces, blanks at line ends dropped, at most blank_lines empty lines in a row."""
    out = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), " ", " ")
    out = F.regexp_replace(out, "[ \t]+\n", "\n")
    return strip(F.regexp_replace(out, "\n{%d,}" % (blank_lines + 2), "\n" * (blank_lines + 1)))


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\s+", " "))


def snake(text: Column) -> Column:
    """A key: words of a-z and 0-9 in lower case, joined by underscores; camelCase counts as two words."""
    split = F.regexp_replace(text, r"([a-z0-9])([A-Z])", "$1_$2")
    return F.regexp_replace(F.regexp_replace(F.lower(split), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def matching(text: Column) -> Column:
    """A form for comparisons: lower case, one kind of dash, white space collapsed, none around : / , ; ( )."""
    out = F.regexp_replace(F.lower(text), "[‐‑‒–—−]", "-")
    out = F.regexp_replace(collapse(out), r" ?([:/,;]) ?", "$1")
    return F.regexp_replace(F.regexp_replace(out, r"\( ", "("), r" \)", ")")


@F.pandas_udf(StringType())
def compatible(text: pd.Series) -> pd.Series:
    """NFKC and case folding, which have no built-in function; for keys of text beyond Latin letters."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold(), na_action="ignore")


def plain(markdown: Column) -> Column:
    """Markdown without marks: labels of links and images, no headings', bullets', tables' or emphasis' signs."""
    out = F.regexp_replace(markdown, r"!?\[([^\]]*)\]\([^)]*\)", "$1")
    out = F.regexp_replace(out, "<[^>]*>", " ")
    out = F.regexp_replace(out, r"(?m)^[ \t]*#{1,6}[ \t]+", "")
    out = F.regexp_replace(out, r"(?m)^[ \t]*(?:[-*+]|[0-9]+\.)[ \t]+", "")
    out = F.regexp_replace(F.regexp_replace(out, r"\|", " "), r"[*_`]{1,3}", "")
    return collapse(out)


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("int")


def tokens(text: Column) -> Column:
    """The distinct words in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1)))


def alike(common: Column, n: Column, m: Column) -> Column:
    """Of sets of n and m tokens with so many in common: 0.45 Jaccard + 0.40 containment + 0.15 length ratio."""
    return 0.45 * (common / (n + m - common)) + 0.40 * (common / F.least(n, m)) + 0.15 * (F.least(n, m) / F.greatest(n, m))


def similarity(a: Column, b: Column) -> Column:
    """How alike two token arrays are; 0 if one is empty."""
    common, na, nb = F.size(F.array_intersect(a, b)), F.size(a), F.size(b)
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(alike(common, na, nb))


def lines(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda p: strip(p)), lambda p: p != "")


def sentences(text: Column) -> Column:
    """Pieces that end with . ! or ? before white space."""
    return F.filter(F.transform(F.split(F.regexp_replace(text, SENTENCE_END, "$1\x01"), "\x01"), lambda s: strip(s)), lambda s: s != "")


def slices(text: Column, size: int, overlap: int = 0) -> Column:
    """Pieces of size characters, each beginning size - overlap after the one before; none for empty text."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - overlap) / step).cast("int") - 1)
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i * step + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def is_page_label(line: Column) -> Column:
    return line.rlike(PAGE_LABEL) | line.rlike(PAGE_NUMBER)


def translate(value: Column, terms: dict[str, str] | None = None) -> Column:
    """The English form of a known term, whatever its case and punctuation; other values as they are."""
    key = collapse(F.regexp_replace(F.lower(value), r"[^\p{L}\p{N} ]+", " "))
    return lookup(key, TERMS if terms is None else terms, value)
