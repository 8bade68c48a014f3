"""Small builders of Column expressions that the other modules share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def alternation(words: Iterable[str]) -> str:
    """A regular expression that matches any of the words anywhere; valid for Java, RE2 and Python alike."""
    return "|".join(re.sub(r"([.^$*+?{}\[\]\\|()])", r"\\\1", w) for w in words)


def any_of(text: Column, words: Iterable[str]) -> Column:
    """Whether text holds any of the words as a substring; null text holds none."""
    return F.coalesce(text.rlike(alternation(words)), F.lit(False))


def first_case(cases: Iterable[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first case whose condition holds: an ordered CASE."""
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return otherwise if out is None else out.otherwise(otherwise)


def lookup(key: Column, table: Mapping[str, object], default: Column) -> Column:
    """A literal map's value for key, or default; for tables of up to some hundred entries."""
    if not table:
        return default
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(literal, F.coalesce(key, F.lit(""))), default)


def blank_to_null(text: Column) -> Column:
    """Null for text that is empty or white space."""
    return F.when(strip(text) != "", text)


def strip(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")
