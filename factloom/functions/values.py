"""Dynamic values: emptiness, canonical JSON and signatures, equality, richness and compatibility, JSON in text."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from factloom.functions.expr import first_case, strip
from factloom.functions.numbers import unit_number
from factloom.functions.text import collapse


def is_empty(value: Column) -> Column:
    """Null, blank text, and the JSON forms of null, an empty list and an empty object; 0 and false are values."""
    return F.coalesce(value.isNull() | strip(value).isin("", "null", "[]", "{}"), F.lit(True))


def canonical(json_text: Column) -> Column:
    """JSON with object keys sorted and no blanks; text that is no JSON is a JSON string."""
    return F.coalesce(F.to_json(F.try_parse_json(json_text)), F.to_json(F.to_variant_object(F.array(json_text))))


def signature(*parts: Column) -> Column:
    """SHA-256 of the parts in order, nulls told apart from empty text."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]), 256)


def normal(value: Column) -> Column:
    """A scalar for comparisons: a number with unit as the number, boolean words as true or false, else matching text."""
    text = collapse(F.lower(value))
    number = unit_number(value)
    whole = F.when(number == F.floor(number), F.floor(number).cast("string")).otherwise(number.cast("string"))
    return first_case([(number.isNotNull(), whole), (text.isin("true", "yes", "ja"), F.lit("true")), (text.isin("false", "no", "nein"), F.lit("false"))], text)


def richer(web: Column, pdf: Column) -> Column:
    """Of two normal() forms: pdf holds all of web, and more than 1.15 times as many characters."""
    return F.contains(pdf, web) & (F.length(pdf) > 1.15 * F.length(web)) & (F.length(web) > 0)


def compatible(web: Column, pdf: Column) -> Column:
    """Of two normal() forms: either holds the other, both of 4 characters or more."""
    return (F.length(web) >= 4) & (F.length(pdf) >= 4) & (F.contains(web, pdf) | F.contains(pdf, web))


def list_relation(a: Column, b: Column) -> Column:
    """Of two arrays as sets: equal, subset (a in b), superset, overlap or disjoint."""
    only_a, only_b = F.size(F.array_except(a, b)), F.size(F.array_except(b, a))
    return first_case([((only_a == 0) & (only_b == 0), F.lit("equal")), (only_a == 0, F.lit("subset")), (only_b == 0, F.lit("superset")), (F.arrays_overlap(a, b), F.lit("overlap"))], F.lit("disjoint"))


def append_unique(values: Column, value: Column) -> Column:
    return F.when(F.array_contains(values, value), values).otherwise(F.array_append(values, value))


def first_value(*values: Column) -> Column:
    """The first that is not empty."""
    return F.coalesce(*[F.when(~is_empty(v), v) for v in values])


def page_numbers(pages: Column, start: Column, end: Column) -> Column:
    """Sorted distinct pages of a list and a range (whose ends are at most 500 apart; a wider one is ignored)."""
    ranged = F.when((end >= start) & (end - start <= 500), F.sequence(start, end)).otherwise(F.array().cast("array<int>"))
    return F.array_sort(F.array_distinct(F.concat(F.coalesce(pages, F.array().cast("array<int>")), F.coalesce(ranged, F.array().cast("array<int>")))))


def pruned(value: object) -> object:
    """Without null, blank text and empty lists and objects, at any depth; 0 and false stay."""
    if isinstance(value, dict):
        kept = {k: p for k, v in value.items() if (p := pruned(v)) is not None}
        return kept or None
    if isinstance(value, list):
        return [p for v in value if (p := pruned(v)) is not None] or None
    return None if value is None or (isinstance(value, str) and not value.strip()) else value


def balanced_object(text: str) -> str | None:
    """The first balanced JSON object in a text, its braces counted outside strings."""
    at = text.find("{")
    while at >= 0:
        level, quoted, escaped = 0, False, False
        for i in range(at, len(text)):
            c = text[i]
            if quoted:
                quoted = escaped or c != '"'
                escaped = c == "\\" and not escaped
            elif c == '"':
                quoted, escaped = True, False
            elif c in "{}":
                level += 1 if c == "{" else -1
                if not level:
                    return text[at : i + 1]
        at = text.find("{", at + 1)
    return None


def walked(value: object, key: str) -> Iterator[object]:
    """The values of a key at any depth, parents first."""
    if isinstance(value, dict):
        if key in value:
            yield value[key]
        for v in value.values():
            yield from walked(v, key)
    elif isinstance(value, list):
        for v in value:
            yield from walked(v, key)


def flat_ld(value: object) -> Iterator[dict]:
    """JSON-LD nodes: those of lists and @graph first, then the node itself, then those of mainEntity."""
    if isinstance(value, list):
        for v in value:
            yield from flat_ld(v)
    elif isinstance(value, dict):
        yield from flat_ld(value.get("@graph", []))
        yield value
        yield from flat_ld(value.get("mainEntity", []))


def _json(f):
    def run(text: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            if t is None:
                return None
            try:
                out = f(json.loads(t))
            except ValueError:
                return None
            return None if out is None else json.dumps(out, sort_keys=True, ensure_ascii=False, separators=(",", ":"))

        return text.map(one, na_action="ignore")

    return run


def prune(json_text: Column) -> Column:
    """JSON without empty values at any depth (a vectorised function: no built-in one recurses)."""
    return F.pandas_udf(_json(pruned), StringType())(json_text)


def collect_key(json_text: Column, key: str) -> Column:
    """The JSON list of a key's values at any depth."""
    return F.pandas_udf(_json(lambda v: list(walked(v, key))), StringType())(json_text)


def flatten_ld(json_text: Column) -> Column:
    return F.pandas_udf(_json(lambda v: list(flat_ld(v))), StringType())(json_text)


def first_object(text: Column) -> Column:
    """The first JSON object in a reply, without code fences; native where all of it parses, else by counting braces."""
    bare = strip(F.regexp_replace(text, r"(?m)^\s*```(?:json)?\s*$", ""))
    scan = F.pandas_udf(lambda s: s.map(lambda t: None if t is None else balanced_object(t), na_action="ignore"), StringType())
    return F.when(F.try_parse_json(bare).isNotNull() & bare.startswith("{"), bare).otherwise(scan(bare))
