"""Captured sitemaps and robots files: parsing, index recursion, and the page URLs they lead to."""

from __future__ import annotations

import gzip
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from factloom.functions.expr import any_of, strip

# Well-known places and the parts of URLs that are passed over.
WELL_KNOWN = ["/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml", "/sitemap/sitemap.xml"]
#: A parameter of pages(): parts of page URLs that are no candidates.
SKIPPED = ["/news", "/events", "/event", "/blog", "/press", "/media", "/library", "/contact", "/privacy", "/terms", "/login", "/jobs", "/careers", "/staff", "/about", "/alumni", "/giving", "/donate"]


def _inflated(content: bytes | None) -> bytes | None:
    if content and content[:2] == b"\x1f\x8b":
        try:
            return gzip.decompress(content)
        except (OSError, EOFError):
            return content
    return content


def inflate(content: Column) -> Column:
    """Gunzips content that is gzip by its first bytes; what does not inflate stays as it is."""
    return F.pandas_udf(lambda s: s.map(_inflated, na_action="ignore"), BinaryType())(content)


def captured(spark: SparkSession, path: str) -> DataFrame:
    """url (the file's path below the folder, as a URL), status 200 and text of all captured files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = re.sub(r"([^A-Za-z0-9/])", r"\\\1", path.rstrip("/"))
    name = F.regexp_replace("path", f"^.*?{root}/([a-z]+)/([^/]+)/(.*)$", "$1://$2/$3")
    return files.select(name.alias("url"), F.lit(200).alias("status"), F.try_validate_utf8(inflate(F.col("content")).cast("string")).alias("text"))


def robots(files: DataFrame) -> DataFrame:
    """url of the sitemaps that robots files name, and of the well-known places of their hosts, each once."""
    base = F.regexp_extract("url", r"^([a-z]+://[^/]+)", 1)
    rows = files.where(F.col("url").endswith("/robots.txt") & (F.col("status") == 200))
    named = rows.select(F.explode(F.filter(F.split(F.regexp_replace("text", "\r", ""), "\n"), lambda x: F.lower(x).startswith("sitemap:"))).alias("l"))
    named = named.select(strip(F.regexp_replace("l", "^[^:]*:", "")).alias("url"))
    known = files.select(base.alias("b")).distinct().select(F.explode(F.array(*[F.concat("b", F.lit(p)) for p in WELL_KNOWN])).alias("url"))
    return named.unionByName(known).distinct()


def locations(xml: Column, parent: str) -> Column:
    """The loc texts of a sitemap's url or sitemap elements, whatever their name space; none if it is no XML.

    By pattern rather than by a parser, so that one broken file yields what it has and never fails a job.
    """
    found = F.regexp_extract_all(xml, F.lit(rf"(?is)<(?:\w+:)?{parent}\b[^>]*>.*?<(?:\w+:)?loc\b[^>]*>\s*(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?\s*</(?:\w+:)?loc>"), F.lit(1))
    clean = F.transform(found, lambda u: F.replace(strip(u), F.lit("&amp;"), F.lit("&")))
    return F.filter(F.coalesce(clean, F.array().cast("array<string>")), lambda u: u != "")


def pages(files: DataFrame, skipped: list[str] | None = None, max_depth: int = 2, limit: int | None = None, cut: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """sitemap, url, pos of all pages that the sitemaps lead to, following indexes level by level, each file once.

    Levels of indexes are few; for more than two cut(df, name) is needed, which writes a level to a table.
    """
    if cut is None and max_depth > 2:
        raise ValueError("pass cut for more than two levels")
    level = robots(files).join(files.where("status = 200"), "url").select("url", "text")
    seen = level.select("url")
    reached = level
    for step in range(max_depth):
        children = level.select(F.explode(locations(F.col("text"), "sitemap")).alias("url")).distinct().join(seen, "url", "left_anti")
        level = children.join(files.where("status = 200"), "url").select("url", "text")
        if cut:
            level = cut(level, f"sitemaps-{step}")
        seen = seen.unionByName(level.select("url"))
        reached = reached.unionByName(level)
    if limit:
        reached = reached.orderBy("url").limit(limit)
    rows = reached.select(F.col("url").alias("sitemap"), F.posexplode(locations(F.col("text"), "url")).alias("pos", "url"))
    return rows.where(~any_of(F.lower("url"), SKIPPED if skipped is None else skipped))


def all_pages(files: DataFrame, limit: int = 200) -> DataFrame:
    """The sorted distinct page URLs of at most limit sitemaps, none passed over."""
    return pages(files, skipped=["\x00"], limit=limit).select("url").distinct().orderBy("url")
