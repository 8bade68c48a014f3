"""Candidate URLs: strategies, scoring by weighted patterns, re-evaluation, first-strategy-wins merge and ordering."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import urls
from factloom.functions.expr import any_of, first_case, lookup
from factloom.operators import links

# Weights of the path patterns, the sources' bonus and precedence, page types, search terms and word lists.
POSITIVE = [("programs?", 20), ("courses?", 20), ("degrees?", 25), ("studies|study", 20), ("bachelors?", 40), ("masters?", 40), ("undergraduate", 35), ("postgraduate", 35), ("graduate", 25), ("catalog(?:ue)?", 25), ("curriculum", 25), ("major", 30), ("minor", 25), ("academics?", 15)]
NEGATIVE = [("news", -100), ("events?", -100), ("blog", -80), ("press", -80), ("alumni", -80), ("careers?", -60), ("jobs?", -60), ("staff", -50), ("people", -50), ("contacts?", -50), ("privacy", -100), ("cookies?", -100), ("login", -100)]
SOURCE_BONUS = {"catalog": 15, "navigation": 10, "search": 5, "sitemap": 5, "crawler": 0}
SOURCE_ORDER = {"sitemap": 10, "navigation": 20, "catalog": 30, "search": 40, "crawler": 50}
HUB_TYPES = ["Programme Hub", "Degree Catalogue", "Navigation"]
OTHER_TYPES = ["Support", "Other", "Admissions", "Event", "News"]
DEGREE = r"\bbachelor|\bmaster|\bphd|\bdoctorate|\bbsc\b|\bmsc\b|\bba\b|\bma\b"
SCHEMAS = ["Course", "EducationalOccupationalProgram"]
SEARCH_TERMS = ["program", "programme", "degree", "course", "bachelor", "master", "graduate", "undergraduate", "study", "study programs", "degree programs"]
SEARCH_PATHS = ["/search", "/search/", "/find", "/finder", "/program-search", "/programme-search"]
NAVIGATION_WORDS = ["study", "studies", "education", "learn", "academic", "academics", "program", "programs", "programme", "programmes", "degree", "degrees", "course", "courses", "curriculum", "admission", "admissions", "apply", "application", "prospective", "future students", "school", "schools", "faculty", "faculties", "department", "departments", "college", "institute", "undergraduate", "graduate", "postgraduate", "master", "masters", "bachelor", "bachelors", "phd", "doctorate", "disciplines", "fields of study", "subject areas", "find your programme", "find your program", "degree finder"]
CATALOG_WORDS = ["program", "programs", "degree", "degrees", "course", "courses", "catalog", "catalogue", "bachelor", "bachelors", "master", "masters", "undergraduate", "postgraduate", "graduate", "curriculum", "major", "minor"]
CATALOG_SKIPPED = ["/news", "/events", "/about", "/staff", "/admin", "/admin-services", "/ict", "/library", "/governance", "/benefits", "/pay-and-pensions", "/contact", "/jobs", "/careers"]


def evidence(url: Column, source: Column) -> Column:
    """map<string, int>: the weight of each pattern found in the lower-cased path, and a source bonus that is not 0."""
    where = F.lower(urls.path(url))
    found = [F.struct(F.lit(pattern).alias("key"), F.when(where.rlike(rf"\b(?:{pattern})\b"), F.lit(weight)).alias("value")) for pattern, weight in POSITIVE + NEGATIVE]
    bonus = lookup(source, SOURCE_BONUS, F.lit(0))
    found.append(F.struct(F.lit("source").alias("key"), F.when(bonus != 0, bonus).alias("value")))
    return F.map_from_entries(F.filter(F.array(*found), lambda e: e["value"].isNotNull()))


def score(url: Column, source: Column) -> Column:
    """The sum of evidence(), as plain arithmetic: it stays in generated code."""
    where = F.lower(F.coalesce(urls.path(url), F.lit("")))
    parts = [F.when(where.rlike(rf"\b(?:{pattern})\b"), F.lit(weight)).otherwise(F.lit(0)) for pattern, weight in POSITIVE + NEGATIVE]
    return reduce(lambda a, b: a + b, parts, lookup(source, SOURCE_BONUS, F.lit(0)))


def total(evidence_: Column) -> Column:
    return F.aggregate(F.map_values(evidence_), F.lit(0), lambda a, b: a + b)


def reevaluate(candidates: DataFrame) -> DataFrame:
    """Adds to evidence what page_type, title_en, h1_en and schema_types (array) say, and sums the score anew."""
    text = F.lower(F.concat_ws(" ", F.coalesce("title_en", F.lit("")), F.coalesce("h1_en", F.lit(""))))
    kind = first_case([(F.col("page_type") == "Degree Programme", F.lit(50)), (F.col("page_type").isin(HUB_TYPES + OTHER_TYPES), F.lit(-100))], F.lit(None).cast("int"))
    schema = F.coalesce(F.arrays_overlap("schema_types", F.array(*map(F.lit, SCHEMAS))), F.lit(False))
    more = [("classification", kind), ("degree_indicator", F.when(text.rlike(DEGREE), F.lit(20)).otherwise(F.lit(-20))), ("structured_data", F.when(schema, F.lit(30)))]
    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in more]), lambda e: e["value"].isNotNull())
    added = candidates.withColumn("evidence", F.map_concat(F.coalesce("evidence", F.expr("cast(map() as map<string,int>)")), F.map_from_entries(entries)))
    return added.withColumn("score", total(F.col("evidence")))


def statistics(candidates: DataFrame) -> DataFrame:
    """Candidates per strategy, before they are merged."""
    return candidates.groupBy("source").agg(F.count(F.lit(1)).alias("candidates"))


def merge(candidates: DataFrame) -> DataFrame:
    """One candidate per exact URL: that of the strategy that comes first, and there the first (pos)."""
    placed = candidates.withColumn("source_rank", lookup(F.col("source"), SOURCE_ORDER, F.lit(99)))
    rest = [c for c in placed.columns if c != "url"]
    best = placed.groupBy("url").agg(F.min_by(F.struct(*rest), F.struct("source_rank", "pos")).alias("_r"))
    return best.select("url", *[F.col("_r")[c].alias(c) for c in rest])


def ranked(candidates: DataFrame, limit: int | None = None) -> DataFrame:
    """By score, greatest first; ties by strategy, then place, then URL. A limit becomes one top-k pass."""
    ordered = candidates.orderBy(F.desc("score"), "source_rank", "pos", "url")
    return ordered.limit(limit) if limit else ordered


def searches(bases: DataFrame, base: str = "base_url") -> DataFrame:
    """All search paths and terms of each base: the requests of site search. Both lists are short constants."""
    pairs = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(t).alias("term")) for p in SEARCH_PATHS for t in SEARCH_TERMS])
    rows = bases.select(base, F.explode(pairs).alias("s"))
    return rows.select(base, F.col("s.path").alias("path"), F.col("s.term").alias("term"), F.concat(F.regexp_replace(base, "/+$", ""), F.col("s.path"), F.lit("?q="), F.replace(F.col("s.term"), F.lit(" "), F.lit("+"))).alias("url"))


def search_results(requests: DataFrame, answers: DataFrame, base: str = "base_url") -> DataFrame:
    """The candidates of site search: base, url, query (the term) and source of every distinct link on result pages.

    requests: as searches() gives them. answers: url, result (HTML) and status, as services.fetched gives them. The first
    request in the lists' order that shows a URL stands for it; links without a host, such as mailto, are none.
    """
    place = F.struct(F.array_position(F.array(*map(F.lit, SEARCH_PATHS)), F.col("path")).alias("p"), F.array_position(F.array(*map(F.lit, SEARCH_TERMS)), F.col("term")).alias("t"))
    shown = requests.withColumn("_place", place).join(answers.where("status = 'success'").select("url", "result"), "url")
    rows = links.anchors(shown.select(base, "term", "_place", F.col("url").alias("_from"), "result"), "result").where("href != ''")
    rooted = F.col("href").startswith("/") & ~F.col("href").startswith("//")
    full = F.when(rooted, F.concat(F.regexp_replace(base, "/+$", ""), F.col("href"))).otherwise(urls.resolve(F.col("_from"), F.col("href")))
    rows = rows.withColumn("url", urls.normalise(full)).where(urls.host(F.col("url")) != "")
    first = rows.groupBy(base, "url").agg(F.min_by("term", F.struct("_place", "pos")).alias("query"))
    return first.withColumn("source", F.lit("search"))


def navigation(links: DataFrame, words: list[str] = NAVIGATION_WORDS) -> DataFrame:
    """Links of a home page that hold a navigation word in label or path, first of each normalised URL."""
    rows = links.withColumn("url", urls.normalise(F.col("url")))
    rows = rows.where(any_of(F.lower(F.concat_ws(" ", "title", urls.path(F.col("url")))), words))
    first = Window.partitionBy("page_id", "url").orderBy("pos")
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n").withColumn("source", F.lit("navigation"))


def catalog(candidates: DataFrame, pages: DataFrame, links_of: Callable[[DataFrame], DataFrame], words: list[str] = CATALOG_WORDS) -> DataFrame:
    """Of what links_of takes from the pages of known candidates, the links with a catalog word."""
    reached = pages.join(candidates.select("url").distinct(), "url", "left_semi")
    rows = links_of(reached).where(F.length("title") >= 3)
    found = any_of(F.lower(F.concat_ws(" ", urls.path(F.col("url")), F.col("title"))), words)
    return rows.where(found).withColumn("source", F.lit("catalog"))


def second_hop(candidates: DataFrame, pages: DataFrame, words: list[str] = CATALOG_WORDS, skipped: list[str] = CATALOG_SKIPPED) -> DataFrame:
    """The second hop: page_id, pos, url, title, parent (the candidate's URL) and source of the links with a catalog word
    on the pages of all candidates but those of skipped sections, whatever host or label the links have.

    candidates: url, source_rank, pos. pages: page_id, url, html. URLs are compared in normal form; of a URL that several
    candidates link to, the first candidate's first link stands.
    """
    known = candidates.where(~any_of(F.lower("url"), skipped)).groupBy(urls.normalise(F.col("url")).alias("parent")).agg(F.min(F.struct("source_rank", "pos")).alias("_place"))
    reached = pages.select("page_id", urls.normalise(F.col("url")).alias("parent"), "html").join(known, "parent")
    rows = links.anchors(reached).where((F.col("href") != "") & ~F.col("href").rlike("^(" + "|".join(links.SCHEMES) + ")") & (F.length("text") >= 3))
    rows = rows.withColumn("url", urls.normalise(urls.resolve(F.col("parent"), F.col("href"))))
    rows = rows.where(any_of(F.lower(F.concat_ws(" ", urls.path(F.col("url")), F.col("text"))), words))
    first = rows.groupBy("url").agg(F.min_by(F.struct("page_id", "pos", F.col("text").alias("title"), "parent"), F.struct("_place", "page_id", "pos")).alias("_r"))
    return first.select("_r.page_id", "_r.pos", "url", "_r.title", "_r.parent", F.lit("catalog").alias("source"))
