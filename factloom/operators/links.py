"""Links of captured pages: extraction, ordered classification, first-wins dedupe, best links and crawl manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import urls
from factloom.functions.expr import any_of, first_case, lookup, strip

# The classifier's words, in order of precedence: (words, category, purpose, priority).
LANGUAGE_WORDS = ["english", "sprachversion", "language"]
PDF_KINDS = [
    ("module_handbook", ["modul", "module", "modulhandbuch", "module handbook", "handbook"]),
    ("study_regulations", ["studienordnung", "prüfungsordnung", "prufungsordnung", "pruefungsordnung", "satzung"]),
    ("brochure", ["brochure", "brosch", "flyer", "prospectus", "prospekt"]),
]
RESEARCH_WORDS = ["research", "researcher", "center", "centre", "institute", "laboratory", "lab", "innovation", "innovation hub", "research group", "research centre"]
PAGE_KINDS = [
    ("admission", ["admission", "zulassung", "bewerbung", "application", "apply"], 95),
    ("curriculum", ["curriculum", "module", "modul", "studienaufbau"], 90),
    ("fees", ["fee", "tuition", "cost", "gebühr", "beitrag"], 90),
    ("scholarship", ["scholarship", "stipendium", "funding"], 85),
    ("department", ["department", "faculty", "institut", "fakult"], 80),
    ("international", ["international", "exchange", "erasmus"], 80),
    ("career", ["career", "employment", "internship", "praktikum"], 70),
    ("contact", ["contact", "beratung", "advisor", "ansprechpartner"], 60),
]
GENERIC_WORDS = ["history", "about", "people", "staff", "faculty-directory", "directory", "organization", "employment", "career", "career-fair"]
IGNORE_WORDS = ["news", "press", "media", "events", "event", "calendar", "seminar", "workshop", "conference", "webinar", "alumni", "donate", "giving", "support us", "foundation", "library", "bookstore", "shop", "merchandise"]
SCHEMES = ["mailto:", "tel:", "javascript:"]
DOMAINS = ["facebook.com", "instagram.com", "linkedin.com", "youtube.com", "twitter.com", "x.com", "bsky.app", "goo.gl", "google.com/maps"]
NAVIGATION_WORDS = ["privacy", "datenschutz", "impressum", "accessibility", "barrierefreiheit", "cookie", "facebook", "instagram", "linkedin", "youtube", "bluesky", "route anzeigen", "kontaktformular", "share", "teilen"]
BUTTONS = ["weiter", "weiter zum studienplatz", "jetzt bewerben", "bewerben", "read more", "learn more", "next", "overview", "zur übersicht", "mehr", "mehr erfahren", "english", "switch to english", "deutsch", "sprachversion", "en", "de"]
BAD_PARTS = ["weiter-zum-studienplatz", "jetzt-bewerben", "/en/", "/english/"]
EXPANDED = ["admission", "curriculum", "department", "international"]
MANIFEST_ORDER = ["admission", "curriculum", "department", "international", "fees", "career", "module_handbook", "study_regulations", "brochure", "contact"]

ANCHOR = r'(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>'


def anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per anchor with a double-quoted href: pos (from 0), href, text (tags out, entities of XML in, stripped).

    All columns of pages but html stay. Pages whose markup needs a parser go through html.anchors_parsed instead.
    """
    source = F.coalesce(F.col(html), F.lit(""))
    found = F.regexp_extract_all(source, F.lit(ANCHOR), F.lit(0))  # one pass over the page; then each anchor is split
    rows = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c != html], F.posexplode(found).alias("pos", "_a"))
    return rows.withColumn("href", strip(F.regexp_extract("_a", ANCHOR, 1))).withColumn("text", plain(F.regexp_extract("_a", ANCHOR, 2))).drop("_a")


def plain(markup: Column) -> Column:
    """Tags as spaces, the five XML entities and &nbsp; as their signs, white space collapsed and stripped."""
    text = F.regexp_replace(markup, r"(?s)<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return strip(F.regexp_replace(text, r"\s+", " "))


def classify(url: Column, text: Column, word_boundary: bool = False) -> Column:
    """struct(type, category, purpose, priority) of the first rule that holds; words are substrings unless bounded."""
    value = F.lower(F.concat_ws(" ", F.coalesce(url, F.lit("")), F.coalesce(text, F.lit(""))))
    where = F.lower(urls.path(url))

    def has(column: Column, words: list[str]) -> Column:
        if not word_boundary:
            return any_of(column, words)
        return F.coalesce(column.rlike(r"(^|[^\p{L}\p{N}])(" + "|".join(words) + r")([^\p{L}\p{N}]|$)"), F.lit(False))

    def kind(category: str, purpose: str, priority: int, type_: str = "page") -> Column:
        return F.struct(F.lit(type_).alias("type"), F.lit(category).alias("category"), F.lit(purpose).alias("purpose"), F.lit(priority).alias("priority"))

    pdf = F.lower(url).endswith(".pdf")
    cases = [(has(where, LANGUAGE_WORDS), kind("language", "navigation", 0))]
    cases += [(pdf & has(value, words), kind(name, "evidence", 100, "pdf")) for name, words in PDF_KINDS]
    cases += [(pdf, kind("pdf", "evidence", 100, "pdf")), (has(value, RESEARCH_WORDS), kind("research", "navigation", 0))]
    for name, words, priority in PAGE_KINDS:
        if name == "department":
            cases.append((has(value, words) & has(value, GENERIC_WORDS), kind(name, "navigation", 0)))
        cases.append((has(value, words), kind(name, "evidence", priority)))
    cases += [(has(value, IGNORE_WORDS), kind("ignore", "navigation", 0)), (where.contains("sitemap"), kind("sitemap", "discovery", 40)), (where.contains("search"), kind("search", "discovery", 30))]
    return first_case(cases, kind("other", "navigation", 10))


def discover(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", bad_parts: list[str] | None = None) -> DataFrame:
    """The classified links of each page: key, pos, then the link record.

    An anchor's URL is resolved and compared without fragment; the first anchor of a URL stands for it, so a first one
    with a bad label hides later ones. Buttons, empty and navigation labels, social hosts and bad parts fall out after
    that. The dedupe is within a page, so its shuffle is by page and never meets a key larger than one page.
    """
    rows = anchors(pages.select(F.col(key), F.col(url).alias("base"), F.col(html).alias("html")))
    scheme_ok = ~F.col("href").rlike("^(" + "|".join(SCHEMES) + ")")
    rows = rows.where((F.col("href") != "") & scheme_ok).withColumn("url", urls.resolve(F.col("base"), F.col("href")))
    rows = rows.where(F.col("url") != F.regexp_replace(F.col("base"), "^/+|/+$", ""))
    first = Window.partitionBy(key, "url").orderBy("pos")
    rows = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    low = F.lower(F.col("text"))
    rows = rows.where((low != "") & ~low.isin(BUTTONS) & ~any_of(low, NAVIGATION_WORDS) & ~any_of(F.lower(urls.host(F.col("url"))), DOMAINS))
    if bad := BAD_PARTS if bad_parts is None else bad_parts:
        rows = rows.where(~any_of(F.lower(F.col("url")), bad))
    own = F.regexp_replace(urls.host(F.col("base")), r"^www\.", "")
    rows = rows.withColumn("_k", classify(F.col("url"), F.col("text")))
    return rows.select(key, "pos", F.lit("program_page").alias("source"), F.lit("direct").alias("relation"), F.col("_k.type").alias("type"), F.col("text").alias("title"), "url", urls.host(F.col("url")).alias("domain"), urls.host(F.col("url")).endswith(own).alias("internal"), F.col("_k.category").alias("category"), F.col("_k.purpose").alias("purpose"), F.col("_k.priority").alias("priority"), F.lit(False).alias("visited"))


def link_order() -> list[Column]:
    """Priority first, then type, category, label; the place on the page breaks ties."""
    return [F.desc("priority"), F.asc("type"), F.asc("category"), F.asc(F.lower("title")), F.asc("pos")]


def summary(links: DataFrame, key: str = "page_id") -> DataFrame:
    """Per page: all links, evidence links, PDF links and discovery links."""
    count = lambda c: F.count_if(c)
    return links.groupBy(key).agg(F.count(F.lit(1)).alias("total_links"), count(F.col("purpose") == "evidence").alias("evidence_links"), count(F.col("type") == "pdf").alias("pdf_links"), count(F.col("purpose") == "discovery").alias("discovery_links"))


def best_per_category(links: DataFrame, key: str = "page_id", least: int = 50) -> DataFrame:
    """Of each page and category the evidence link of greatest priority; ties go to the shorter URL, then the first."""
    order = F.struct((-F.col("priority")).alias("p"), F.length("url").alias("l"), F.col("pos").alias("o"))
    good = links.where((F.col("purpose") == "evidence") & (F.col("priority") >= least))
    row = F.struct("url", "title", "type", "priority", "pos")
    return good.groupBy(key, "category").agg(F.min_by(row, order).alias("r")).select(key, "category", "r.*")


def manifest(links: DataFrame, key: str = "page_id", max_depth: int = 2) -> DataFrame:
    """The crawl queue of each page: best links at depth 1, ordered by depth, category rank and priority (rank column)."""
    ranks = {c: i + 1 for i, c in enumerate(MANIFEST_ORDER)}
    queue = best_per_category(links, key).withColumn("depth", F.lit(1)).withColumn("expand", F.col("category").isin(EXPANDED)).withColumn("status", F.lit("pending"))
    queue = queue.withColumn("category_rank", lookup(F.col("category"), ranks, F.lit(99)))
    order = Window.partitionBy(key).orderBy("depth", "category_rank", F.desc("priority"), "pos")
    return queue.withColumn("id", F.format_string("%04d", F.row_number().over(order))).withColumn("max_depth", F.lit(max_depth))
