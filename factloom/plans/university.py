"""The whole pipeline over captured pages: links, evidence chunks, facts, dedupe, routing and accounting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import html, urls
from factloom.operators import chunking, discovery, enrichment, facts, links, profiles, rankings
from factloom.plans import web
from factloom.plans.captures import _stub_model
from factloom.sources import services


def run(pages: DataFrame, model: Callable[[str], str], limit: int | None = None) -> dict[str, DataFrame]:
    """The stages' results by name, over all programmes at once; a failed call is a row of calls, not a failed run.

    pages: page_id, url, html. Links are ranked into crawl queues; each page's Markdown is cut into evidence chunks; the
    model's facts are checked, deduped within their page and routed to sections.
    """
    if limit:
        pages = pages.orderBy("page_id").limit(limit)
    queue = links.manifest(links.discover(pages))
    chunks = chunking.evidence_chunks(pages.select("page_id", html.to_markdown(F.col("html")).alias("text")), "page_id", "text")
    named = chunks.select(F.concat_ws("/", F.col("page_id").cast("string"), "chunk_id").alias("chunk_id"), "content")
    found, calls, rejects = services.extracted(named, model)
    raw = found.withColumn("page_id", F.substring_index("chunk_id", "/", 1).cast("long"))
    checked = facts.checked(raw)
    good = checked.where("problem is null").drop("problem")
    unique = facts.first_of(good, [F.col("page_id"), F.col("category"), F.col("field"), F.col("value")], ["chunk_id", "pos"])
    routed = unique.withColumn("section", facts.section_of(F.col("category")))
    return {"queue": queue, "chunks": chunks, "calls": calls, "rejects": rejects, "quarantine": checked.where("problem is not null"), "facts": routed}


def enriched(web_facts: DataFrame, layouts: DataFrame, model: Callable[[str], str]) -> dict[str, DataFrame]:
    """The PDF branch and the final output, by name: evidence chunks of layout documents, the model's facts with the
    document's entity, web facts enriched by them, and all of it routed to sections.

    web_facts: key, pos, category, type, id, name, parent_id, parent_name, field, value. layouts: key, name (the
    programme's), markdown, pages (array of struct(page, start, end)), one document a key. Facts are compared under their
    canonical names; a failed call is a row of calls, and facts that the PDF repeats count once.
    """
    chunks = html.evidence(layouts, "key", "markdown", "pages")
    found, calls, rejects = services.extracted(chunks.select("chunk_id", "content"), model, attempts=1)
    placed = found.join(chunks.select("chunk_id", "key", "chunk", F.col("pages").alias("source_pages")), "chunk_id")
    entity = layouts.select("key", "name").distinct()
    none = F.lit(None).cast("string")
    pdf = placed.join(entity, "key").select("key", (F.col("chunk").cast("long") * 100_000 + F.col("pos")).alias("pos"), "category", F.lit("program").alias("type"), none.alias("id"), "name", none.alias("parent_id"), none.alias("parent_name"), "field", "value", "source_pages")
    pdf = enrichment.canonical(pdf)
    pdf = facts.first_of(pdf, [F.col("key"), F.col("category"), F.col("field"), F.lower("value")], ["pos"]).drop("copies")
    joined = enrichment.enrich(enrichment.canonical(web_facts), pdf)
    return {"chunks": chunks, "calls": calls, "rejects": rejects, "pdf_facts": pdf, "facts": joined.withColumn("section", facts.section_of(F.col("category")))}


def profile_flow(pages: DataFrame, replies: DataFrame) -> dict[str, DataFrame]:
    """Ranking profiles, by name: profiles (key, rankings, ranking_count), failures (endpoints without a reply), criteria.

    pages: key, html. replies: ranking_id, profile_id, result (HTML), status, as a fetch of the endpoints gives them. A
    ranking's current record is that of its newest year in tables and lists; equal records of both count once.
    """
    ends = pages.select("key", F.explode(rankings.endpoints(F.col("html"))).alias("e")).select("key", "e.ranking_id", "e.profile_id").distinct()
    got = ends.join(replies, ["ranking_id", "profile_id"], "left")
    good = F.coalesce(F.col("status") == "success", F.lit(False))
    read = got.where(good).select(F.struct("key", "ranking_id").alias("at"), "result")
    rows = profiles.history(read, "at", "result").unionByName(profiles.listed_history(read, "at", "result"))
    rows = rows.select("at.key", "at.ranking_id", "year", "rank", "pos", F.lit(None).cast("double").alias("score"))
    current = rankings.current(rankings.history(rows, ["key", "ranking_id"]), ["key", "ranking_id"])
    told = read.select("at.*", F.regexp_extract("result", r"(?is)<h[1-6]\b[^>]*>(.*?)</h", 1).alias("title"), F.explode(profiles.criteria_cards(F.col("result"))).alias("c"))
    criteria = told.select("key", "ranking_id", rankings.resolved_name(F.col("ranking_id"), F.col("title")).alias("ranking"), "c.name", "c.score")
    return {"profiles": rankings.merged(pages.select("key"), current, "key"), "failures": got.where(~good).select("key", "ranking_id", "profile_id", "status"), "criteria": criteria}


def university_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMP-10, CMP-04, CMP-05, DED-02: each page's facts by section, of a stub model's replies."""
    rows = run(web.pages(spark, sf_dir), _stub_model)["facts"]
    return rows.groupBy("page_id", "section").agg(F.count(F.lit(1)).alias("facts"), F.sum("copies").alias("copies"))


#: The pages' labels are invented words, so the queries look for some that these hold.
MADE_WORDS = ["the", "und", "pour", "ing"]


def navigation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05: links with a navigation word in label or path, each URL once a page."""
    return discovery.navigation(web.links_discover(spark, sf_dir), MADE_WORDS).select("page_id", "pos", "url", "title", "source")


_WORDS = "'" + "|".join(MADE_WORDS) + "'"
navigation_links_sql = f"""WITH {web.LINKS}, n AS (SELECT page_id, pos, title, regexp_replace(regexp_extract(url, {web.PARTS}, 1) || '://' || regexp_extract(url, {web.PARTS}, 2) || regexp_extract(url, {web.PARTS}, 3), '/+$', '') AS url FROM links)
SELECT page_id, pos, url, title, 'navigation' AS source FROM n WHERE regexp_matches(lower(title || ' ' || regexp_extract(url, {web.PARTS}, 3)), {_WORDS}) QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY pos) = 1"""


def catalog_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06: the second hop, links with a catalog word on pages that are candidates."""
    p = web.pages(spark, sf_dir)
    known = p.where("page_id % 2 = 0").select("url")
    rows = discovery.catalog(known, p, lambda reached: links.discover(reached, bad_parts=links.BAD_PARTS[:2]), MADE_WORDS)
    return rows.select("page_id", "pos", "url", "title", "source", urls.depth(F.col("url")).alias("depth"))


catalog_links_sql = f"""WITH {web.LINKS} SELECT page_id, pos, url, title, 'catalog' AS source, CAST(len(list_filter(string_split(regexp_extract(url, {web.PARTS}, 3), '/'), lambda x: x <> '')) AS INTEGER) AS depth FROM links
WHERE page_id IN (SELECT page_id FROM pages WHERE url IN (SELECT url FROM pages WHERE page_id % 2 = 0)) AND length(title) >= 3 AND regexp_matches(lower(regexp_extract(url, {web.PARTS}, 3) || ' ' || title), '{'|'.join(MADE_WORDS)}')"""


def catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06: the second hop from all merged candidates, to links with a catalog word; parent is the candidate."""
    return discovery.second_hop(web.strategy_merge(spark, sf_dir), web.pages(spark, sf_dir), MADE_WORDS)


catalog_pages_sql = f"""WITH merged AS ({web.strategy_merge_sql}),
known AS (SELECT {web.NORMAL} AS known, source_rank, pos AS place FROM (SELECT *, url AS u FROM merged) WHERE NOT regexp_matches(lower(u), '{'|'.join(discovery.CATALOG_SKIPPED)}') QUALIFY row_number() OVER (PARTITION BY known ORDER BY source_rank, place) = 1),
norm AS (SELECT {web.NORMAL} AS url, page_id, html FROM (SELECT url AS u, page_id, html FROM pages)),
{web.ANCHORS.replace('FROM pages)', 'FROM norm)')},
hops AS (SELECT page_id, pos, base AS parent, text AS title, {web.NORMAL} AS url FROM (SELECT *, url AS u FROM anchors) WHERE href <> '' AND NOT regexp_matches(href, '^({'|'.join(links.SCHEMES)})') AND length(text) >= 3)
SELECT page_id, pos, url, title, parent, 'catalog' AS source FROM hops JOIN known ON parent = known WHERE regexp_matches(lower({web.PATH} || ' ' || title), {_WORDS})
QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_rank, place, page_id, pos) = 1"""

NAMES = ("university_pipeline", "navigation_links", "catalog_links", "catalog_pages")
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[f"{n}_sql"] for n in NAMES if f"{n}_sql" in globals()}
