"""Queries over sources, structure and streams: sitemaps, Markdown, chunks, service calls, sinks and windows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import html, text, urls
from factloom.functions.expr import alternation
from factloom.operators import frontier
from factloom.plans.web import HOST, NORMAL, pages
from factloom.sources import scratch, services, sinks, sitemaps
from factloom.streaming import frontier as streams


def _host_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured files of every host: robots, a sitemap index, and a sitemap for each of its pages' first letters."""
    p = pages(spark, sf_dir).select(F.concat(F.lit("https://"), urls.host(F.col("url"))).alias("b"), urls.normalise(F.col("url")).alias("u"), (F.col("page_id") % 2).cast("string").alias("part"))
    entry = lambda tag, loc: F.concat(F.lit(f"<{tag}><loc> "), loc, F.lit(f"</loc></{tag}>"))
    maps = p.groupBy("b", "part").agg(F.array_join(F.array_sort(F.collect_list(entry("url", F.col("u")))), "").alias("x")).select(F.concat_ws("", "b", F.lit("/map-"), "part", F.lit(".xml")).alias("url"), F.concat(F.lit("<urlset>"), "x", F.lit("</urlset>")).alias("text"))
    index = p.groupBy("b").agg(F.array_join(F.array_sort(F.collect_set(entry("ns:sitemap", F.concat_ws("", "b", F.lit("/map-"), "part", F.lit(".xml"))))), "").alias("x")).select(F.concat("b", F.lit("/sitemap.xml")).alias("url"), F.concat(F.lit("<ns:sitemapindex>"), F.regexp_replace("x", "<(/?)loc>", "<$1ns:loc>"), F.lit("</ns:sitemapindex>")).alias("text"))
    robots = p.select("b").distinct().select(F.concat("b", F.lit("/robots.txt")).alias("url"), F.concat(F.lit("User-agent: *\nSitemap: "), "b", F.lit("/sitemap.xml\n")).alias("text"))
    return maps.unionByName(index).unionByName(robots).withColumn("status", F.lit(200))


def sitemap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01, SRC-02, SRC-03, SRC-04: the pages that robots files and sitemap indexes lead to."""
    return sitemaps.pages(_host_files(spark, sf_dir), max_depth=1).select("sitemap", "url")


sitemap_pages_sql = f"""WITH p AS (SELECT 'https://' || {HOST} || '/map-' || page_id % 2 || '.xml' AS sitemap, {NORMAL} AS url FROM (SELECT *, url AS u FROM pages))
SELECT sitemap, url FROM p WHERE NOT regexp_matches(lower(url), '{alternation(sitemaps.SKIPPED)}')"""


def page_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NST-07, NST-08, SNK-03: each page's content as Markdown, in numbered folders by host."""
    rows = pages(spark, sf_dir).select("page_id", urls.host(F.col("url")).alias("host"), html.to_markdown(F.col("html")).alias("markdown"))
    return frontier.page_folders(rows, "host", "page_id").select("page_id", "host", "folder", F.md5("markdown").alias("digest"), text.words(F.col("markdown")).alias("words"))


def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NST-09, NST-10: the blocks of every page's Markdown."""
    rows = pages(spark, sf_dir).select("page_id", html.to_markdown(F.col("html")).alias("markdown"))
    return html.blocks(rows, "page_id", "markdown").select("page_id", "block", "type", "level", F.md5("content").alias("digest"))


def layout_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMP-03, STR-09, AGG-08: chunks of layout documents, which documents under a heading and a table stand for."""
    d = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    made = d.select("doc_id", F.concat(F.lit("# "), F.substring("text", 1, 30), F.lit("\n\n| a | b |\n| - | - |\n\n"), "text").alias("markdown"))
    return html.layout_chunks(made, "doc_id", "markdown").select("doc_id", "chunk", "chunk_id", "contains_table", "content_sha256", F.length("content").cast("long").alias("characters"))


def _stub_model(content: str) -> str:
    """A deterministic stand-in for a language model: one fact for the text's first and last word, in a fenced reply."""
    words = content.split()
    found = [{"category": "identity", "field": "first", "value": words[0], "confidence": 0.9}, {"category": "other", "field": "last", "value": words[-1], "confidence": 0.8}] if words else []
    return "Here it is:\n```json\n" + json.dumps({"facts": found}) + "\n```"


def model_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-20, CMP-04, NST-03, STM-04, FLT-16: the facts of a stub model's replies to every benchmark item."""
    chunks = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet").select(F.col("item_id").alias("chunk_id"), F.col("text").alias("content"))
    found, _, _ = services.extracted(chunks, _stub_model)
    return found.select("chunk_id", "pos", "category", "field", "value", F.round("confidence", 2).alias("confidence"))


model_facts_sql = """WITH w AS (SELECT item_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM benchmark)
SELECT item_id AS chunk_id, 0 AS pos, 'identity' AS category, 'first' AS field, w[1] AS value, 0.9::DOUBLE AS confidence FROM w WHERE len(w) > 0 UNION ALL SELECT item_id, 1, 'other', 'last', w[-1], 0.8::DOUBLE FROM w WHERE len(w) > 0"""


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-01, SNK-05, SNK-10: each conversation as one JSON document of its turns, in order."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", F.length("text").cast("long").alias("size"))
    made = sinks.document(rows, ["conv_id"], "turns", ["turn"])
    return made.select("conv_id", F.col("count"), F.get_json_object("json", "$.turns[0].role").alias("first_role"), F.md5("json").alias("digest"))


json_documents_sql = """WITH d AS (SELECT conv_id, count(*) AS n, arg_min(role, turn) AS r, string_agg('{"turn":' || turn || ',"role":"' || role || '","size":' || length(text) || '}', ',' ORDER BY turn, role, length(text)) AS t FROM conversations GROUP BY conv_id)
SELECT conv_id, CAST(n AS INTEGER) AS count, r AS first_role, md5('{"count":' || n || ',"turns":[' || t || ']}') AS digest FROM d"""


def stream_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-01 (streaming form), AGG-05: events by five-minute window, as a stream that reads what there is."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    place = scratch.folder(spark, "usage")
    found = streams.usage(spark.readStream.schema(schema).parquet(f"{path}*"))
    streams.kept(found, f"{place}/table", f"{place}/checkpoint").awaitTermination()
    return streams.latest(spark, f"{place}/table", found.schema, ["start", "event_type"]).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "calls", F.round("value", 4).alias("value"))


stream_usage_sql = "SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS start, event_type, count(*) AS calls, round(sum(value), 4) AS value FROM events GROUP BY 1, 2"

NAMES = ("sitemap_pages", "page_markdown", "page_blocks", "layout_chunks", "model_facts", "json_documents", "stream_usage")
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[f"{n}_sql"] for n in NAMES if f"{n}_sql" in globals()}
