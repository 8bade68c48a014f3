"""Queries over captured pages: URLs, links, scores, manifests and frontiers; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import urls
from factloom.functions.expr import alternation
from factloom.operators import discovery, frontier, links
from factloom.sources import scratch


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")


def _q(words: list[str]) -> str:
    return "'" + alternation(words).replace("'", "''") + "'"


PARTS = "'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)'"
PATH = f"regexp_extract(url, {PARTS}, 3)"
HOST = f"regexp_extract(url, {PARTS}, 2)"


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-01, URL-03, FLT-18: normal form, host, path, depth, slug and country."""
    u = F.col("url")
    return pages(spark, sf_dir).select("page_id", urls.normalise(u).alias("normal"), urls.scheme(u).alias("scheme"), urls.host(u).alias("host"), urls.path(u).alias("path"), urls.depth(u).alias("depth"), urls.slug(u).alias("slug"), urls.slug_title(urls.slug(u)).alias("slug_title"), urls.country(u).alias("country"))


_COUNTRY = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in urls.COUNTRIES.items())
url_parts_sql = f"""
WITH p AS (SELECT page_id, {HOST} AS host, {PATH} AS path, regexp_extract(url, {PARTS}, 1) AS s FROM pages),
l AS (SELECT *, string_split(lower(regexp_replace(host, ':[0-9]+$', '')), '.') AS labels, lower(list_last(string_split(regexp_replace(path, '/+$', ''), '/'))) AS slug FROM p)
SELECT page_id, regexp_replace(s || '://' || host || path, '/+$', '') AS normal, lower(s) AS scheme, host, path,
 CAST(len(list_filter(string_split(path, '/'), lambda x: x <> '')) AS INTEGER) AS depth, slug,
 array_to_string(list_transform(string_split(regexp_replace(slug, '[-_]+', ' ', 'g'), ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ') AS slug_title,
 coalesce(CASE WHEN len(labels) > 1 THEN CASE labels[-2] || '.' || labels[-1] {_COUNTRY} END END, CASE labels[-1] {_COUNTRY} END, 'unknown') AS country FROM l"""


def url_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-01: pattern scores of every page's and every link's URL, with the evidence that makes them up."""
    found = links.anchors(pages(spark, sf_dir)).withColumn("url", urls.resolve(F.col("url"), F.col("href")))
    map_ = discovery.evidence(F.col("url"), F.lit("navigation"))
    listed = F.array_sort(F.transform(F.map_entries(map_), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))))
    return found.select("page_id", "pos", "url", discovery.score(F.col("url"), F.lit("navigation")).alias("score"), F.concat_ws(",", listed).alias("evidence"))


RESOLVED = f"""regexp_replace(CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
 WHEN href LIKE '//%' THEN regexp_extract(base, {PARTS}, 1) || ':' || href
 WHEN href LIKE '/%' THEN root || href WHEN href = '' THEN regexp_replace(base, '#.*$', '') WHEN href LIKE '?%' THEN root || bpath || href
 ELSE root || CASE WHEN regexp_replace(bpath, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(bpath, '[^/]*$', '') END || href END, '^/+|/+$', '', 'g')"""
ANCHORS = f"""found AS (SELECT page_id, url AS base, unnest(regexp_extract_all(html, '{links.ANCHOR}', 1)) AS h, unnest(regexp_extract_all(html, '{links.ANCHOR}', 2)) AS i, unnest(range(len(regexp_extract_all(html, '{links.ANCHOR}', 1)))) AS pos FROM pages),
spaced AS (SELECT page_id, base, pos, regexp_replace(regexp_replace(h, '^\\s+|\\s+$', '', 'g'), '#.*$', '') AS href, regexp_replace(h, '^\\s+|\\s+$', '', 'g') AS raw,
 trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(i, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g')) AS text,
 regexp_extract(base, {PARTS}, 1) || '://' || regexp_extract(base, {PARTS}, 2) AS root, regexp_extract(base, {PARTS}, 3) AS bpath FROM found),
anchors AS (SELECT page_id, base, CAST(pos AS INTEGER) AS pos, raw AS href, text, {RESOLVED} AS url FROM spaced)"""
_WEIGHTS = discovery.POSITIVE + discovery.NEGATIVE
url_score_sql = f"""
WITH {ANCHORS}, lowered AS (SELECT *, lower({PATH}) AS p FROM anchors),
parts AS (SELECT *, list_filter([{', '.join(f"{{'k': '{k}', 'v': CASE WHEN regexp_matches(p, '\\b(?:{k})\\b') THEN {w} END}}" for k, w in _WEIGHTS)}, {{'k': 'source', 'v': 10}}], lambda e: e.v IS NOT NULL) AS e FROM lowered)
SELECT page_id, pos, url, CAST(list_sum(list_transform(e, lambda x: x.v)) AS INTEGER) AS score, array_to_string(list_sort(list_transform(e, lambda x: x.k || '=' || x.v)), ',') AS evidence FROM parts"""


def links_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-05, FLT-06, URL-02, SRC-05: the classified links of every page, those of English pages included."""
    return links.discover(pages(spark, sf_dir), bad_parts=links.BAD_PARTS[:2])


def _classify_sql() -> str:
    has = lambda c, words: f"regexp_matches({c}, {_q(words)})"
    kind = lambda t, c, p, n: f"{{'type': '{t}', 'category': '{c}', 'purpose': '{p}', 'priority': {n}}}"
    cases = [(has("lp", links.LANGUAGE_WORDS), kind("page", "language", "navigation", 0))]
    cases += [(f"lower(url) LIKE '%.pdf' AND {has('v', w)}", kind("pdf", n, "evidence", 100)) for n, w in links.PDF_KINDS]
    cases += [("lower(url) LIKE '%.pdf'", kind("pdf", "pdf", "evidence", 100)), (has("v", links.RESEARCH_WORDS), kind("page", "research", "navigation", 0))]
    for n, w, p in links.PAGE_KINDS:
        if n == "department":
            cases.append((f"{has('v', w)} AND {has('v', links.GENERIC_WORDS)}", kind("page", n, "navigation", 0)))
        cases.append((has("v", w), kind("page", n, "evidence", p)))
    cases += [(has("v", links.IGNORE_WORDS), kind("page", "ignore", "navigation", 0)), ("lp LIKE '%sitemap%'", kind("page", "sitemap", "discovery", 40)), ("lp LIKE '%search%'", kind("page", "search", "discovery", 30))]
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in cases) + f" ELSE {kind('page', 'other', 'navigation', 10)} END"


LINKS = f"""{ANCHORS},
firsts AS (SELECT * FROM anchors WHERE href <> '' AND NOT regexp_matches(href, '^({'|'.join(links.SCHEMES)})') AND url <> regexp_replace(base, '^/+|/+$', '', 'g') QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY pos) = 1),
kept AS (SELECT *, lower(url || ' ' || text) AS v, lower({PATH}) AS lp, {HOST} AS domain FROM firsts WHERE text <> '' AND lower(text) NOT IN ({', '.join(f"'{b}'" for b in links.BUTTONS)}) AND NOT regexp_matches(lower(text), {_q(links.NAVIGATION_WORDS)}) AND NOT regexp_matches(lower({HOST}), {_q(links.DOMAINS)}) AND NOT regexp_matches(lower(url), {_q(links.BAD_PARTS[:2])})),
classed AS (SELECT *, {_classify_sql()} AS k FROM kept),
links AS (SELECT page_id, pos, 'program_page' AS source, 'direct' AS relation, k.type AS type, text AS title, url, domain, ends_with(domain, regexp_replace(regexp_extract(base, {PARTS}, 2), '^www\\.', '')) AS internal, k.category AS category, k.purpose AS purpose, CAST(k.priority AS INTEGER) AS priority, false AS visited FROM classed)"""
links_discover_sql = f"WITH {LINKS} SELECT * FROM links"


def links_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02, SNK-02: link counts of every page."""
    return links.summary(links_discover(spark, sf_dir))


links_summary_sql = f"WITH {LINKS} SELECT page_id, count(*) AS total_links, count_if(purpose = 'evidence') AS evidence_links, count_if(type = 'pdf') AS pdf_links, count_if(purpose = 'discovery') AS discovery_links FROM links GROUP BY page_id"


def links_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-02, ORD-05: the ten first links of all pages in link order (the report's limit)."""
    return links_discover(spark, sf_dir).orderBy(*links.link_order(), "page_id").limit(10).select("page_id", "pos", "type", "category", "priority", "title")


links_top_sql = f"WITH {LINKS} SELECT page_id, pos, type, category, priority, title FROM links ORDER BY priority DESC, type, category, lower(title), pos, page_id LIMIT 10"


def manifest_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-03, CMP-08, ORD-03, ORD-07, SNK-04: each page's queue of best links. Classes are derived from labels' sizes."""
    found = links_discover(spark, sf_dir)
    n = F.length("title") % 12
    cases = [F.when(n == i, F.struct(F.lit(c).alias("c"), F.lit(p).alias("p"))) for i, (c, _, p) in enumerate(links.PAGE_KINDS)]
    kind = F.coalesce(*cases)
    found = found.withColumn("_k", kind).withColumn("category", F.coalesce("_k.c", F.lit("other"))).withColumn("priority", F.coalesce("_k.p", F.lit(10))).withColumn("purpose", F.when(n < 8, "evidence").otherwise("navigation")).drop("_k")
    return links.manifest(found).select("page_id", "id", "url", "title", "category", "priority", "depth", "expand", "status", "category_rank")


_KIND = "CASE length(title) % 12 " + " ".join(f"WHEN {i} THEN {{'c': '{c}', 'p': {p}}}" for i, (c, _, p) in enumerate(links.PAGE_KINDS)) + " END"
_RANK = "CASE category " + " ".join(f"WHEN '{c}' THEN {i + 1}" for i, c in enumerate(links.MANIFEST_ORDER)) + " ELSE 99 END"
manifest_queue_sql = f"""
WITH {LINKS}, k AS (SELECT page_id, pos, url, title, {_KIND} AS k FROM links),
best AS (SELECT page_id, pos, url, title, k.c AS category, CAST(k.p AS INTEGER) AS priority FROM k WHERE k IS NOT NULL AND k.p >= 50 QUALIFY row_number() OVER (PARTITION BY page_id, k.c ORDER BY k.p DESC, length(url), pos) = 1)
SELECT page_id, printf('%04d', row_number() OVER (PARTITION BY page_id ORDER BY {_RANK}, priority DESC, pos)) AS id, url, title, category, priority, 1 AS depth, category IN ({', '.join(f"'{c}'" for c in links.EXPANDED)}) AS expand, 'pending' AS status, CAST({_RANK} AS INTEGER) AS category_rank FROM best"""


def strategy_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-01, SET-01, AGG-01, ORD-01: candidates of three strategies merged by URL, the first strategy's winning."""
    p = pages(spark, sf_dir)
    sitemap = p.select(urls.normalise(F.col("url")).alias("url"), F.lit("sitemap").alias("source"), F.col("page_id").alias("pos"))
    found = links.anchors(p).select(urls.resolve(F.col("url"), F.col("href")).alias("url"), F.lit("navigation").alias("source"), (F.col("page_id") * 1000 + F.col("pos")).alias("pos"))
    roots = p.select(urls.normalise(F.regexp_replace("url", r"/[0-9]+([?#].*)?$", "")).alias("url"), F.lit("crawler").alias("source"), F.col("page_id").alias("pos"))
    merged = discovery.merge(sitemap.unionByName(found).unionByName(roots))
    return merged.select("url", "source", "pos", "source_rank", discovery.score(F.col("url"), F.col("source")).alias("score"))


_SCORE = lambda c: " + ".join(f"CASE WHEN regexp_matches({c}, '\\b(?:{k})\\b') THEN {w} ELSE 0 END" for k, w in _WEIGHTS)
NORMAL = "regexp_replace(regexp_extract(u, P, 1) || '://' || regexp_extract(u, P, 2) || regexp_extract(u, P, 3), '/+$', '')".replace("P", PARTS)
CANDIDATES = f"""{ANCHORS},
candidates AS (SELECT {NORMAL} AS url, 'sitemap' AS source, page_id AS pos, 10 AS source_rank FROM (SELECT url AS u, page_id FROM pages)
 UNION ALL SELECT url, 'navigation', page_id * 1000 + pos, 20 FROM anchors
 UNION ALL SELECT {NORMAL}, 'crawler', page_id, 50 FROM (SELECT regexp_replace(url, '/[0-9]+([?#].*)?$', '') AS u, page_id FROM pages))"""
strategy_merge_sql = f"""
WITH {CANDIDATES}
SELECT url, source, pos, CAST(source_rank AS INTEGER) AS source_rank, CAST({_SCORE(f"lower({PATH})")} + CASE source WHEN 'navigation' THEN 10 WHEN 'sitemap' THEN 5 ELSE 0 END AS INTEGER) AS score FROM candidates QUALIFY row_number() OVER (PARTITION BY url ORDER BY source_rank, pos) = 1"""


def strategy_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01: candidates by strategy before the merge."""
    p = pages(spark, sf_dir)
    found = links.anchors(p).select(F.lit("navigation").alias("source"))
    return discovery.statistics(p.select(F.lit("sitemap").alias("source")).unionByName(found))


strategy_statistics_sql = f"WITH {ANCHORS} SELECT source, count(*) AS candidates FROM (SELECT 'navigation' AS source FROM anchors UNION ALL SELECT 'sitemap' FROM pages) GROUP BY source"


def site_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-07, JON-11: all search requests of every host."""
    bases = pages(spark, sf_dir).select(F.concat(F.lit("https://"), urls.host(F.col("url"))).alias("base_url")).distinct()
    return discovery.searches(bases)


site_search_sql = f"""
SELECT base_url, path, term, base_url || path || '?q=' || replace(term, ' ', '+') AS url FROM (SELECT DISTINCT 'https://' || {HOST} AS base_url FROM pages),
 (SELECT unnest([{', '.join(f"'{p}'" for p in discovery.SEARCH_PATHS)}]) AS path), (SELECT unnest([{', '.join(f"'{t}'" for t in discovery.SEARCH_TERMS)}]) AS term)"""


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10, FLT-18: title, first h1 and language of every page, and the name to show."""
    grab = lambda tag: links.plain(F.regexp_extract("html", rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1))
    rows = pages(spark, sf_dir).select("page_id", grab("title").alias("title"), grab("h1").alias("h1"), F.lower(F.regexp_extract("html", r'(?is)<html\b[^>]*\blang="([^"]*)"', 1)).alias("lang"))
    return rows.withColumn("display_name", F.coalesce(F.nullif("h1", F.lit("")), F.nullif("title", F.lit("")), F.lit("")))


_PLAIN = lambda x: f"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({x}, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g'))"""
_GRAB = lambda tag: _PLAIN(f"regexp_extract(html, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>', 1)")
page_metadata_sql = f"""WITH m AS (SELECT page_id, {_GRAB('title')} AS title, {_GRAB('h1')} AS h1, lower(regexp_extract(html, '(?is)<html\\b[^>]*\\blang="([^"]*)"', 1)) AS lang FROM pages)
SELECT *, coalesce(nullif(h1, ''), nullif(title, ''), '') AS display_name FROM m"""


def page_reevaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-02: scores after metadata; page types and schemas are derived from the page's number."""
    types = F.array(*[F.lit(t) for t in ("Degree Programme", "Programme Hub", "News", "Unknown")])
    rows = page_metadata(spark, sf_dir).join(pages(spark, sf_dir).select("page_id", "url"), "page_id")
    rows = rows.select("page_id", F.col("title").alias("title_en"), F.col("h1").alias("h1_en"), F.get(types, (F.col("page_id") % 4).cast("int")).alias("page_type"), F.when(F.col("page_id") % 3 == 0, F.array(F.lit("Course"))).otherwise(F.array(F.lit("WebPage"))).alias("schema_types"), discovery.evidence(F.col("url"), F.lit("sitemap")).alias("evidence"))
    return discovery.reevaluate(rows).select("page_id", "page_type", "score", F.size("evidence").alias("pieces"))


page_reevaluation_sql = f"""
WITH m AS (SELECT page_id, lower({_GRAB('title')} || ' ' || {_GRAB('h1')}) AS t, lower({PATH}) AS p FROM pages)
SELECT page_id, ['Degree Programme', 'Programme Hub', 'News', 'Unknown'][page_id % 4 + 1] AS page_type,
 CAST({_SCORE('p')} + 5 + CASE page_id % 4 WHEN 0 THEN 50 WHEN 3 THEN 0 ELSE -100 END + CASE WHEN regexp_matches(t, '{discovery.DEGREE}') THEN 20 ELSE -20 END + CASE WHEN page_id % 3 = 0 THEN 30 ELSE 0 END AS INTEGER) AS score,
 CAST(1 + {' + '.join(f"CAST(regexp_matches(p, '\\b(?:{k})\\b') AS INTEGER)" for k, _ in _WEIGHTS)} + CAST(page_id % 4 <> 3 AS INTEGER) + 1 + CAST(page_id % 3 = 0 AS INTEGER) AS INTEGER) AS pieces FROM m"""


def programme_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-03, FLT-04, FLT-13: what a crawler makes of each link."""
    found = links.anchors(pages(spark, sf_dir)).withColumn("url", urls.resolve(F.col("url"), F.col("href")))
    u, t = F.col("url"), F.col("text")
    return found.select("page_id", "pos", urls.looks_like_programme(u, t).alias("programme"), urls.worth_following(u, t).alias("follow"), urls.skipped(u).alias("skip"), F.coalesce(urls.platform(u), F.lit("")).alias("platform"))


programme_predicates_sql = f"""
WITH {ANCHORS}, l AS (SELECT *, lower({PATH}) AS p, regexp_replace(lower({HOST}), '^(www|m)\\.', '') AS h FROM anchors)
SELECT page_id, pos, regexp_matches(p || ' ' || trim(lower(text)), {_q(urls.PROGRAMME_WORDS)}) AND NOT ({' OR '.join(f"ends_with(p, '{e}')" for e in urls.HUB_ENDINGS)}) AND len(list_filter(string_split(p, '/'), lambda x: x <> '')) >= 2 AS programme,
 regexp_matches(lower(url || ' ' || text), {_q(urls.FOLLOW_WORDS)}) AS follow, regexp_matches(p, {_q(urls.SKIP_WORDS)}) AS skip,
 CASE {' '.join(f"WHEN h = '{d}' OR ends_with(h, '.{d}') THEN '{n}'" for d, n in urls.SOCIAL.items())} ELSE '' END AS platform FROM l"""


def frontier_enqueue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-03, STM-01: links of the first level's pages that the queue does not hold yet."""
    p = pages(spark, sf_dir).withColumn("url", urls.normalise(F.col("url")))
    queue = p.groupBy("url").agg(F.min("page_id").alias("page_id")).select("url", F.lit(1).alias("depth"), (F.col("page_id") % 2 == 0).alias("expand"), F.lit("completed").alias("status"))
    found = links.anchors(p).select(F.col("url").alias("parent_url"), urls.resolve(F.col("url"), F.col("href")).alias("url"), (F.col("page_id") * 1000 + F.col("pos")).alias("pos"), F.lit(True).alias("internal"), F.when(F.length("text") > 3, "evidence").otherwise("navigation").alias("purpose"), F.lit(80).alias("priority"), F.lit("department").alias("category"))
    return frontier.enqueue(queue, found)


frontier_enqueue_sql = f"""
WITH norm AS (SELECT {NORMAL} AS url, page_id, html FROM (SELECT url AS u, page_id, html FROM pages)),
{ANCHORS.replace('FROM pages)', 'FROM norm)')},
queue AS (SELECT url, min(page_id) % 2 = 0 AS expand FROM norm GROUP BY url),
hops AS (SELECT base AS parent, url, page_id * 1000 + pos AS pos FROM anchors WHERE length(text) > 3)
SELECT url, parent, 80 AS priority, 'department' AS category, 2 AS depth, false AS expand, 'pending' AS status FROM hops
WHERE parent IN (SELECT url FROM queue WHERE expand) AND url NOT IN (SELECT url FROM queue) QUALIFY row_number() OVER (PARTITION BY url ORDER BY parent, pos) = 1"""


def liveness_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-02, SRC-11: candidates whose URL answers; those captured as a page here."""
    p = pages(spark, sf_dir)
    found = strategy_merge(spark, sf_dir)
    return frontier.alive(found, p.select(urls.normalise(F.col("url")).alias("url"))).select("url", "source", "score")


liveness_semi_sql = f"""WITH merged AS ({strategy_merge_sql}) SELECT url, source, score FROM merged WHERE url IN (SELECT {NORMAL} FROM (SELECT url AS u FROM pages))"""


def _edges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/nation.parquet")
    edges = events.select(F.col("n_nationkey").alias("src"), F.explode(F.array(((F.col("n_nationkey") * 2 + 1) % 25), ((F.col("n_nationkey") * 3 + 7) % 25))).alias("dst"))
    return events.where("n_nationkey = 0").select(F.col("n_nationkey").alias("node")), edges


def bfs_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-02, SRC-08, SRC-09: nodes by their least distance from a seed, level by level."""
    return frontier.expand(*_edges(spark, sf_dir), max_depth=4, cut=scratch.cutter(spark, "reach"))


bfs_reach_sql = """WITH RECURSIVE e AS (SELECT n_nationkey AS src, unnest([(n_nationkey * 2 + 1) % 25, (n_nationkey * 3 + 7) % 25]) AS dst FROM nation),
w(node, depth) AS (SELECT 0, 0 UNION SELECT e.dst, w.depth + 1 FROM w JOIN e ON e.src = w.node WHERE w.depth < 4)
SELECT CAST(node AS INTEGER) AS node, CAST(min(depth) AS INTEGER) AS depth FROM w GROUP BY node"""


def crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-08, FLT-03, FLT-04, FLT-13: the links that crawls of all sites come upon; each site's pages are its seeds."""
    p = pages(spark, sf_dir)
    seeds = p.select(frontier.site_of(F.col("url")).alias("site"), urls.normalise(F.col("url")).alias("url")).distinct()
    return frontier.crawl(seeds, p, cut=scratch.cutter(spark, "crawl"))


crawl_pages_sql = f"""
WITH RECURSIVE norm AS (SELECT {NORMAL} AS url, page_id, html FROM (SELECT url AS u, page_id, html FROM pages)),
{ANCHORS.replace('FROM pages)', 'FROM norm)')},
starts AS (SELECT DISTINCT regexp_replace({HOST}, '^www\\.', '') AS site, url FROM norm),
hops AS (SELECT page_id, pos, base, text, url, {HOST} AS h, lower({PATH}) AS p FROM (SELECT page_id, pos, base, text, {NORMAL} AS url FROM (SELECT *, url AS u FROM anchors))),
sited AS (SELECT s.site, hops.* FROM hops JOIN (SELECT DISTINCT site FROM starts) s ON h = s.site OR ends_with(h, '.' || s.site) WHERE NOT regexp_matches(p, {_q(urls.SKIP_WORDS)})),
w(site, url) AS (SELECT site, url FROM starts UNION SELECT sited.site, sited.url FROM sited JOIN w ON sited.site = w.site AND sited.base = w.url)
SELECT s.site, s.url, page_id, pos, text, regexp_matches(p || ' ' || trim(lower(text)), {_q(urls.PROGRAMME_WORDS)}) AND NOT ({' OR '.join(f"ends_with(p, '{e}')" for e in urls.HUB_ENDINGS)}) AND len(list_filter(string_split(p, '/'), lambda x: x <> '')) >= 2 AS programme,
 regexp_matches(lower(s.url || ' ' || text), {_q(urls.FOLLOW_WORDS)}) AS follow
FROM sited s JOIN w ON s.site = w.site AND s.base = w.url QUALIFY row_number() OVER (PARTITION BY s.site, s.url ORDER BY page_id, pos) = 1"""


def crawl_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-09: what plain crawls come upon, each from the first captured page of a host."""
    p = pages(spark, sf_dir)
    starts = p.groupBy(urls.host(F.col("url")).alias("h")).agg(F.min_by("url", "page_id").alias("u")).select(urls.normalise(F.col("u")).alias("url"))
    return frontier.crawl_host(starts, p, scratch.cutter(spark, "hosts"))


crawl_hosts_sql = f"""
WITH RECURSIVE norm AS (SELECT {NORMAL} AS url, page_id, html FROM (SELECT url AS u, page_id, html FROM pages)),
{ANCHORS.replace('FROM pages)', 'FROM norm)')},
e AS (SELECT DISTINCT base AS src, url AS dst FROM (SELECT base, {NORMAL} AS url FROM (SELECT base, url AS u FROM anchors)) WHERE {HOST} = regexp_extract(base, {PARTS}, 2)),
w(url) AS (SELECT arg_min(url, page_id) FROM norm GROUP BY {HOST} UNION SELECT e.dst FROM e JOIN w ON e.src = w.url)
SELECT DISTINCT url FROM w"""


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NST-07 (regex part), STR-04: the visible text of every page, without scripts, styles and other dropped elements."""
    dropped = r"(?is)<(script|style|noscript|svg|iframe|nav|footer)\b.*?</(?:script|style|noscript|svg|iframe|nav|footer)\s*>|<!--.*?-->"
    text = links.plain(F.regexp_replace("html", dropped, " "))
    return pages(spark, sf_dir).select("page_id", text.alias("text"), F.length(text).cast("long").alias("characters"))


html_text_sql = f"""WITH t AS (SELECT page_id, {_PLAIN("regexp_replace(html, '(?is)<(script|style|noscript|svg|iframe|nav|footer)\\b.*?</(?:script|style|noscript|svg|iframe|nav|footer)\\s*>|<!--.*?-->', ' ', 'g')")} AS text FROM pages) SELECT page_id, text, length(text) AS characters FROM t"""

NAMES = ("url_parts", "url_score", "links_discover", "links_summary", "links_top", "manifest_queue", "strategy_merge", "strategy_statistics", "site_search", "page_metadata", "page_reevaluation", "programme_predicates", "frontier_enqueue", "liveness_semi", "bfs_reach", "crawl_pages", "crawl_hosts", "html_text")
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[f"{n}_sql"] for n in NAMES}
