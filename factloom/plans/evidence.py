"""Queries over made captures: packs, fact files, layouts, services, sinks and page noise; each with its SQL.

Files, replies and statuses are made of the tables, in several shapes each; the SQL states what must come out of them
without the engine's patterns.
"""

from __future__ import annotations

import gzip
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from factloom.functions import html, numbers, text, values
from factloom.operators import discovery, facts, frontier, layout, pdf_facts, profiles, usage
from factloom.operators import enrichment as enriching
from factloom.plans import university, web
from factloom.plans.captures import _host_files, sitemap_pages_sql
from factloom.plans.records import _sides, enrich_merge_sql, table
from factloom.sources import packs, scratch, services, sinks, sitemaps


def _case(n: Column, *shapes: Column) -> Column:
    """The shape whose place is n modulo their number."""
    out = shapes[-1]
    for i, shape in reversed(list(enumerate(shapes[:-1]))):
        out = F.when(n % len(shapes) == i, shape).otherwise(out)
    return out


def candidates_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-01, DED-01: the hundred best of the merged candidates, ties in the order of discovery."""
    return discovery.ranked(web.strategy_merge(spark, sf_dir), 100).select("url", "score", "source_rank", "pos")


candidates_ranked_sql = f"WITH m AS ({web.strategy_merge_sql}) SELECT url, score, source_rank, pos FROM m ORDER BY score DESC, source_rank, pos, url LIMIT 100"


def rankings_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-06: each customer's rankings, newest first, then by id; missing years and ids count as 0."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.when(k % 5 != 0, F.year("o_orderdate")).alias("year"), F.when(k % 7 != 0, k % 9).alias("ranking_id"), k.alias("pos"))
    return profiles.numbered(rows, "key", "pos").select("key", "pos", "place")


rankings_sorted_sql = """WITH r AS (SELECT o_custkey AS key, CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate) ELSE 0 END AS y, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 9 ELSE 0 END AS i, o_orderkey AS pos FROM orders)
SELECT key, pos, CAST(row_number() OVER (PARTITION BY key ORDER BY y DESC, i, pos) AS INTEGER) AS place FROM r"""


def extraction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-09, DED-04: per document calls, facts before and after the dedupe, and pages; suppliers stand for documents."""
    i = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("document"), F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.col("l_linestatus").alias("field"), F.col("l_returnflag").alias("value"))
    calls = i.select("document", F.when(F.col("o") % 3 == 0, "failed").otherwise("success").alias("status"))
    found = i.where("o % 3 <> 0").withColumn("pages", F.array("n", F.col("n") + 1))
    kept = facts.first_of(found, [F.col("document"), F.col("field"), F.col("value")], ["o", "n"])
    return pdf_facts.summary(calls, found, kept, "document").withColumn("pages", F.array_join(F.transform("pages", lambda p: p.cast("string")), ","))


extraction_summary_sql = """WITH i AS (SELECT l_suppkey AS document, l_orderkey AS o, l_linenumber AS n, l_linestatus AS f, l_returnflag AS v FROM lineitem),
c AS (SELECT document, count_if(o % 3 <> 0) AS succeeded, count_if(o % 3 = 0) AS failed FROM i GROUP BY 1),
k AS (SELECT * FROM i WHERE o % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY document, f, v ORDER BY o, n) = 1),
p AS (SELECT document, string_agg(DISTINCT page, ',' ORDER BY page) AS pages FROM (SELECT document, unnest([n, n + 1]) AS page FROM k) GROUP BY 1),
s AS (SELECT document, count(*) AS kept FROM k GROUP BY 1)
SELECT document, succeeded, failed, succeeded AS facts_found, coalesce(kept, 0) AS facts_kept, succeeded - coalesce(kept, 0) AS duplicates, coalesce(pages, '') AS pages FROM c LEFT JOIN s USING (document) LEFT JOIN p USING (document)"""


def profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13: counts over each customer's nested profile: rankings (by status), their histories and criteria."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.collect_list("o_orderkey").alias("history"), F.when(F.col("o_orderstatus") != "P", F.collect_set("o_orderpriority")).alias("criteria"))
    held = o.groupBy("o_custkey").agg(F.collect_list(F.struct("history", "criteria")).alias("rankings"))
    rows = table(spark, sf_dir, "customer").join(held, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", profiles.summary(F.struct("rankings")).alias("s")).select("c_custkey", "s.*")


profile_summary_sql = """WITH o AS (SELECT o_custkey, o_orderstatus AS s, count(*) AS h, count(DISTINCT o_orderpriority) AS c FROM orders GROUP BY 1, 2)
SELECT c_custkey, CAST(count(s) AS INTEGER) AS rankings, CAST(coalesce(sum(h), 0) AS INTEGER) AS history, CAST(coalesce(sum(CASE WHEN s <> 'P' THEN c END), 0) AS INTEGER) AS criteria FROM customer LEFT JOIN o ON o_custkey = c_custkey GROUP BY 1"""


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-16: the greatest page among the nested regions of each order's items; 0 where there are none."""
    page = lambda c: F.struct(F.col(c).cast("int").alias("page_number"))
    region = F.when(F.col("l_orderkey") % 10 == 0, F.array().cast("array<struct<page_number: int>>")).otherwise(F.array(page("l_linenumber"), page("l_quantity")))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(region).alias("r")).select("l_orderkey", layout.page_count(F.col("r")).alias("pages"))


page_counts_sql = "SELECT l_orderkey, CASE WHEN l_orderkey % 10 = 0 THEN 0 ELSE CAST(max(greatest(l_linenumber, CAST(trunc(l_quantity) AS INTEGER))) AS INTEGER) END AS pages FROM lineitem GROUP BY 1"

#: Line shapes (before and after a number), and whether they are page labels, and noise that may be dropped.
LINES = [
    ("Page ", "", True, True), ("SEITE ", " von 9", True, True), ("  ", "  ", True, True), ("Page", "", False, False), ("1234", "5", False, False), ("see page ", "", False, True),
    ("www.example.com/", "", False, True), ("Copyright University ", "", False, True), ("plain words of text ", "", False, False), ("Version 2 of a line that has far more words than fourteen so that it may not be dropped ", "", False, False), ("page ", " of", False, True), ("Modulhandbuch  Physik ", "", False, True),
]


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-10, AGG-10: which lines are page labels, and which repeated ones may be dropped as noise."""
    n = F.col("l_linenumber").cast("string")
    shapes = [F.lit(a) if a == "Page" else F.concat(F.lit(a), n, F.lit(b)) for a, b, _, _ in LINES]
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _case(F.col("l_orderkey"), *shapes).alias("line"))
    clean = F.lower(F.trim(F.regexp_replace("line", r"\s+", " ")))
    return rows.select("l_orderkey", "l_linenumber", text.is_page_label(F.col("line")).alias("label"), layout.safe_noise(clean).alias("noise"))


_PICK = lambda i, then: f"CASE l_orderkey % {len(LINES)} " + " ".join(f"WHEN {k} THEN {then(x[i])}" for k, x in enumerate(LINES)) + " END"
page_labels_sql = f"SELECT l_orderkey, l_linenumber, {_PICK(2, str)} AS label, {_PICK(3, str)} AS noise FROM lineitem"


def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NST-06: sorted distinct pages of lists and ranges, of ranges exactly as wide as allowed and wider by one too."""
    k = F.col("o_orderkey").cast("int")
    start = k % 50
    end = start + _case(k, F.lit(500), F.lit(501), F.lit(5), F.lit(-1), F.lit(None).cast("int"))
    listed = F.when(k % 3 != 0, F.array(k % 7, F.lit(3), F.lit(3)))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", values.page_numbers(listed, start, end).alias("p"))
    return rows.select("o_orderkey", F.size("p").alias("pages"), F.coalesce(F.array_min("p"), F.lit(-1)).alias("first"), F.coalesce(F.array_max("p"), F.lit(-1)).alias("last"), F.md5(F.array_join("p", ",")).alias("digest"))


page_ranges_sql = """WITH r AS (SELECT o_orderkey, o_orderkey % 50 AS a, CASE o_orderkey % 5 WHEN 0 THEN 500 WHEN 2 THEN 5 END AS n, CASE WHEN o_orderkey % 3 <> 0 THEN [o_orderkey % 7, 3, 3] ELSE [] END AS l FROM orders),
p AS (SELECT o_orderkey, list_sort(list_distinct(list_concat(l, CASE WHEN n IS NULL THEN [] ELSE range(a, a + n + 1) END))) AS p FROM r)
SELECT o_orderkey, CAST(len(p) AS INTEGER) AS pages, CAST(coalesce(p[1], -1) AS INTEGER) AS first, CAST(coalesce(p[-1], -1) AS INTEGER) AS last, md5(array_to_string(p, ',')) AS digest FROM p"""


def facts_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-08, NUM-08: made facts, trimmed and clamped, with what makes some of them unfit."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("pos"), _case(k, F.lit(" Identity "), F.lit(""), F.lit(None).cast("string"), F.lit("FEES")).alias("category"), _case(k, F.lit("Name"), F.lit("\t "), F.lit("x")).alias("field"), F.when(k % 7 != 0, F.lit("")).alias("value"), _case(k, F.lit("1.7"), F.lit("-0.5"), F.lit("abc"), F.lit("0.25"), F.lit(None).cast("string")).alias("confidence"))
    return facts.checked(rows).select("pos", "category", "field", "confidence", "problem")


facts_checked_sql = """SELECT o_orderkey AS pos, CASE o_orderkey % 4 WHEN 0 THEN 'identity' WHEN 1 THEN '' WHEN 3 THEN 'fees' END AS category, CASE o_orderkey % 3 WHEN 0 THEN 'name' WHEN 1 THEN '' ELSE 'x' END AS field,
 CASE o_orderkey % 5 WHEN 1 THEN 0.0 WHEN 3 THEN 0.25 ELSE 1.0 END::DOUBLE AS confidence,
 CASE WHEN o_orderkey % 4 IN (1, 2) THEN 'category' WHEN o_orderkey % 3 = 1 THEN 'field' WHEN o_orderkey % 7 = 0 THEN 'value' WHEN o_orderkey % 5 = 2 THEN 'confidence' END AS problem FROM orders"""


def _zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hosts' files as captured: sitemaps gzipped, other files as they are, and a gzip file that is cut off."""
    packed = F.pandas_udf(lambda s: s.map(lambda t: gzip.compress(t.encode())), BinaryType())
    files = _host_files(spark, sf_dir)
    content = F.when(F.col("url").endswith(".xml"), packed("text")).otherwise(F.col("text").cast("binary"))
    broken = spark.createDataFrame([("https://cut.example/sitemap.xml", gzip.compress(b"<urlset><url><loc>https://cut.example/a</loc></url></urlset>")[:30], 200)], "url string, content binary, status int")
    rows = files.select("url", content.alias("content"), "status").unionByName(broken)
    return rows.select("url", F.try_validate_utf8(sitemaps.inflate(F.col("content")).cast("string")).alias("text"), "status")


def sitemap_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03, SRC-01, SRC-02: the pages that gzipped sitemaps lead to; a file that does not inflate leads nowhere."""
    return sitemaps.pages(_zipped(spark, sf_dir), max_depth=1).select("sitemap", "url")


sitemap_gzip_sql = sitemap_pages_sql


def sitemap_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-04: the distinct pages of the first 200 sitemaps by URL, none passed over."""
    return sitemaps.all_pages(_host_files(spark, sf_dir))


sitemap_all_sql = f"""WITH p AS (SELECT 'https://' || {web.HOST} AS b, 'https://' || {web.HOST} || '/map-' || page_id % 2 || '.xml' AS sitemap, {web.NORMAL} AS url FROM (SELECT *, url AS u FROM pages)),
r AS (SELECT DISTINCT sitemap FROM p UNION SELECT DISTINCT b || '/sitemap.xml' FROM p ORDER BY 1 LIMIT 200)
SELECT DISTINCT url FROM p WHERE sitemap IN (SELECT sitemap FROM r)"""


def pack_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-13: evidence packs' files as pages: metadata, Markdown, HTML (cleaned before raw) and kind."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    i = F.col("page_id")
    base = F.concat_ws("/", F.lit("file:/packs"), F.concat(F.lit("p"), (i % 10).cast("string")))
    inside = F.concat_ws("/", base, F.lit("pages"), F.lpad(i.cast("string"), 6, "0"))
    meta = F.when(i % 4 == 0, F.lit('{"type": "pdf"}')).otherwise(F.lit('{"type":"page"}'))
    file = lambda where, name, body: F.when(where, F.struct(F.concat_ws("/", inside, F.lit(name)).alias("path"), body.cast("binary").alias("content")))
    made = F.array(file(i % 6 != 5, "metadata.json", meta), file(i % 3 != 0, "page.md", F.concat(F.lit("# "), i.cast("string"))), file(i >= 0, "raw.html", F.col("html")), file(i % 5 == 0, "clean.html", F.substring("html", 1, 20)))
    own = p.select((i % 10).alias("n"), base.alias("base")).distinct().select(F.concat_ws("/", "base", F.lit("webpage"), F.lit("program.md")).alias("path"), F.concat(F.lit("programme "), F.col("n").cast("string")).cast("binary").alias("content"))
    files = p.select(F.explode(F.array_compact(made)).alias("f")).select("f.*").unionByName(own)
    rows = packs.paged(packs.named_files(files))
    return rows.select("program_id", "page_id", "metadata", "markdown", F.md5("html").alias("html"), "is_pdf")


pack_pages_sql = """SELECT 'p' || page_id % 10 AS program_id, lpad(CAST(page_id AS VARCHAR), 6, '0') AS page_id, CASE WHEN page_id % 6 = 5 THEN '{}' WHEN page_id % 4 = 0 THEN '{"type": "pdf"}' ELSE '{"type":"page"}' END AS metadata, CASE WHEN page_id % 3 <> 0 THEN '# ' || page_id ELSE '' END AS markdown, md5(CASE WHEN page_id % 5 = 0 THEN substr(html, 1, 20) ELSE html END) AS html, page_id % 6 <> 5 AND page_id % 4 = 0 AS is_pdf FROM pages
UNION ALL SELECT DISTINCT 'p' || page_id % 10, NULL, '{}', 'programme ' || page_id % 10, md5(''), false FROM pages"""


def fact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-14: the facts of fact files, with their defaults; values keep their JSON type."""
    body = F.concat(F.lit('{"fact_count": 2, "facts": [{"category": " ", "field": "name", "value": '), F.col("c_custkey").cast("string"), F.lit('}, {"field": "", "value": {"a": ["'), F.col("c_mktsegment"), F.lit('"]}, "confidence": 0.5, "category": "fees"}]}'))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.from_json(body, packs.FACTS).alias("d")).select("c_custkey", F.posexplode("d.facts").alias("pos", "f")).select("c_custkey", "pos", "f.*")
    return packs.filled(rows).select("c_custkey", "pos", "category", "field", "confidence", F.to_json("value").alias("value"))


fact_files_sql = """SELECT c_custkey, 0 AS pos, 'other' AS category, 'name' AS field, 1.0::DOUBLE AS confidence, CAST(c_custkey AS VARCHAR) AS value FROM customer UNION ALL SELECT c_custkey, 1, 'fees', 'unknown', 0.5, '{"a":["' || c_mktsegment || '"]}' FROM customer"""


def fact_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-15: where documents of several shapes keep their facts, and how many there are."""
    k = F.col("c_custkey").cast("string")
    listed = F.concat(F.lit('[{"field": "a", "value": '), k, F.lit('}, {"field": "b"}]'))
    wrap = lambda a, b: F.concat(F.lit(a), listed, F.lit(b))
    doc = _case(F.col("c_custkey"), wrap('{"facts": ', "}"), wrap('{"n": 1, "items": ', "}"), wrap('{"data": {"program_facts": ', "}}"), wrap("", ""), F.lit('{"nothing": 1}'), wrap('{"knowledge": {"extracted_facts": ', '}, "facts": 3}'), F.lit("no JSON"))
    found = packs.fact_list(doc)
    return table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(F.size(found), F.lit(-1)).alias("facts"), F.try_variant_get(F.get(found, F.lit(0)), "$.value", "bigint").alias("first"))


fact_lists_sql = "SELECT c_custkey, CASE WHEN c_custkey % 7 IN (4, 6) THEN -1 ELSE 2 END AS facts, CASE WHEN c_custkey % 7 IN (4, 6) THEN NULL ELSE CAST(c_custkey AS BIGINT) END AS first FROM customer"


def _layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layout document of every order: a page for each line number, a table of flags, the Markdown in several places."""
    i = table(spark, sf_dir, "lineitem")
    page = F.struct(F.col("l_linenumber").alias("page_number"), F.array(F.struct(F.col("l_linestatus").alias("content")), F.struct(F.col("l_partkey").cast("string").alias("content"))).alias("lines"))
    cell = F.struct((F.col("l_linenumber") - 1).alias("row_index"), F.lit(0).alias("column_index"), F.col("l_returnflag").alias("content"))
    o = i.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(page)).alias("pages"), F.array_sort(F.collect_list(cell)).alias("cells"), F.max("l_linenumber").alias("n"))
    name = F.concat(F.lit("# Order **"), F.col("l_orderkey").cast("string"), F.lit("**"))
    tables = F.array(F.struct(F.lit("t1").alias("table_id"), F.col("n").alias("row_count"), F.lit(1).alias("column_count"), "cells"))
    structure = F.struct("pages", tables.alias("tables"))
    body = lambda *fields: F.to_json(F.struct(*fields, structure.alias("structure")))
    doc = _case(F.col("l_orderkey"), body(F.struct(name.alias("markdown")).alias("content")), body(name.alias("markdown")), body(F.struct(name.alias("markdown")).alias("document")), body(F.lit(" ").alias("markdown")))
    return o.select(F.col("l_orderkey").alias("document_id"), doc.alias("result"), F.concat(F.lit("sibling "), F.col("l_orderkey").cast("string")).alias("sibling"))


def layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-17, NST-11, SRC-16: Markdown, lines and cells of layout documents, whatever place the Markdown has."""
    made = _layouts(spark, sf_dir)
    held = packs.layout(made, "document_id", "result")
    lines = packs.layout_lines(held, "document_id").groupBy("document_id").agg(F.count(F.lit(1)).alias("lines"), F.max("page").alias("last_page"), F.max("line").alias("greatest"))
    cells = packs.layout_cells(held, "document_id").groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_index", "content"))), lambda c: c["content"]), "").alias("cells"))
    return made.select("document_id", packs.markdown_of(F.col("result"), F.col("sibling")).alias("markdown")).join(lines, "document_id").join(cells, "document_id")


layout_scan_sql = """SELECT l_orderkey AS document_id, CASE WHEN l_orderkey % 4 = 3 THEN 'sibling ' || l_orderkey ELSE '# Order **' || l_orderkey || '**' END AS markdown, 2 * count(*) AS lines, CAST(max(l_linenumber) AS INTEGER) AS last_page, max(greatest(l_linestatus, CAST(l_partkey AS VARCHAR))) AS greatest, string_agg(l_returnflag, '' ORDER BY l_linenumber, l_returnflag) AS cells FROM lineitem GROUP BY 1"""


def layout_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-08: the tables that a layout service's results are written to, read again."""
    made, place = _layouts(spark, sf_dir), scratch.folder(spark, "layouts")
    held = made.join(packs.layout(made, "document_id", "result"), "document_id").withColumn("markdown", packs.markdown_of(F.col("result"), F.col("sibling")))
    sinks.layouts(held, place)
    read = lambda name: spark.read.parquet(f"{place}/{name}")
    count = lambda name: read(name).groupBy("document_id").agg(F.count(F.lit(1)).alias(name))
    documents = read("documents").select("document_id", "text", "pages", "tables")
    return documents.join(read("raw").select("document_id", (F.length("result") > 50).alias("raw")), "document_id").join(count("lines"), "document_id").join(count("cells"), "document_id")


layout_tables_sql = """SELECT l_orderkey AS document_id, CASE WHEN l_orderkey % 4 = 3 THEN 'sibling ' || l_orderkey ELSE 'Order ' || l_orderkey END AS text, CAST(count(*) AS INTEGER) AS pages, 1 AS tables, true AS raw, 2 * count(*) AS lines, count(*) AS cells FROM lineitem GROUP BY 1"""


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("https://h/"), F.col("c_custkey").cast("string")).alias("url"))


def link_alive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11: which links are alive, of servers that answer, refuse HEAD, fail, or raise."""

    def head(url: str) -> int:
        k = int(url.rpartition("/")[2])
        if k % 11 == 0:
            raise OSError("no route")
        return (200, 403, 301, 405, 404, 500)[k % 6]

    return services.liveness(_links(spark, sf_dir), head, lambda url: 200 if int(url.rpartition("/")[2]) % 5 else 410)


link_alive_sql = "SELECT 'https://h/' || c_custkey AS url, c_custkey % 11 <> 0 AND (c_custkey % 6 IN (0, 2) OR c_custkey % 6 IN (1, 3) AND c_custkey % 5 <> 0) AS alive FROM customer"


def downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-12, SRC-18, SRC-19, STM-03: what earlier results lack is downloaded; statuses that pass are tried again."""
    asked: dict[str, int] = {}

    def get(url: str) -> tuple[int, bytes, str | None]:
        k, asked[url] = int(url.rpartition("/")[2]), asked.get(url, 0) + 1
        if k % 4 == 1 and asked[url] < 3:
            return 503, b"", None
        if k % 4 == 2:
            return 404 if k % 8 == 2 else 429, b"", None
        return 200, f"päge {k}".encode("latin-1" if k % 3 == 0 else "utf-8"), "utf-8" if k % 6 == 1 else None

    todo = _links(spark, sf_dir)
    done = todo.where(F.substring_index("url", "/", -1).cast("int") % 10 == 0)
    found = services.downloaded(todo.join(done, "url", "left_anti"), get, delay=0.0)
    return found.select("url", "result", "status", "error")


downloads_sql = """SELECT 'https://h/' || c_custkey AS url, CASE WHEN c_custkey % 4 <> 2 THEN 'päge ' || c_custkey END AS result, CASE WHEN c_custkey % 4 = 2 THEN 'failed' ELSE 'success' END AS status, CASE WHEN c_custkey % 8 = 2 THEN 'OSError: status 404' WHEN c_custkey % 8 = 6 THEN 'OSError: status 429' END AS error FROM customer WHERE c_custkey % 10 <> 0"""


def resumed_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-03, SRC-18: only what an earlier run's results lack is fetched."""
    todo = _links(spark, sf_dir)
    done = todo.where(F.substring_index("url", "/", -1).cast("int") % 3 == 0).union(todo.limit(0))
    return services.fetched(todo.union(todo), lambda url: url.upper(), done).select("url", "result", "status", "attempts")


resumed_fetch_sql = "SELECT 'https://h/' || c_custkey AS url, 'HTTPS://H/' || c_custkey AS result, 'success' AS status, 1 AS attempts FROM customer WHERE c_custkey % 3 <> 0"


def _failing() -> Callable[[int], str]:
    """A service that answers some numbers at once, some at the second or third try, and some never."""
    asked: dict[int, int] = {}

    def service(k: int) -> str:
        asked[k] = asked.get(k, 0) + 1
        if k % 4 == 3 or asked[k] <= k % 4:
            raise RuntimeError(f"down for {k}")
        return f"ok {k}"

    return service


def retried_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM-04: bounded retries, with status, attempts and error of every call."""
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    return services.call(rows, "c_custkey", ["c_custkey"], _failing(), delay=0.0).select("c_custkey", "result", "status", "attempts", "error")


retried_calls_sql = "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 3 THEN 'ok ' || c_custkey END AS result, CASE WHEN c_custkey % 4 = 3 THEN 'failed' ELSE 'success' END AS status, CASE WHEN c_custkey % 4 = 3 THEN 3 ELSE CAST(c_custkey % 4 + 1 AS INTEGER) END AS attempts, CASE WHEN c_custkey % 4 = 3 THEN 'RuntimeError: down for ' || c_custkey END AS error FROM customer"


def _odd_model(content: str) -> str:
    k = int(content.split()[0])
    good = f'{{"category": "fees", "field": "f", "value": "{k}"}}'
    return (f'Sure: {{"facts": [{good}, {{"category": " ", "field": "f", "value": "v"}}, 3]}}', f"[{good}]", '{"facts": []}', "I cannot", '{"facts": {"a": 1}}', f'{{"facts": [{{"category": "x", "field": "f"}}, {good}]}}')[k % 6]


def model_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-09, CMP-04, FLT-16: every reply is kept, an empty one is a failure, and entries that are no facts are told."""
    i = F.col("item_id")
    chunks = table(spark, sf_dir, "benchmark").select(i.alias("chunk_id"), F.when(i % 9 != 8, F.concat_ws(" ", i.cast("string"), "text")).otherwise(F.lit(" \n")).alias("content"))
    found, calls, rejects = services.extracted(chunks, _odd_model)
    place = scratch.folder(spark, "replies")
    sinks.replies(calls, place)
    calls = spark.read.parquet(place)
    n = lambda df, name: df.groupBy("chunk_id").agg(F.count(F.lit(1)).alias(name))
    told = rejects.groupBy("chunk_id").agg(F.array_join(F.array_sort(F.collect_list("problem")), ",").alias("problems"))
    rows = calls.select("chunk_id", "reply", "status", "attempts", F.substring_index("error", ":", 1).alias("error"))
    return rows.join(n(found, "facts"), "chunk_id", "left").join(told, "chunk_id", "left").fillna({"facts": 0, "problems": ""})


model_replies_sql = """WITH r AS (SELECT item_id, item_id % 9 = 8 AS blank, '{"category": "fees", "field": "f", "value": "' || item_id || '"}' AS good FROM benchmark),
a AS (SELECT *, CASE WHEN blank THEN NULL ELSE CASE item_id % 6 WHEN 0 THEN 'Sure: {"facts": [' || good || ', {"category": " ", "field": "f", "value": "v"}, 3]}' WHEN 1 THEN '[' || good || ']' WHEN 2 THEN '{"facts": []}' WHEN 3 THEN 'I cannot' WHEN 4 THEN '{"facts": {"a": 1}}' ELSE '{"facts": [{"category": "x", "field": "f"}, ' || good || ']}' END END AS reply, NOT blank AND item_id % 6 IN (0, 1, 5) AS ok FROM r)
SELECT item_id AS chunk_id, reply, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status, CASE WHEN blank THEN 0 WHEN ok THEN 1 ELSE 3 END AS attempts, CASE WHEN blank THEN 'chunk without content' WHEN NOT ok THEN 'Unfit' END AS error, CAST(CASE WHEN ok THEN 1 ELSE 0 END AS BIGINT) AS facts, CASE WHEN NOT ok THEN '' WHEN item_id % 6 = 0 THEN 'category,no object' WHEN item_id % 6 = 5 THEN 'value' ELSE '' END AS problems FROM a"""


def workspace_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-12, SNK-02: programmes' tables in the workspace's folders; metadata is written once."""
    place = scratch.folder(spark, "workspace")
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), (F.col("s_nationkey") % 3).cast("string")).alias("country"), F.concat(F.lit("u"), (F.col("s_suppkey") % 4).cast("string")).alias("university"), F.col("s_suppkey").alias("k"))
    rows = rows.withColumn("program_id", F.concat_ws("-", "country", "university"))
    sinks.workspace(rows, place, "facts")
    programmes = rows.groupBy("country", "university", "program_id").agg(F.min("k").alias("least"))
    sinks.workspace(programmes.where("university <> 'u0'"), place, "metadata")
    sinks.workspace(programmes.withColumn("least", F.lit(-1).cast("long")), place, "metadata")
    facts_ = spark.read.parquet(f"{place}/facts").groupBy("country", "university", "program_id").agg(F.count(F.lit(1)).alias("facts"))
    return facts_.join(spark.read.parquet(f"{place}/metadata").select("program_id", "least"), "program_id")


workspace_tables_sql = """SELECT 'c' || s_nationkey % 3 AS country, 'u' || s_suppkey % 4 AS university, 'c' || s_nationkey % 3 || '-u' || s_suppkey % 4 AS program_id, count(*) AS facts, CASE WHEN any_value(s_suppkey % 4) = 0 THEN -1 ELSE min(s_suppkey) END AS least FROM supplier GROUP BY 1, 2, 3"""


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-07, SNK-04: a manifest rewritten step by step, each time as a whole new version."""
    place = scratch.folder(spark, "manifest")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.lit("pending").alias("status"), F.lit(0).alias("step"))
    sinks.upsert(rows, place, "c_custkey")
    for step, modulus in ((1, 2), (2, 3), (3, 5)):
        sinks.upsert(rows.where(F.col("c_custkey") % modulus == 0).select("c_custkey", F.lit("completed").alias("status"), F.lit(step).alias("step")), place, "c_custkey")
    return sinks.current(spark, place).select("c_custkey", "status", "step")


upserted_sql = "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'completed' ELSE 'pending' END AS status, CASE WHEN c_custkey % 5 = 0 THEN 3 WHEN c_custkey % 3 = 0 THEN 2 WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS step FROM customer"


def enrichment_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-11, AGG-15: the summary that enrichment's sink writes, by programme and status."""
    place = scratch.folder(spark, "enriched")
    sinks.enrichment(enriching.enrich(*_sides(spark, sf_dir)), place)
    conflicts = spark.read.parquet(f"{place}/conflicts").groupBy("key").agg(F.count(F.lit(1)).alias("conflicting"))
    return spark.read.parquet(f"{place}/summary").join(conflicts, "key", "left")


enrichment_written_sql = f"WITH e AS ({enrich_merge_sql}), c AS (SELECT key, sum(len(string_split(conflicts, ','))) AS n FROM e WHERE conflicts <> '' GROUP BY 1) SELECT e.key, status, count(*) AS facts, CAST(any_value(c.n) AS BIGINT) AS conflicting FROM e LEFT JOIN c ON c.key = e.key GROUP BY 1, 2"


def token_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NUM-07: the cost of each event's tokens at the models' prices; an unknown model costs nothing."""
    names = [*usage.PRICES, "unknown"]
    model = F.get(F.array(*map(F.lit, names)), (F.col("event_id") % len(names)).cast("int"))
    cost = numbers.token_cost(model, F.col("event_id") % 5000, F.col("event_id") % 700, usage.PRICES)
    return table(spark, sf_dir, "events").select("event_id", model.alias("model"), F.round(cost, 9).alias("cost"))


token_costs_sql = """WITH p(i, m, a, b) AS (VALUES (0, 'gpt-4.1', 2.0, 8.0), (1, 'gpt-4.1-mini', 0.4, 1.6), (2, 'gpt-4.1-nano', 0.1, 0.4), (3, 'openai/gpt-oss-120b', 0.15, 0.6), (4, 'meta/llama-3.1-70b-instruct', 0.9, 0.9), (5, 'llama-3.3-70b-versatile', 0.59, 0.79), (6, 'unknown', 0.0, 0.0))
SELECT event_id, m AS model, round((event_id % 5000 * a + event_id % 700 * b)::DOUBLE / 1000000, 9) AS cost FROM events JOIN p ON i = event_id % 7"""


def canonical_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMP-06, STR-02: categories, entity types and fields under their canonical names."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", _case(k, F.lit("Admissions"), F.lit("learning outcome"), F.lit(" "), F.lit("Modules")).alias("category"), _case(k, F.lit("degreeProgramme"), F.lit(None).cast("string"), F.lit("Module")).alias("type"), _case(k, F.lit("Study Programme Name"), F.lit("total ECTS"), F.lit("teachingLanguages"), F.lit("Some Field"), F.lit("")).alias("field"))
    return enriching.canonical(rows)


canonical_facts_sql = "SELECT c_custkey, ['admission', 'learning_outcomes', 'other', 'module'][c_custkey % 4 + 1] AS category, ['program', 'program', 'module'][c_custkey % 3 + 1] AS type, ['program_name', 'total_credits', 'language_of_instruction', 'some_field', 'unknown'][c_custkey % 5 + 1] AS field FROM customer"

#: Titles and contents whose section is known by reading them.
TITLES = [("Admission requirements", "Send your application to us", "admission"), ("Sprachkenntnisse", "IELTS or TOEFL", "language"), ("Modulhandbuch", "Alle Modules mit ECTS credits", "curriculum"), ("Weather", "It rains today", "general"), ("Prüfungsordnung", "Satzung", "regulations"), ("", "The tuition fees and costs are low", "fees_funding"), ("Housing", "accommodation for international students", "student_support")]


def section_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-10: the section types of titled texts, by the shipped words."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", _case(k, *[F.lit(t) for t, _, _ in TITLES]).alias("title"), F.concat(_case(k, *[F.lit(c) for _, c, _ in TITLES]), F.lit(" "), k.cast("string")).alias("content"))
    return layout.keyword_sections(rows, "o_orderkey", F.col("title"), F.col("content"), layout.section_words()).select("o_orderkey", "section")


section_types_sql = f"SELECT o_orderkey, CASE o_orderkey % {len(TITLES)} {' '.join(f'WHEN {i} THEN ' + repr(s) for i, (_, _, s) in enumerate(TITLES))} END AS section FROM orders"

def _handbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layout document of every supplier, of three to seven pages: a header and a page label on each, a heading on odd
    ones, so that a section goes on from an odd page to the next."""
    k, n = F.col("s_suppkey"), F.col("n")
    heading = F.when(n % 2 == 1, F.concat(F.lit("# Admission step "), n.cast("string"), F.lit("\n\n"))).otherwise(F.lit(""))
    body = F.concat(F.lit("www.example.com  Handbook\n"), heading, F.lit("Send form "), n.cast("string"), F.lit(" of "), k.cast("string"), F.lit(" to the office.\n\nPage "), n.cast("string"), F.lit("\n\n"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(1), (3 + k % 5).cast("int"))).alias("n")).withColumn("body", body)
    before = Window.partitionBy("s_suppkey").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("body")).over(before), F.lit(0)).cast("int"))
    made = rows.groupBy("s_suppkey").agg(F.array_sort(F.collect_list(F.struct("n", "body", "start"))).alias("l"))
    spans = F.transform("l", lambda x: F.struct(x["n"].alias("page"), x["start"].alias("start"), (x["start"] + F.length(x["body"])).alias("end")))
    return made.select(F.concat(F.lit("s"), k.cast("string")).alias("key"), F.concat(F.lit("Programme "), k.cast("string")).alias("name"), F.array_join(F.transform("l", lambda x: x["body"]), "").alias("markdown"), spans.alias("pages"))


def pdf_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMP-03, FLT-10, AGG-10, STR-10, JON-07: chunks of handbooks without their page noise, with pages and section types."""
    rows = html.evidence(_handbooks(spark, sf_dir), "key", "markdown", "pages")
    kind = layout.section_type(F.col("section"), F.col("content"), layout.section_words())["section"]
    return rows.select("key", "chunk", "chunk_id", "section", "content", "contains_table", F.array_join("pages", ",").alias("pages"), kind.alias("kind"))


pdf_evidence_sql = """WITH p AS (SELECT s_suppkey AS k, unnest(range(1, 4 + s_suppkey % 5)) AS n FROM supplier),
s AS (SELECT k, n - 1 + n % 2 AS step, string_agg('Send form ' || n || ' of ' || k || ' to the office.', chr(10) || chr(10) ORDER BY n) AS content, string_agg(n, ',' ORDER BY n) AS pages FROM p GROUP BY 1, 2)
SELECT 's' || k AS key, CAST(step // 2 AS INTEGER) AS chunk, 'pdf_s' || k || '_' || lpad(CAST(step // 2 + 1 AS VARCHAR), 4, '0') AS chunk_id, 'Admission step ' || step AS section, content, false AS contains_table, pages, 'admission' AS kind FROM s"""


def _handbook_model(content: str) -> str:
    words = content.split()
    if "form 1 of" not in content:
        return '{"facts": []}'
    k = words[words.index("of") + 1]
    return f'{{"facts": [{{"category": "Fees", "field": "programme_title", "value": "name {k}"}}, {{"category": "admissions", "field": "total_credits", "value": "120"}}, {{"category": "Scholarships", "field": "grant", "value": "G{k}"}}, {{"category": "scholarships", "field": "Grant", "value": "g{k}"}}, {{"category": "fees", "field": " "}}]}}'


def programme_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMP-10, CMP-06, CMP-05, DED-04: web facts and handbooks to enriched, routed facts of every programme."""
    k = F.col("s_suppkey")
    none = F.lit(None).cast("string")
    fact = lambda pos, category, field, value: F.struct(F.lit(pos).cast("long").alias("pos"), F.lit(category).alias("category"), F.lit(field).alias("field"), value.alias("value"))
    made = F.array(fact(1, "fees", "Study Programme Name", F.concat(F.lit("Name "), k.cast("string"))), fact(2, "admission", "total ECTS", _case(k, F.lit(""), F.lit("120"), F.lit("60"))))
    web_facts = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), k.cast("string")).alias("key"), F.lit("Programme").alias("type"), none.alias("id"), F.concat(F.lit("programme "), k.cast("string")).alias("name"), none.alias("parent_id"), none.alias("parent_name"), F.explode(made).alias("f")).select("key", "type", "id", "name", "parent_id", "parent_name", "f.*")
    got = university.enriched(web_facts, _handbooks(spark, sf_dir), _handbook_model)
    return got["facts"].select("key", "origin", "section", "field", "value", "status", F.size("supporting").alias("sources"), F.array_join("conflicts", ",").alias("conflicts"))


programme_output_sql = """SELECT 's' || s_suppkey AS key, 'web' AS origin, 'fees' AS section, 'program_name' AS field, 'Name ' || s_suppkey AS value, 'confirmed' AS status, 1 AS sources, '' AS conflicts FROM supplier
UNION ALL SELECT 's' || s_suppkey, 'web', 'admission', 'total_credits', ['120', '120', '60'][s_suppkey % 3 + 1], ['enriched', 'confirmed', 'conflict'][s_suppkey % 3 + 1], 1, CASE WHEN s_suppkey % 3 = 2 THEN '120' ELSE '' END FROM supplier
UNION ALL SELECT 's' || s_suppkey, 'pdf', 'scholarships', 'grant', 'G' || s_suppkey, 'added_from_pdf', 1, '' FROM supplier"""


def profile_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NST-12: overview, badges, scholarships and further sections of made profiles; some have no such section."""
    k = F.col("s_suppkey")
    s = k.cast("string")
    grants = _case(k, F.lit("There are <b>no scholarships</b> now"), F.lit("Apply for G"), F.lit(" "))
    body = F.concat(F.lit('<div class="box single-badge"><b>1,'), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit('</b> <span class="single-badge-title">Courses</span></div><div class="single-badge">25 Masters</div><div class="single-badge">25 Masters</div><h2 id="a">About us</h2><p>Short</p><div><h3>About '), s, F.lit("</h3><p>A longer text of "), s, F.lit("</p></div><h2>Scholarships</h2>"), grants, F.lit('<h2 class="univ-block-heading">Student Life</h2><ul><li>Clubs</li></ul><h4 class="sec_name">Rankings</h4>first<h2 class="sec_name">Empty</h2>'))
    html_ = F.when(k % 4 == 3, F.lit("<p>nothing</p>")).otherwise(body)
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", html_.alias("html")).withColumn("s", profiles.sections(F.col("html")))
    extra = profiles.extra_sections(F.col("s"), ["ranking", "scholarship"])
    shown = F.transform(profiles.badges(F.col("html")), lambda b: F.concat_ws("=", b["label"], b["value"].cast("int").cast("string")))
    return rows.select("s_suppkey", profiles.overview(F.col("s")).alias("overview"), F.array_join(shown, ";").alias("badges"), profiles.scholarships(F.col("s")).alias("available"), F.array_join(F.transform(extra, lambda x: F.concat_ws(": ", x["title"], x["content"])), ";").alias("further"))


profile_sections_sql = """SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 3 THEN '' ELSE 'A longer text of ' || s_suppkey END AS overview, CASE WHEN s_suppkey % 4 = 3 THEN '' ELSE 'Courses=' || 1000 + s_suppkey % 1000 || ';Masters=25' END AS badges, CASE WHEN s_suppkey % 4 = 3 THEN NULL WHEN s_suppkey % 3 = 0 THEN false WHEN s_suppkey % 3 = 1 THEN true END AS available, CASE WHEN s_suppkey % 4 = 3 THEN '' ELSE 'Student Life: Clubs' END AS further FROM supplier"""


def ranking_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMP-09, SRC-19, NST-13, NST-15, JON-09: from profiles' markup to their rankings: endpoints, replies (some of which
    failed), histories of tables and lists, current ranks, and the merge."""
    k = F.col("c_custkey")
    s = k.cast("string")
    place = lambda i: F.concat(F.lit(f'<div data-url="\\/qs-profiles\\/rank-data\\/{i}\\/'), s, F.lit('\\/0"></div>'))
    c = table(spark, sf_dir, "customer").select(k.alias("key"), F.concat(place(513), place(4085), place(513), F.when(k % 3 == 0, place(777)).otherwise(F.lit(""))).alias("html"), k.alias("c_custkey"))
    cell = F.format_string("<tr><th>%d</th><td>#%03d</td></tr>", F.year("o_orderdate"), F.col("o_orderkey") % 500)
    tables = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("profile_id")).agg(F.concat(F.lit("<h2>Ranking criteria</h2><table>"), F.array_join(F.array_sort(F.collect_list(cell)), ""), F.lit("</table>")).alias("result")).select(F.lit(513).cast("long").alias("ranking_id"), "profile_id", "result", F.lit("success").alias("status"))
    lists = c.select(F.lit(4085).cast("long").alias("ranking_id"), F.col("key").cast("long").alias("profile_id"), F.concat(F.lit("<ul><li>2020: #"), F.col("key").cast("string"), F.lit("</li><li>2021 rank #="), F.col("key").cast("string"), F.lit('</li><li>2022 was a good year</li></ul><div class="criterion" data-score="7.5">Teaching</div><div class="score-item">Overall: 81.2</div>')).alias("result"), F.lit("success").alias("status"))
    broken = c.where("key % 3 = 0").select(F.lit(777).cast("long").alias("ranking_id"), F.col("key").cast("long").alias("profile_id"), F.lit(None).cast("string").alias("result"), F.lit("failed").alias("status"))
    replies = tables.withColumn("profile_id", F.col("profile_id").cast("long")).unionByName(lists).unionByName(broken)
    got = university.profile_flow(c.select("key", "html"), replies)
    shown = F.transform("rankings", lambda r: F.concat_ws(":", r["ranking_id"].cast("string"), r["year"].cast("string"), r["rank"]))
    rows = got["profiles"].select("key", F.array_join(shown, ",").alias("rankings"), "ranking_count")
    failed = got["failures"].groupBy("key").agg(F.count(F.lit(1)).alias("failed"))
    told = got["criteria"].groupBy("key").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "name", F.col("score").cast("string")))), ",").alias("criteria"), F.max("ranking").alias("ranking"))
    return rows.join(failed, "key", "left").join(told, "key", "left").fillna({"failed": 0})


ranking_flow_sql = """WITH o AS (SELECT o_custkey AS k, year(o_orderdate) AS y, o_orderkey % 500 AS n FROM orders),
a AS (SELECT k, 513 AS id, max(y) AS y, '#' || lpad(CAST(arg_min(n, n - y * 1000) AS VARCHAR), 3, '0') AS r FROM o GROUP BY k),
u AS (SELECT * FROM a UNION ALL SELECT c_custkey, 4085, 2021, '#=' || c_custkey FROM customer),
g AS (SELECT k, string_agg(id || ':' || y || ':' || r, ',' ORDER BY y DESC, id) AS rankings, CAST(count(*) AS INTEGER) AS n FROM u GROUP BY k)
SELECT c_custkey AS key, rankings, n AS ranking_count, CAST(2 - n + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS failed, 'Overall=81.2,Teaching=7.5' AS criteria, 'QS Sustainability Rankings' AS ranking FROM customer JOIN g ON k = c_custkey"""


def page_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NST-07, NST-08, SNK-03: Markdown of pages with every element that has a form in it, in numbered folders by host."""
    k = F.col("s_suppkey").cast("string")
    body = F.concat(F.lit('<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><a href="/x">nav</a></nav><!-- c --><article><h1>Title '), k, F.lit('</h1><p>One <b>two</b> &amp; <a href="/u">three</a>.<br>four  '), k, F.lit("</p><ul><li>first<li>second <i>x</i></li></ul><dl><dt>term<dd>what</dl><h3>Sub</h3><table><thead><tr><th>a</th><th><p>b</p></th></tr></thead><tr><td>1<td>2<br>3</tr><tr><td><table><tr><td>in</td></tr></table></td><td></td></tr></table>after</article><footer>f</footer></body></html>"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("h"), (F.col("s_suppkey") % 3).cast("string")).alias("host"), html.to_markdown(body).alias("markdown"))
    return frontier.page_folders(rows, "host", "s_suppkey").select("s_suppkey", "host", "folder", "markdown", text.words(F.col("markdown")).alias("words"))


page_shapes_sql = """WITH m AS (SELECT s_suppkey, 'h' || s_suppkey % 3 AS host, replace(replace('# Title K~~One two & three.~four K~~- first~- second x~~**term:** what~~### Sub~~| a | b |~| - | - |~| 1 | 2 3 |~| in | |~~after', 'K', CAST(s_suppkey AS VARCHAR)), '~', chr(10)) AS markdown FROM supplier)
SELECT s_suppkey, host, lpad(CAST(row_number() OVER (PARTITION BY host ORDER BY s_suppkey) AS VARCHAR), 4, '0') AS folder, markdown, CAST(20 AS INTEGER) AS words FROM m"""


def markdown_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NST-09: the blocks of Markdown of every kind: both heading forms, a table, fenced code, an HTML table, text."""
    k = F.col("s_suppkey").cast("string")
    body = F.concat(F.lit("Title "), k, F.lit("\n=====\n\npara "), k, F.lit("\nline two\n\n| a | b |\n| - | - |\n```\n# no heading\n```\n## Sub "), k, F.lit(" ##\ntext\n<table><tr><td><table></table></td>\n</tr></table>\nlast\n---\n#nothing"))
    rows = html.blocks(table(spark, sf_dir, "supplier").select("s_suppkey", body.alias("body")), "s_suppkey", "body")
    return rows.select("s_suppkey", "block", "type", "level", "content")


markdown_parsed_sql = """WITH b(block, type, level, a, z) AS (VALUES (0, 'heading', 1, 'Title ', ''), (1, 'text', 0, 'para ', chr(10) || 'line two'), (2, 'table', 0, '| a | b |' || chr(10) || '| - | - |', NULL), (3, 'code', 0, '```' || chr(10) || '# no heading' || chr(10) || '```', NULL), (4, 'heading', 2, 'Sub ', ''), (5, 'text', 0, 'text', NULL), (6, 'table', 0, '<table><tr><td><table></table></td>' || chr(10) || '</tr></table>', NULL), (7, 'heading', 2, 'last', NULL), (8, 'text', 0, '#nothing', NULL))
SELECT s_suppkey, block, type, level, CASE WHEN z IS NULL THEN a ELSE a || s_suppkey || z END AS content FROM supplier CROSS JOIN b"""

NAMES = tuple(n for n in list(globals()) if f"{n}_sql" in globals())
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[f"{n}_sql"] for n in NAMES}
