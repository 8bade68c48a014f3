"""Queries over records: facts, enrichment, rankings, usage, JSON and tables; each with its SQL.

The reference tables stand in for the engine's records: customers, suppliers and parts unpivoted are facts, orders
give displayed ranks and histories, events are usage records and JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import numbers, text, values
from factloom.operators import chunking, enrichment, facts, layout, rankings, usage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


FIELDS = {"c_name": "identity", "c_nationkey": "admission", "c_mktsegment": "curriculum"}
PART_FIELDS = {"p_name": "identity", "p_brand": "modules", "p_type": "skills_developed", "p_size": "module"}


def eav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-01, SET-02: facts of customers and parts, as one bag."""
    return facts.unpivoted(table(spark, sf_dir, "customer"), "customer", "c_custkey", FIELDS).unionByName(facts.unpivoted(table(spark, sf_dir, "part"), "part", "p_partkey", PART_FIELDS))


def _eav_sql(name: str, entity: str, key: str, fields: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{entity}' AS entity_type, {key} AS entity_id, '{c}' AS category, '{f}' AS field, CAST({f} AS VARCHAR) AS value FROM {name}" for f, c in fields.items())


EAV = f"eav AS ({_eav_sql('customer', 'customer', 'c_custkey', FIELDS)} UNION ALL {_eav_sql('part', 'part', 'p_partkey', PART_FIELDS)})"
_CASE = lambda t, d: "CASE category " + " ".join(f"WHEN '{c}' THEN '{n}'" for n, cs in t.items() for c in cs) + f" ELSE '{d}' END"
GROUP, SECTION = _CASE(facts.GROUPS, "uncategorized"), _CASE(facts.SECTIONS, "unhandled")


def facts_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-14, FLT-07, JON-10, CMP-05: every fact with its validity, group and section."""
    c = F.col("category")
    return eav(spark, sf_dir).select("entity_type", "entity_id", "category", "field", "value", facts.valid(c, F.col("field"), F.col("value")).alias("valid"), facts.group_of(c).alias("fact_group"), facts.section_of(c).alias("section"))


facts_routed_sql = f"WITH {EAV} SELECT *, trim(category) <> '' AND trim(field) <> '' AND value IS NOT NULL AS valid, {GROUP} AS fact_group, {SECTION} AS section FROM eav"


def facts_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-02, DED-03, DED-04, STR-07: the first fact of each category, field and value, and its copies."""
    return facts.dedupe_raw(eav(spark, sf_dir), ["entity_type", "entity_id"]).select("entity_type", "entity_id", "category", "field", "value", "copies")


facts_deduped_sql = f"WITH {EAV} SELECT entity_type, entity_id, category, field, value, count(*) OVER (PARTITION BY category, field, value) AS copies FROM eav QUALIFY row_number() OVER (PARTITION BY category, field, value ORDER BY entity_type, entity_id) = 1"


def documents_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-03, DED-09: documents by a signature of language and text, the first of each with its copies."""
    return facts.dedupe_exact(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), ["doc_id"]).select("doc_id", "copies", values.signature(F.col("lang"), F.col("text")).alias("signature"))


documents_exact_sql = "SELECT min(doc_id) AS doc_id, count(*) AS copies, sha256(lang || chr(31) || text) AS signature FROM documents GROUP BY lang, text"


def facts_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07: the accounting of input, unique, handled, unhandled, written and dropped facts."""
    found = eav(spark, sf_dir)
    return facts.coverage(found, facts.dedupe_raw(found, ["entity_type", "entity_id"]))


facts_coverage_sql = f"""WITH {EAV}, u AS (SELECT DISTINCT category, field, value FROM eav),
n AS (SELECT (SELECT count(*) FROM eav) AS input_facts, count(*) AS unique_facts, count_if({SECTION} <> 'unhandled') AS handled FROM u)
SELECT *, input_facts - unique_facts AS duplicates, unique_facts - handled AS unhandled, unique_facts AS written, 0 AS dropped, 'success' AS status FROM n"""


def section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07, SNK-06: facts by section, with 0 for the others."""
    return facts.section_counts(eav(spark, sf_dir))


section_counts_sql = f"WITH {EAV}, s AS (SELECT {SECTION} AS section, count(*) AS n FROM eav GROUP BY 1) SELECT section, coalesce(n, 0) AS facts FROM (SELECT unnest([{', '.join(f"'{s}'" for s in (*facts.SECTIONS, 'unhandled'))}]) AS section) LEFT JOIN s USING (section)"


def fact_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-06: counts by category, by field and by entity type, as grouping sets."""
    return facts.distributions(eav(spark, sf_dir), ["category", "field", "entity_type"])


fact_distributions_sql = f"WITH {EAV} " + " UNION ALL ".join(f"SELECT '{c}' AS dimension, {c} AS name, count(*) AS n FROM eav GROUP BY {c}" for c in ("category", "field", "entity_type"))


def name_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-14, NST-05: the preferred name of each entity: identity before modules, names before brands."""
    return facts.pick(eav(spark, sf_dir), ["entity_type", "entity_id"], ["identity", "modules"], ["p_brand", "p_name", "c_name"], "value")


name_pick_sql = f"WITH {EAV} SELECT entity_type, entity_id, arg_min(value, (CASE category WHEN 'identity' THEN 0 ELSE 1 END) * 10 + CASE field WHEN 'p_brand' THEN 0 WHEN 'p_name' THEN 1 ELSE 2 END) AS picked FROM eav WHERE category IN ('identity', 'modules') AND field IN ('p_brand', 'p_name', 'c_name') AND trim(value) <> '' GROUP BY entity_type, entity_id"


def fact_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMP-02, ORD-08: a nation's customer facts packed by group, 30 facts or 800 characters at most in one chunk."""
    c = table(spark, sf_dir, "customer")
    found = facts.unpivoted(c, "customer", "c_custkey", FIELDS).join(c.select(F.col("c_custkey").alias("entity_id"), "c_nationkey"), "entity_id")
    found = found.withColumn("fact_group", facts.group_of(F.col("category"))).select("c_nationkey", "fact_group", "entity_id", "value")
    packed = chunking.fact_packs(found, ["c_nationkey", "fact_group"], "entity_id", F.length("value"), 30, 800)
    return packed.groupBy("c_nationkey", "fact_group", "chunk").agg(F.count(F.lit(1)).alias("facts"), F.sum(F.length("value")).cast("long").alias("characters"))


fact_packs_sql = f"""
WITH RECURSIVE f AS (SELECT c_nationkey, {GROUP} AS fact_group, c_custkey, length(value) AS size, row_number() OVER (PARTITION BY c_nationkey, category ORDER BY c_custkey) AS pos FROM (
 {" UNION ALL ".join(f"SELECT c_nationkey, c_custkey, '{c}' AS category, CAST({f} AS VARCHAR) AS value FROM customer" for f, c in FIELDS.items())})),
p(c_nationkey, fact_group, pos, chunk, n, chars, size) AS (
 SELECT c_nationkey, fact_group, pos, 0, 1, size, size FROM f WHERE pos = 1
 UNION ALL
 SELECT f.c_nationkey, f.fact_group, f.pos, CASE WHEN p.n >= 30 OR p.chars + f.size > 800 THEN p.chunk + 1 ELSE p.chunk END, CASE WHEN p.n >= 30 OR p.chars + f.size > 800 THEN 1 ELSE p.n + 1 END, CASE WHEN p.n >= 30 OR p.chars + f.size > 800 THEN f.size ELSE p.chars + f.size END, f.size
 FROM p JOIN f ON f.c_nationkey = p.c_nationkey AND f.fact_group = p.fact_group AND f.pos = p.pos + 1)
SELECT c_nationkey, fact_group, CAST(chunk AS INTEGER) AS chunk, count(*) AS facts, CAST(sum(size) AS BIGINT) AS characters FROM p GROUP BY c_nationkey, fact_group, chunk"""


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-11: a nation's customers in batches of 20."""
    return chunking.batches(table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey"), ["c_nationkey"], "c_custkey")


batches_sql = "SELECT c_nationkey, c_custkey, CAST(floor((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) / 20) AS INTEGER) AS batch FROM customer"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Web and PDF facts of the same customers, in two programmes whose facts share names: the PDF side lacks some, renames
    or reorders some names and changes some values; some facts have neither id nor name."""
    k = F.col("c_custkey")
    name = F.when(k % 17 != 0, F.concat(F.lit("Client Number "), F.floor(k / 2).cast("string")))
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("p"), (k % 2).cast("string")).alias("key"), k.alias("pos"), F.lit("customer").alias("type"), name.alias("name"), F.col("c_nationkey").cast("string").alias("parent_id"), F.col("c_mktsegment").alias("parent_name"), F.lit("segment").alias("field"), F.col("c_mktsegment").alias("value"), k.alias("k"))
    k = F.col("k")
    named = k % 17 != 0
    web = c.select("key", "pos", "type", F.when(named & (k % 3 != 0), k.cast("string")).alias("id"), "name", "parent_id", "parent_name", "field", F.when(k % 11 == 0, F.lit("")).otherwise(F.col("value")).alias("value"))
    changed = F.when(k % 7 == 0, F.concat(F.col("value"), F.lit(" and household goods"))).when(k % 7 == 1, F.lit("OTHER")).otherwise(F.lower("value"))
    other = F.when(k % 13 == 0, F.lit("Somebody Else")).when(k % 15 == 0, F.concat(F.floor(k / 2).cast("string"), F.lit(" number, client"))).otherwise(F.col("name"))
    pdf = c.where("k % 4 <> 0").select("key", (F.col("pos") + 1_000_000).alias("pos"), "type", F.when(named, F.when(k % 5 == 0, F.concat(F.lit("n"), k.cast("string"))).otherwise(k.cast("string"))).alias("id"), F.when(named, other).alias("name"), "parent_id", "parent_name", "field", changed.alias("value"))
    return web, pdf


def enrich_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-04, JON-05, JON-06: the web fact that each PDF fact matches, its score and how."""
    return enrichment.matches(*_sides(spark, sf_dir)).select("key", "pdf_pos", "web_pos", F.round("score", 6).alias("score"), "how")


_TOK = lambda x: f"list_distinct(regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}_]+'))"
_SIM = "(0.45 * (c / (n + m - c)) + 0.4 * (c / least(n, m)) + 0.15 * (least(n, m) / greatest(n, m)))"
SIDES = """web AS (SELECT 'p' || c_custkey % 2 AS key, c_custkey AS pos, CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 3 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS id, CASE WHEN c_custkey % 17 <> 0 THEN 'Client Number ' || c_custkey // 2 END AS name, CAST(c_nationkey AS VARCHAR) AS parent_id, c_mktsegment AS parent_name, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS value FROM customer),
pdf AS (SELECT 'p' || c_custkey % 2 AS key, c_custkey + 1000000 AS pos, CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 'n' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS id,
 CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'Somebody Else' WHEN c_custkey % 15 = 0 THEN c_custkey // 2 || ' number, client' ELSE 'Client Number ' || c_custkey // 2 END AS name, CAST(c_nationkey AS VARCHAR) AS parent_id, c_mktsegment AS parent_name,
 CASE c_custkey % 7 WHEN 0 THEN c_mktsegment || ' and household goods' WHEN 1 THEN 'OTHER' ELSE lower(c_mktsegment) END AS value FROM customer WHERE c_custkey % 4 <> 0)"""
MATCH = f"""{SIDES},
met AS (SELECT w.pos AS w, p.pos AS p FROM web w JOIN pdf p ON w.key = p.key AND w.id = p.id UNION SELECT w.pos, p.pos FROM web w JOIN pdf p ON w.key = p.key AND lower(w.name) = lower(p.name)
 UNION SELECT w.pos, p.pos FROM web w JOIN pdf p ON w.key = p.key AND w.parent_id = p.parent_id WHERE coalesce(w.id, w.name, p.id, p.name) IS NULL),
pairs AS (SELECT m.w, m.p, w.id AS wid, p.id AS pid, w.name AS wn, p.name AS pn, w.parent_id = p.parent_id AS pi, w.parent_name = p.parent_name AS pp, {_TOK('w.name')} AS a, {_TOK('p.name')} AS b FROM met m JOIN web w ON w.pos = m.w JOIN pdf p ON p.pos = m.p),
sized AS (SELECT *, len(list_intersect(a, b)) AS c, len(a) AS n, len(b) AS m FROM pairs),
scored AS (SELECT p AS pdf_pos, w AS web_pos, 60.0 + CASE WHEN wid = pid THEN 35 WHEN wid IS NOT NULL AND pid IS NOT NULL THEN -35 ELSE 0 END + CASE WHEN wn IS NULL OR pn IS NULL THEN 0 WHEN lower(wn) = lower(pn) THEN 25.0 ELSE 20 * {_SIM} END + CASE WHEN pi THEN 10 ELSE 0 END + CASE WHEN pp THEN 5 ELSE 0 END AS score FROM sized),
exact AS (SELECT * FROM scored WHERE score >= 70 QUALIFY row_number() OVER (PARTITION BY pdf_pos ORDER BY score DESC, web_pos) = 1),
wt AS (SELECT key, pos, name, {_TOK('name')} AS t FROM web), pt AS (SELECT key, pos, name, {_TOK('name')} AS t FROM pdf WHERE pos NOT IN (SELECT pdf_pos FROM exact)),
wx AS (SELECT key, pos, t, unnest(t) AS x FROM wt), px AS (SELECT key, pos, t, unnest(t) AS x FROM pt WHERE len(t) > 0),
near AS (SELECT px.pos AS pdf_pos, wx.pos AS web_pos, any_value(len(list_intersect(wx.t, px.t))) AS c, any_value(len(wx.t)) AS n, any_value(len(px.t)) AS m FROM px JOIN wx USING (key, x) GROUP BY 1, 2),
fuzzy AS (SELECT pdf_pos, web_pos, 70 + 20 * {_SIM} AS score FROM near WHERE {_SIM} >= 0.92 QUALIFY row_number() OVER (PARTITION BY pdf_pos ORDER BY {_SIM} DESC, web_pos) = 1),
found AS (SELECT *, 'exact' AS how FROM exact UNION ALL SELECT *, 'fuzzy' FROM fuzzy)"""
enrich_match_sql = f"WITH {MATCH} SELECT w.key, pdf_pos, web_pos, round(score, 6) AS score, how FROM found JOIN web w ON w.pos = web_pos"


def enrich_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CMP-06, CMP-07, AGG-15, DED-05: every fact after enrichment, with status, sources and conflicts."""
    rows = enrichment.enrich(*_sides(spark, sf_dir))
    return rows.select("key", "pos", "origin", "value", "status", F.array_join(F.transform("supporting", lambda x: x.cast("string")), ",").alias("supporting"), F.array_join("conflicts", ",").alias("conflicts"))


enrich_merge_sql = f"""WITH {MATCH},
v AS (SELECT f.pdf_pos, f.web_pos, w.value AS web_value, p.value AS pdf_value, lower(w.value) AS a, lower(p.value) AS b FROM found f JOIN web w ON w.pos = f.web_pos JOIN pdf p ON p.pos = f.pdf_pos),
d AS (SELECT *, CASE WHEN a = b THEN 'confirmed' WHEN trim(a) = '' THEN 'filled' WHEN contains(b, a) AND length(b) > 1.15 * length(a) THEN 'richer' WHEN length(a) >= 4 AND length(b) >= 4 AND (contains(a, b) OR contains(b, a)) THEN 'compatible' ELSE 'conflict' END AS decision FROM v),
s AS (SELECT web_pos, max(CASE WHEN decision = 'conflict' THEN 3 WHEN decision IN ('filled', 'richer') THEN 2 ELSE 1 END) AS strength, arg_min(pdf_value, pdf_pos) FILTER (decision IN ('filled', 'richer')) AS new_value, string_agg(CAST(pdf_pos AS VARCHAR), ',' ORDER BY pdf_pos) AS supporting, string_agg(DISTINCT pdf_value, ',' ORDER BY pdf_value) FILTER (decision = 'conflict') AS conflicts FROM d GROUP BY web_pos)
SELECT w.key, w.pos, 'web' AS origin, coalesce(s.new_value, w.value) AS value, ['original', 'confirmed', 'enriched', 'conflict'][coalesce(s.strength, 0) + 1] AS status, coalesce(s.supporting, '') AS supporting, coalesce(s.conflicts, '') AS conflicts FROM web w LEFT JOIN s ON s.web_pos = w.pos
UNION ALL SELECT key, pos, 'pdf', value, 'added_from_pdf', CAST(pos AS VARCHAR), '' FROM pdf WHERE pos NOT IN (SELECT pdf_pos FROM found)"""


def _ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Displayed ranks of customers: orders give the year, the rank and its form (single, tied, range, open)."""
    o = table(spark, sf_dir, "orders")
    n = (F.col("o_orderkey") % 500 + 1).cast("string")
    shown = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("#="), n)).when(F.col("o_orderkey") % 4 == 1, F.concat(n, F.lit("-"), (F.col("o_orderkey") % 500 + 50).cast("string"))).when(F.col("o_orderkey") % 4 == 2, F.concat(n, F.lit("+"))).otherwise(n)
    return o.select(F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("year"), shown.alias("rank"), F.round(F.col("o_totalprice") / 1000, 1).alias("score"), F.col("o_orderkey").alias("pos"))


RANKS = """ranks AS (SELECT o_custkey AS key, CAST(year(o_orderdate) AS INTEGER) AS year, CASE o_orderkey % 4 WHEN 0 THEN '#=' || (o_orderkey % 500 + 1) WHEN 1 THEN (o_orderkey % 500 + 1) || '-' || (o_orderkey % 500 + 50) WHEN 2 THEN (o_orderkey % 500 + 1) || '+' ELSE CAST(o_orderkey % 500 + 1 AS VARCHAR) END AS rank, round(o_totalprice / 1000, 1) AS score, o_orderkey AS pos FROM orders)"""


def rank_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NUM-03, NUM-04, DED-06: parsed ranks, one for each year, rank and score."""
    return rankings.history(_ranks(spark, sf_dir), ["key"]).drop("score")


rank_history_sql = f"""WITH {RANKS}, d AS (SELECT key, year, rank, score, min(pos) AS pos FROM ranks GROUP BY key, year, rank, score),
n AS (SELECT *, regexp_extract_all(rank, '[0-9]+') AS ns FROM d), r AS (SELECT *, contains(rank, '-') AND len(ns) >= 2 AS is_range FROM n)
SELECT key, year, rank, pos, CASE WHEN NOT is_range THEN CAST(ns[1] AS INTEGER) END AS rank_numeric, CAST(ns[1] AS INTEGER) AS rank_min, CAST(CASE WHEN is_range THEN ns[2] ELSE ns[1] END AS INTEGER) AS rank_max, contains(rank, '=') AS is_tied, is_range FROM r"""


def rank_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-11, AGG-12, ORD-06: the record of each key's newest year, and the sort key of its rank."""
    return rankings.current(_ranks(spark, sf_dir), ["key"]).drop("score")


rank_current_sql = f"WITH {RANKS} SELECT key, year, rank FROM ranks QUALIFY row_number() OVER (PARTITION BY key ORDER BY year DESC, pos) = 1"


def profile_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON-09, CMP-09, FLT-15: customers as profiles with their rankings, and the output's validation."""
    ranked = _ranks(spark, sf_dir).select("key", F.lit(513).alias("ranking_id"), "year", "rank", "score")
    rows = rankings.merged(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name"), ranked, "key")
    checked = rankings.problems(rows, {"missing name": F.coalesce(F.trim("c_name") == "", F.lit(True))}, {"no rankings": F.col("ranking_count") == 0})
    return checked.select("key", "c_name", "ranking_count", F.size("errors").alias("errors"), F.array_join("warnings", ",").alias("warnings"), "valid", F.lit(rankings.KNOWN[513]).alias("ranking_name"))


profile_merge_sql = f"SELECT c_custkey AS key, c_name, CAST(count(o_orderkey) AS INTEGER) AS ranking_count, 0 AS errors, CASE WHEN count(o_orderkey) = 0 THEN 'no rankings' ELSE '' END AS warnings, true AS valid, '{rankings.KNOWN[513]}' AS ranking_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name"


def endpoint_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NST-13, DED-08: the distinct ranking endpoints in markup, here written around each order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.format_string('<div data-url="\\/qs-profiles\\/rank-data\\/%d\\/%d\\/0"></div><a href="/qs-profiles/rank-data/%d/%d/0?x=1&amp;y">', F.lit(513), "o_custkey", F.lit(513), "o_custkey").alias("html"))
    return o.select("o_orderkey", F.explode(rankings.endpoints(F.col("html"))).alias("e")).select("o_orderkey", "e.*")


endpoint_scan_sql = "SELECT o_orderkey, 513::BIGINT AS ranking_id, o_custkey AS profile_id, 0::BIGINT AS \"offset\" FROM orders"


def number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NUM-01, NUM-02, NUM-05, NUM-06, NUM-08: units, loose numbers, years, money and confidences of made texts."""
    p = table(spark, sf_dir, "part")
    units = F.get(F.array(*map(F.lit, ("ECTS", "credits", "hours", "semester"))), (F.col("p_partkey") % 4).cast("int"))
    t = p.select("p_partkey", F.concat_ws(" ", F.regexp_replace((F.col("p_size") / 2).cast("string"), r"\.", ","), units).alias("size"), F.concat(F.lit("€"), F.format_string("%,d", (F.col("p_partkey") * 1000).cast("long")), F.lit(" per year since "), (F.col("p_partkey") % 50 + 1980).cast("string")).alias("cost"))
    s, c = F.col("size"), F.col("cost")
    return t.select("p_partkey", numbers.unit_number(s).alias("number"), numbers.unit(s).alias("unit"), numbers.loose_int(c).alias("amount"), numbers.year(c).alias("year"), numbers.currency(c).alias("currency"), numbers.period(c).alias("period"), numbers.confidence(F.regexp_replace(s, "[^0-9,]", "")).alias("confidence"))


number_parse_sql = """SELECT p_partkey, p_size / 2 AS number, ['ects', 'credits', 'hours', 'semester'][p_partkey % 4 + 1] AS unit, p_partkey * 1000 AS amount, CAST(p_partkey % 50 + 1980 AS INTEGER) AS year, 'EUR' AS currency, 'year' AS period, 0.95::DOUBLE AS confidence FROM part"""


def usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-05, NUM-07: calls, tokens and cost by stage and in all, of events taken as usage records."""
    models = F.get(F.array(*map(F.lit, [*usage.PRICES][:3] + ["unknown"])), (F.col("user_id") % 4).cast("int"))
    return usage.summary(table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), models.alias("model"), (F.col("event_id") % 5000).alias("prompt_tokens"), (F.col("event_id") % 700).alias("completion_tokens")))


_PRICE = lambda i: "CASE user_id % 4 " + " ".join(f"WHEN {k} THEN {round(p[i] * 1000)}" for k, p in enumerate([*usage.PRICES.values()][:3])) + " ELSE 0 END"
usage_summary_sql = f"""WITH r AS (SELECT event_type AS stage, event_id % 5000 AS p, event_id % 700 AS c, event_id % 5000 * {_PRICE(0)} + event_id % 700 * {_PRICE(1)} AS m FROM events)
SELECT stage, count(*) AS calls, CAST(sum(p) AS BIGINT) AS prompt_tokens, CAST(sum(c) AS BIGINT) AS completion_tokens, CAST(sum(p + c) AS BIGINT) AS total_tokens, CAST(sum(m) AS BIGINT) AS nano_dollars FROM r GROUP BY ROLLUP (stage)"""


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04, AGG-18: events by user as a queue: pending, completed and failed."""
    rows = table(spark, sf_dir, "events").withColumn("status", F.when(F.col("event_id") % 7 == 0, "failed").when(F.col("event_id") % 3 == 0, "pending").otherwise("completed"))
    from factloom.operators.frontier import status_counts as counts

    return counts(rows, "user_id")


status_counts_sql = "SELECT user_id, count_if(event_id % 7 <> 0 AND event_id % 3 = 0) AS pending, count_if(event_id % 7 <> 0 AND event_id % 3 <> 0) AS completed, count_if(event_id % 7 = 0) AS failed FROM events GROUP BY user_id"


def next_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-04: each user's next event: greatest priority, least depth, first."""
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("pos"), (F.col("event_id") % 10).alias("priority"), (F.col("event_id") % 3).alias("depth"), F.when(F.col("event_id") % 2 == 0, "pending").otherwise("completed").alias("status"))
    from factloom.operators.frontier import next_items as take

    return take(rows, "user_id").select("user_id", "pos", "priority", "depth")


next_items_sql = "SELECT user_id, event_id AS pos, event_id % 10 AS priority, event_id % 3 AS depth FROM events WHERE event_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 10 DESC, event_id % 3, event_id) = 1"


def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NST-02, NST-04, NST-05, STR-07: values at paths of the events' JSON, and its canonical form's emptiness."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    return e.select("event_id", F.size(F.json_object_keys("props")).alias("keys"), values.is_empty(F.col("props")).alias("empty"), values.first_value(F.get_json_object("props", "$.missing"), F.col("event_type")).alias("first"))


json_values_sql = "SELECT event_id, CAST(len(json_keys(props)) AS INTEGER) AS keys, trim(props) IN ('', 'null', '[]', '{}') AS empty, event_type AS first FROM events"


def value_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-03, CMP-07, DED-10: how the word sets of a part's name and type relate, and whether names are richer."""
    p = table(spark, sf_dir, "part")
    a, b = text.tokens(F.col("p_name")), text.tokens(F.col("p_type"))
    n = {c: values.normal(F.col(c)).alias(f"n_{c}") for c in ("p_name", "p_type", "p_brand")}
    p = p.select("p_partkey", a.alias("a"), b.alias("b"), *n.values(), values.normal(F.concat_ws(" ", "p_brand", "p_type")).alias("both"))
    return p.select("p_partkey", values.list_relation(F.col("a"), F.col("b")).alias("relation"), values.richer(F.col("n_p_brand"), F.col("both")).alias("richer"), values.compatible(F.col("n_p_type"), F.col("n_p_name")).alias("compatible"), F.size(values.append_unique(F.col("a"), F.lit("steel"))).alias("appended"))


value_relations_sql = f"""WITH t AS (SELECT p_partkey, {_TOK('p_name')} AS a, {_TOK('p_type')} AS b, lower(p_name) AS n, lower(p_type) AS t, lower(p_brand) AS br FROM part),
r AS (SELECT *, len(list_filter(a, lambda x: NOT list_contains(b, x))) AS oa, len(list_filter(b, lambda x: NOT list_contains(a, x))) AS ob FROM t)
SELECT p_partkey, CASE WHEN oa = 0 AND ob = 0 THEN 'equal' WHEN oa = 0 THEN 'subset' WHEN ob = 0 THEN 'superset' WHEN oa < len(a) THEN 'overlap' ELSE 'disjoint' END AS relation, length(br || ' ' || t) > 1.15 * length(br) AS richer, length(t) >= 4 AND length(n) >= 4 AND (contains(t, n) OR contains(n, t)) AS compatible, CAST(len(a) + CASE WHEN list_contains(a, 'steel') THEN 0 ELSE 1 END AS INTEGER) AS appended FROM r"""


def cell_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-17: each order's items as a matrix of line number by two columns."""
    cells = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("r"), F.explode(F.array(F.struct(F.lit(0).alias("c"), F.col("l_returnflag").alias("v")), F.struct(F.lit(1).alias("c"), F.col("l_linestatus").alias("v")))).alias("x"), "l_partkey")
    m = layout.matrix(cells.select("l_orderkey", "r", "x.c", "x.v", F.struct("l_partkey", "x.v").alias("o")), ["l_orderkey"], "r", "c", "v", "o")
    return m.select("l_orderkey", "row_count", "column_count", F.array_join(F.transform("matrix", lambda r: F.array_join(r, "|")), "/").alias("matrix"))


cell_matrix_sql = """WITH c AS (SELECT l_orderkey, l_linenumber - 1 AS r, 0 AS c, arg_max(l_returnflag, {'p': l_partkey, 'v': l_returnflag}) AS v FROM lineitem GROUP BY 1, 2 UNION ALL SELECT l_orderkey, l_linenumber - 1, 1, arg_max(l_linestatus, {'p': l_partkey, 'v': l_linestatus}) FROM lineitem GROUP BY 1, 2),
n AS (SELECT l_orderkey, max(l_linenumber) AS k FROM lineitem GROUP BY 1), g AS (SELECT l_orderkey, k, unnest(range(k)) AS r FROM n),
rows AS (SELECT g.l_orderkey, g.k, g.r, coalesce(max(v) FILTER (c.c = 0), '') || '|' || coalesce(max(v) FILTER (c.c = 1), '') AS t FROM g LEFT JOIN c ON c.l_orderkey = g.l_orderkey AND c.r = g.r GROUP BY 1, 2, 3)
SELECT l_orderkey, CAST(any_value(k) AS INTEGER) AS row_count, 2 AS column_count, string_agg(t, '/' ORDER BY r) AS matrix FROM rows GROUP BY l_orderkey"""

NAMES = ("facts_routed", "facts_deduped", "documents_exact", "facts_coverage", "section_counts", "fact_distributions", "name_pick", "fact_packs", "batches", "enrich_match", "enrich_merge", "rank_history", "rank_current", "profile_merge", "endpoint_scan", "number_parse", "usage_summary", "status_counts", "next_items", "json_values", "value_relations", "cell_matrix")
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[f"{n}_sql"] for n in NAMES if f"{n}_sql" in globals()}
