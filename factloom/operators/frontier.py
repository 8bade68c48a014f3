"""Crawl frontiers: enqueueing by anti-join, level-synchronous expansion, reachability and queue statistics."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import urls
from factloom.operators import links as page_links


def alive(candidates: DataFrame, working: DataFrame, key: str = "url") -> DataFrame:
    """Candidates whose key is in working: a semi-join, whatever repeats working has."""
    return candidates.join(working.select(key), key, "left_semi")


def enqueue(queue: DataFrame, links: DataFrame, max_depth: int = 2) -> DataFrame:
    """New queue rows: internal evidence links of expanding parents below max_depth, whose URL the queue lacks.

    links: parent_url, url, internal, purpose, priority, category, pos. Repeats within the batch keep the first by
    parent and pos. queue: url, depth, expand, status.
    """
    parents = queue.where(F.col("expand") & (F.col("depth") < max_depth)).select(F.col("url").alias("parent_url"), F.col("depth").alias("_depth"))
    found = links.where(F.col("internal") & (F.col("purpose") == "evidence")).join(parents, "parent_url")
    first = found.groupBy("url").agg(F.min_by(F.struct("parent_url", "priority", "category", "_depth"), F.struct("_depth", "parent_url", "pos")).alias("r"))
    new = first.join(queue.select("url"), "url", "left_anti")
    return new.select("url", F.col("r.parent_url").alias("parent"), F.col("r.priority").alias("priority"), F.col("r.category").alias("category"), (F.col("r._depth") + 1).alias("depth"), F.lit(False).alias("expand"), F.lit("pending").alias("status"))


def next_items(queue: DataFrame, partition: str | None = None) -> DataFrame:
    """The pending row to take next: greatest priority, then least depth, then first; one for each partition."""
    pending = queue.where("status = 'pending'")
    order = F.struct((-F.col("priority")).alias("p"), F.col("depth").alias("d"), F.col("pos").alias("o"))
    row = F.min_by(F.struct(*pending.columns), order).alias("r")
    taken = pending.groupBy(*([partition] if partition else [])).agg(row)
    return taken.where("r is not null").select("r.*")


def status_counts(queue: DataFrame, partition: str) -> DataFrame:
    states = ("pending", "completed", "failed")
    return queue.groupBy(partition).agg(*[F.count_if(F.col("status") == s).alias(s) for s in states])


def expand(seeds: DataFrame, edges: DataFrame, max_depth: int | None, cut: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """node and depth of all nodes within max_depth steps of the seeds (node), along edges (src, dst).

    Level by level: each level's nodes are those that the edges reach and that no earlier level holds. The number of
    levels, not of nodes, bounds the driver's loop. cut(df, name) writes a level to a table; beyond two levels it is
    needed, since each level's plan would hold all earlier ones twice. Without max_depth the loop ends with the first
    empty level.
    """
    if cut is None and (max_depth is None or max_depth > 2):
        raise ValueError("pass cut for more than two levels")
    found = seeds.select("node").distinct().withColumn("depth", F.lit(0))
    level = found
    for step in count(1) if max_depth is None else range(1, max_depth + 1):
        reached = edges.join(level.select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).distinct()
        level = reached.join(found.select("node"), "node", "left_anti").withColumn("depth", F.lit(step))
        if cut:
            level = cut(level, f"level-{step}")
        if max_depth is None and level.isEmpty():
            break
        found = found.unionByName(level)
    return found


def site_of(url: Column) -> Column:
    """The host without a leading www."""
    return F.regexp_replace(urls.host(url), r"^www\.", "")


def crawl(seeds: DataFrame, pages: DataFrame, max_depth: int | None = None, cut: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """site, url, page_id, pos, text, programme and follow of all links that crawls of the sites come upon.

    seeds: site, url in normal form. pages: page_id, url, html. A crawl reads the pages that links lead to from its
    seeds, as long as their hosts are the site or below it and their paths hold no skip word; no page is left out for
    number or order. Of a URL's links the first by page and place stands.
    """
    found = page_links.anchors(pages.select("page_id", urls.normalise(F.col("url")).alias("base"), "html"))
    found = found.withColumn("url", urls.normalise(urls.resolve(F.col("base"), F.col("href")))).where(~urls.skipped(F.col("url")))
    labels = F.split(urls.host(F.col("url")), r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = found.select("page_id", "pos", "base", "url", "text", F.explode(above).alias("site")).join(seeds.select("site").distinct(), "site")
    if cut:
        found = cut(found, "links")
    node = lambda url: F.struct("site", F.col(url).alias("url"))
    read = expand(seeds.select(node("url").alias("node")), found.select(node("base").alias("src"), node("url").alias("dst")).distinct(), max_depth, cut)
    seen = found.join(read.select("node.site", F.col("node.url").alias("base")), ["site", "base"], "left_semi")
    first = seen.groupBy("site", "url").agg(F.min_by(F.struct("page_id", "pos", "text"), F.struct("page_id", "pos")).alias("_r")).select("site", "url", "_r.*")
    return first.withColumn("programme", urls.looks_like_programme(F.col("url"), F.col("text"))).withColumn("follow", urls.worth_following(F.col("url"), F.col("text")))


def crawl_host(starts: DataFrame, pages: DataFrame, cut: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """url of all links that a plain crawl of each start's very host comes upon, the starts included: every link on the host
    is followed, whatever its words. starts: url in normal form. pages: page_id, url, html."""
    found = page_links.anchors(pages.select("page_id", urls.normalise(F.col("url")).alias("src"), "html"))
    edges = found.select("src", urls.normalise(urls.resolve(F.col("src"), F.col("href"))).alias("dst")).where(urls.host(F.col("src")) == urls.host(F.col("dst")))
    return expand(starts.select(F.col("url").alias("node")), cut(edges.distinct(), "edges"), None, cut).select(F.col("node").alias("url"))


def reach_sql(edges: str, seeds: str, max_depth: int) -> str:
    """Bounded reachability as a recursive query; for small graphs, since it keeps every path up to the bound."""
    return f"""WITH RECURSIVE walk(node, depth) AS (
  SELECT node, 0 FROM {seeds}
  UNION ALL
  SELECT e.dst, w.depth + 1 FROM walk w JOIN {edges} e ON e.src = w.node WHERE w.depth < {max_depth}
) SELECT node, min(depth) AS depth FROM walk GROUP BY node"""


def page_folders(pages: DataFrame, partition: str, order: str) -> DataFrame:
    """Folder names 0001, 0002, … in order within each partition."""
    number = F.row_number().over(Window.partitionBy(partition).orderBy(order))
    return pages.withColumn("folder", F.lpad(number.cast("string"), 4, "0"))
