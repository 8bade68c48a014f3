"""University profiles: ids, social links, images, campuses, costs, ranking tables and summaries out of markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import numbers, urls
from factloom.functions.expr import any_of, first_case, strip
from factloom.operators.links import plain

#: Parts of image URLs that speak for and against a picture of a university; parameters of images().
IMAGE_PARTS = ["/universities/", "/profiles/", "/campus", "/gallery", "logo"]
IMAGE_BARRED = ["icon", "sprite", "avatar", "placeholder", "flag", "banner-ad", "pixel"]
#: Labels of the user interface that are no campuses; a parameter of campuses().
LABELS = ["campus locations", "view on map", "show more", "show less", "map", "address", "location", "read more", "directions"]


def first_match(html: Column, patterns: list[str]) -> Column:
    """The first group of the first pattern, in order, that matches; else null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in patterns])


def profile_id(html: Column) -> Column:
    return first_match(html, [r'(?i)"core_id"\s*:\s*"?([0-9]+)', r'(?i)data-profile-id="([0-9]+)"', r"/rank-data/[0-9]+/([0-9]+)/"])


def node_id(html: Column) -> Column:
    return first_match(html, [r'(?i)"nid"\s*:\s*"?([0-9]+)', r'(?i)data-history-node-id="([0-9]+)"', r"(?i)/node/([0-9]+)"])


def socials(links: DataFrame, key: str, own: str = "topuniversities") -> DataFrame:
    """key, platform, url: the first link of each platform that is not the site's own."""
    rows = links.withColumn("platform", urls.platform(F.col("url"))).where(F.col("platform").isNotNull() & ~F.lower("url").contains(own))
    return rows.groupBy(key, "platform").agg(F.min_by("url", "pos").alias("url"))


def images(html: Column) -> Column:
    """The distinct image URLs with a part for and none against."""
    found = F.regexp_extract_all(html, F.lit(r'(?i)<img\b[^>]*?\bsrc="([^"]+)"'), F.lit(1))
    return F.array_distinct(F.filter(found, lambda u: any_of(F.lower(u), IMAGE_PARTS) & ~any_of(F.lower(u), IMAGE_BARRED)))


def sections(html: Column) -> Column:
    """array<struct<title, marked, content>> of a profile's headings in order: what stands after each up to the next one,
    of any level, as plain text; marked: whether the heading bears a block's class. Headings without a title are none."""
    parts = F.regexp_extract_all(html, F.lit(r"(?is)(<h[1-6]\b[^>]*>.*?</h[1-6]\s*>(?:(?!<h[1-6]\b).)*+)"), F.lit(1))
    head, inside = r"(?is)^<h[1-6]\b([^>]*)>", r"(?is)^<h[1-6]\b[^>]*>(.*?)</h[1-6]\s*>"
    found = F.transform(parts, lambda p: F.struct(plain(F.regexp_extract(p, inside, 1)).alias("title"), F.regexp_extract(p, head, 1).rlike(r"(?i)univ-block-heading|sec_name").alias("marked"), plain(F.regexp_replace(p, inside, "")).alias("content")))
    return F.filter(F.coalesce(found, F.array().cast("array<struct<title: string, marked: boolean, content: string>>")), lambda s: s["title"] != "")


def overview(found: Column) -> Column:
    """The longest content of the sections whose title begins with the word about; '' without one."""
    about = F.transform(F.filter(found, lambda s: s["title"].rlike(r"(?i)^about\b")), lambda s: F.struct(F.length(s["content"]).alias("n"), s["content"].alias("c")))
    return F.coalesce(F.array_max(about)["c"], F.lit(""))


def extra_sections(found: Column, barred: list[str]) -> Column:
    """The filled sections under marked headings whose title holds none of the barred ones, each title and content once."""
    good = F.filter(found, lambda s: s["marked"] & (s["content"] != "") & ~any_of(F.lower(s["title"]), barred))
    return F.array_distinct(F.transform(good, lambda s: F.struct(s["title"].alias("title"), s["content"].alias("content"))))


def scholarships(found: Column) -> Column:
    """Whether scholarships are available, by their section's text; null without a section or text."""
    text = F.get(F.filter(found, lambda s: s["title"].rlike(r"(?i)^scholarships?$")), F.lit(0))["content"]
    return F.when(F.coalesce(text, F.lit("")) != "", ~text.rlike(r"(?i)\bno scholarships?\b|\bnot available\b|\bnone available\b"))


def badges(html: Column) -> Column:
    """array<struct<label, display, value>> of a profile's badges: the leading number as it is shown and as a number, and
    the badge's title, or, without one, the rest of its text; each label and number once."""
    texts = F.regexp_extract_all(html, F.lit(r'(?is)<div[^>]*class="[^"]*\bsingle-badge\b(?!-)[^"]*"[^>]*>(.*?)</div>'), F.lit(1))

    def one(b: Column) -> Column:
        shown = plain(b)
        number = F.regexp_extract(shown, r"^([0-9][0-9,.]*[0-9]|[0-9])", 1)
        title = plain(F.regexp_extract(b, r'(?is)class="[^"]*single-badge-title[^"]*"[^>]*>(.*?)</', 1))
        label = F.when(title != "", title).otherwise(strip(F.regexp_replace(shown, r"^[0-9][0-9,.]*\+?", "")))
        return F.struct(label.alias("label"), number.alias("display"), F.replace(number, F.lit(","), F.lit("")).try_cast("double").alias("value"))

    return F.array_distinct(F.filter(F.transform(texts, one), lambda b: (b["label"] != "") | (b["display"] != "")))


def campuses(rows: DataFrame, key: str, labels: list[str] | None = None) -> DataFrame:
    """key, name, address, pos: rows with a name or address that is no label; one per lower-case name and address."""
    barred = LABELS if labels is None else labels
    name, address = strip(F.coalesce("name", F.lit(""))), strip(F.coalesce("address", F.lit("")))
    good = rows.where(((name != "") | (address != "")) & ~F.lower(name).isin(barred) & ~F.lower(address).isin(barred))
    return good.groupBy(key, F.lower(name).alias("_n"), F.lower(address).alias("_a")).agg(F.min_by(F.struct("name", "address", "pos"), "pos").alias("r")).select(key, "r.*")


def cost(text: Column) -> Column:
    """struct(display, amount, currency, period) of a cost card's text."""
    return F.struct(text.alias("display"), numbers.loose_float(F.regexp_replace(text, r"^[^0-9]*", "")).alias("amount"), numbers.currency(text).alias("currency"), numbers.period(text).alias("period"))


def table_rows(html: Column) -> Column:
    """array<array<string>>: the cells of all table rows, as plain text."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), F.lit(1)), lambda c: plain(c)))


def history(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, pos, year, rank: rows of tables whose first cell is a year and whose second one holds a number."""
    rows = pages.select(key, F.posexplode(table_rows(F.col(html))).alias("pos", "cells")).where(F.size("cells") >= 2)
    return rows.select(key, "pos", numbers.year(F.col("cells")[0]).alias("year"), F.col("cells")[1].alias("rank")).where("year is not null").where(F.col("rank").rlike("[0-9]"))


def listed_history(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, pos, year, rank of list items and paragraphs whose text is a year and a rank, such as "2024: #=61"."""
    items = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<(?:li|p)\b[^>]*>(.*?)</(?:li|p)\s*>"), F.lit(1))
    rows = pages.select(key, F.posexplode(F.transform(items, lambda x: plain(x))).alias("pos", "t"))
    shape = r"^((?:19|20)[0-9]{2})\s*[:\-–]?\s*(?:rank(?:ed)?\s*)?(#?=?[0-9][0-9+\-–]*)$"
    return rows.where(F.lower("t").rlike(shape)).select(key, "pos", F.regexp_extract(F.lower("t"), shape, 1).cast("int").alias("year"), F.regexp_extract(F.lower("t"), shape, 2).alias("rank"))


def criteria_cards(html: Column) -> Column:
    """array<struct<name, score>> of a reply's criteria: elements of a criterion's class or with a data-score; the score is
    that attribute, else the last number of the text, and the name what else the text says; each once."""
    card = r'(?is)<(?:div|li)\b([^>]*(?:class="[^"]*\b(?:criteria|criterion|indicator|ranking-indicator|score-item)\b[^"]*"|data-score="[^"]*")[^>]*>.*?)</(?:div|li)\s*>'
    found = F.regexp_extract_all(html, F.lit(card), F.lit(1))

    def one(c: Column) -> Column:
        shown = plain(F.concat(F.lit("<x "), c))
        told = F.regexp_extract(F.regexp_extract(c, r"(?s)^[^>]*", 0), r'data-score="([0-9.]+)"', 1)
        said = F.regexp_extract(shown, r"([0-9]+(?:\.[0-9]+)?)\s*$", 1)
        name = strip(F.regexp_replace(shown, r"[:\s]*[0-9]+(?:\.[0-9]+)?\s*$", ""))
        return F.struct(name.alias("name"), F.when(told != "", told).otherwise(said).try_cast("double").alias("score"))

    return F.array_distinct(F.filter(F.transform(found, one), lambda x: (x["name"] != "") | x["score"].isNotNull()))


def points(json_text: Column) -> Column:
    """array<struct<year, rank, rank_numeric>> of a ranking reply's json_data points {x, y, r}; '#' before bare ranks."""
    kind = "array<struct<x: string, y: double, r: string>>"
    got = F.from_json(json_text, kind)
    shown = lambda p: F.when(strip(p["r"]).startswith("#"), strip(p["r"])).otherwise(F.concat(F.lit("#"), strip(p["r"])))
    return F.transform(F.filter(F.coalesce(got, F.array().cast(kind)), lambda p: p["x"].isNotNull()), lambda p: F.struct(numbers.year(p["x"]).alias("year"), shown(p).alias("rank"), p["y"].alias("rank_numeric")))


def ranking_order() -> list[Column]:
    return [F.desc(F.coalesce("year", F.lit(0))), F.asc(F.coalesce("ranking_id", F.lit(0)))]


def numbered(rankings: DataFrame, key: str, order: str) -> DataFrame:
    """Adds place (from 1): each key's rankings in ranking_order, ties by order."""
    return rankings.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*ranking_order(), order)))


def summary(profile: Column) -> Column:
    """Counts of the nested arrays of a merged profile: rankings, history records, criteria."""
    sizes = lambda name: F.aggregate(F.coalesce(F.transform(profile["rankings"], lambda r: F.size(r[name])), F.array().cast("array<int>")), F.lit(0), lambda a, b: a + F.greatest(b, F.lit(0)))
    return F.struct(F.greatest(F.size(profile["rankings"]), F.lit(0)).alias("rankings"), sizes("history").alias("history"), sizes("criteria").alias("criteria"))


def kind_of(url: Column) -> Column:
    """image, logo, social, profile or page."""
    low = F.lower(url)
    return first_case([(low.contains("logo"), F.lit("logo")), (any_of(low, [".jpg", ".jpeg", ".png", ".webp"]), F.lit("image")), (urls.platform(url).isNotNull(), F.lit("social")), (low.contains("/universities/"), F.lit("profile"))], F.lit("page"))
