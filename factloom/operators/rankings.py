"""Ranking histories: endpoints in markup, dedupes, current rank, criteria, and the merge with profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import numbers

# Known rankings by id, and the form of their endpoints.
KNOWN = {513: "QS World University Rankings", 4085: "QS Sustainability Rankings", 4093: "QS Europe University Rankings"}
GENERIC = ["ranking criteria", "rankings", "ranking"]
ENDPOINT = r"/qs-profiles/rank-data/([0-9]+)/([0-9]+)/([0-9]+)"


def endpoints(html: Column) -> Column:
    """array<struct<ranking_id, profile_id, offset>> of the distinct endpoints in a page, escaped slashes undone."""
    bare = F.replace(F.replace(html, F.lit("\\/"), F.lit("/")), F.lit("&amp;"), F.lit("&"))
    part = lambda i: F.transform(F.regexp_extract_all(bare, F.lit(ENDPOINT), F.lit(i)), lambda x: x.cast("bigint"))
    return F.array_distinct(F.arrays_zip(part(1).alias("ranking_id"), part(2).alias("profile_id"), part(3).alias("offset")))


def ranking_name(identity: Column) -> Column:
    out = None
    for key, name in KNOWN.items():
        out = F.when(identity == key, name) if out is None else out.when(identity == key, name)
    return out


def resolved_name(identity: Column, shown: Column) -> Column:
    """A known ranking's name, else the name that its reply shows, unless that is a general one, else one made of the id."""
    title = F.nullif(F.trim(F.coalesce(shown, F.lit(""))), F.lit(""))
    own = F.when(~F.lower(title).isin(GENERIC), title)
    return F.coalesce(ranking_name(identity), own, F.concat(F.lit("QS Ranking "), identity.cast("string")), F.lit("QS Ranking"))


def history(records: DataFrame, keys: list[str]) -> DataFrame:
    """keys, year, rank, score and its parts: rows without a year out, one per (year, rank, score), newest first."""
    rows = records.where("year is not null").groupBy(*keys, "year", "rank", "score").agg(F.min("pos").alias("pos"))
    r = numbers.rank(F.col("rank"))
    return rows.select(*keys, "year", "rank", "score", "pos", *[r[c].alias(c) for c in ("rank_numeric", "rank_min", "rank_max", "is_tied", "is_range")])


def current(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The record of the greatest year, the first of these; without any year, the first."""
    order = F.struct(F.col("year").isNull().alias("n"), (-F.col("year")).alias("y"), "pos")
    return rows.groupBy(*keys).agg(F.min_by(F.struct("year", "rank", "score"), order).alias("r")).select(*keys, "r.*")


def overall(criteria: DataFrame, keys: list[str]) -> DataFrame:
    """The score of the first criterion called overall."""
    hit = F.when(F.lower(F.trim("name")) == "overall", F.col("score"))
    return criteria.groupBy(*keys).agg(F.min_by(hit, F.when(hit.isNotNull(), F.col("pos"))).alias("overall_score"))


def criteria(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per lower-case name and score: the first."""
    return rows.groupBy(*keys, F.lower(F.trim("name")).alias("name"), "score").agg(F.min("pos").alias("pos"))


def merged(profiles: DataFrame, rankings: DataFrame, key: str) -> DataFrame:
    """Profiles with their rankings as an array, ordered by newest year and id; without any, an empty one."""
    rows = rankings.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.coalesce("year", F.lit(0))).alias("sort_year"), F.coalesce("ranking_id", F.lit(0)).alias("ranking_id"), "year", "rank", "score"))).alias("rankings"))
    return profiles.join(rows, key, "left").withColumn("ranking_count", F.coalesce(F.size("rankings"), F.lit(0)))


def problems(rows: DataFrame, errors: dict[str, Column], warnings: dict[str, Column]) -> DataFrame:
    """Adds errors, warnings (arrays of the names whose condition holds) and valid: no errors."""
    named = lambda table: F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in table.items()]))
    return rows.withColumn("errors", named(errors)).withColumn("warnings", named(warnings)).withColumn("valid", F.size("errors") == 0)


STATISTICS = {
    "total_students": r"(?is)total students\s*([0-9,]+)\s*UG students\s*([0-9]+)\s*%\s*PG students\s*([0-9]+)\s*%",
    "international_students": r"(?is)international students\s*([0-9,]+)\s*UG students\s*([0-9]+)\s*%\s*PG students\s*([0-9]+)\s*%",
    "total_faculty": r"(?is)total faculty staff\s*([0-9,]+)\s*domestic staff\s*([0-9]+)\s*%\s*int'?l staff\s*([0-9]+)\s*%",
}


def statistics(text: Column) -> Column:
    """A struct of the three profile statistics, each with display, value and two shares, null where absent."""
    parts = []
    for name, pattern in STATISTICS.items():
        display = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
        parts.append(F.struct(display.alias("display"), numbers.loose_int(display).alias("value"), F.regexp_extract(text, pattern, 2).try_cast("int").alias("first_share"), F.regexp_extract(text, pattern, 3).try_cast("int").alias("second_share")).alias(name))
    return F.struct(*parts)
