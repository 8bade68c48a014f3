"""Facts of layout documents: preparation, the correction chain, whitelists, dedupe and ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import numbers, text, values
from factloom.functions.expr import blank_to_null, first_case, lookup, strip

# Categories, grading words, the form of codes, credit fields by entity, and the default entity types.
CATEGORIES = ["identity", "overview", "qualification", "program", "requirement", "academic_structure", "curriculum", "module", "course", "module_component", "credits", "workload", "teaching", "assessment", "learning_outcomes", "admission", "eligibility", "application", "language", "duration", "study_mode", "attendance", "schedule", "semester", "academic_calendar", "fees", "funding", "scholarship", "career", "accreditation", "regulation", "progression", "graduation", "thesis", "dissertation", "project", "internship", "placement", "exchange", "contact", "campus", "facilities", "student_support", "other"]
GRADING = ["graded", "ungraded", "pass/fail", "benotet", "unbenotet", "bestanden/nicht bestanden"]
CODE = r"(?i)^[A-Za-zÄÖÜäöü]{0,8}(?:[- ]?[A-Za-z]{0,4})?[- ]?[0-9]+(?:[.\-][0-9]+)*[A-Za-z]?$"
FIELD_CODE = r"(?i)\b((?:wp|p|m|mod|module|course)_?[0-9]+(?:_[0-9]+)*)\b"
CREDITS = {"program": "total_credits", "programme": "total_credits", "module": "module_credits", "course": "course_credits", "module_component": "component_credits", "component": "component_credits"}
NAMES = {"program": "program_name", "programme": "program_name", "course": "course_name", "module": "module_name", "module_component": "module_name", "component": "module_name"}
ENTITY_TYPES = {"module": "module", "course": "course", "module_component": "module_component"}

ENTITY = "struct<type: string, id: string, name: string>"


def category(value: Column) -> Column:
    """A known category's key, else other."""
    key = text.snake(value)
    return F.when(key.isin(CATEGORIES), key).otherwise(F.lit("other"))


def entity_type(category_: Column) -> Column:
    return lookup(category_, ENTITY_TYPES, F.lit("program"))


def is_code(value: Column) -> Column:
    """A short identifier such as P 5 or WP 1.2: at most 30 characters and 4 words."""
    bare = strip(value)
    return F.coalesce((F.length(bare) <= 30) & (F.size(F.split(bare, r"\s+")) <= 4) & bare.rlike(CODE), F.lit(False))


def field_code(field: Column) -> Column:
    """The code in a field name, as P 5.1, else null."""
    found = F.upper(F.replace(F.nullif(F.regexp_extract(field, FIELD_CODE, 1), F.lit("")), F.lit("_"), F.lit(".")))
    return F.regexp_replace(found, r"^(WP|P|MOD|MODULE|M|COURSE)\.", "$1 ")


def prepared(raw: DataFrame) -> DataFrame:
    """Raw facts with keys normalised and gaps filled: a value from its original and the reverse, entity and qualifiers.

    raw: category, field, value, original_value, unit, confidence, entity (struct), qualifiers (map); other columns stay.
    Facts whose value is empty go.
    """
    c = category(F.col("category"))
    one = raw.withColumns({"category": c, "field": text.snake(F.col("field")), "value": values.first_value(F.col("value"), F.col("original_value")), "original_value": values.first_value(F.col("original_value"), F.col("value"))})
    e = F.struct(F.coalesce(blank_to_null(text.snake(F.col("entity.type"))), entity_type(F.col("category"))).alias("type"), blank_to_null(F.col("entity.id")).alias("id"), blank_to_null(F.col("entity.name")).alias("name"))
    return one.where(F.col("value").isNotNull()).withColumns({"entity": e, "qualifiers": F.coalesce("qualifiers", F.expr("cast(map() as map<string,string>)")), "confidence": numbers.confidence(F.col("confidence"))})


def _credit_field(facts: DataFrame) -> DataFrame:
    kind = F.lower(F.coalesce("entity.type", F.lit("")))
    return facts.withColumn("field", F.when(F.col("field") == "credits", lookup(kind, CREDITS, F.lit("credits"))).otherwise(F.col("field")))


def _translated(facts: DataFrame) -> DataFrame:
    return facts.withColumn("value", text.translate(F.col("value")))


def _dynamic_field(facts: DataFrame) -> DataFrame:
    """Semesters and codes out of field names, and stable names for titles, credits and formats."""
    f, kind = F.col("field"), F.lower(F.coalesce("entity.type", F.lit("")))
    semester = F.nullif(F.regexp_extract(f, r"(?i)(?:semester|sem)_?([0-9]+)", 1), F.lit(""))
    facts = facts.withColumns({"_code": field_code(f), "_semester": semester})
    coursy = f.contains("course") | F.coalesce(F.col("_code").contains("."), F.lit(False))
    titled = F.when(kind == "", F.lit(None)).otherwise(lookup(kind, NAMES, F.lit(None).cast("string")))
    credited = lookup(kind, CREDITS, F.lit(None).cast("string"))
    field = first_case(
        [
            (f.rlike("_(title|name)$"), F.when(f.isin("program_name", "module_name", "course_name"), f).otherwise(F.coalesce(titled, F.when(coursy, F.lit("course_name")), f))),
            (f.rlike("_(ects|credits|credit)$"), F.when(f.isin("total_credits", "module_credits", "course_credits", "component_credits"), f).otherwise(F.coalesce(credited, F.when(coursy, F.lit("course_credits")), f))),
            (f.rlike("_(format|teaching_form)$"), F.lit("teaching_format")),
        ],
        f,
    )
    numbered = F.when(F.col("_semester").isNotNull() & ~F.map_contains_key("qualifiers", F.lit("semester")), F.map_concat("qualifiers", F.create_map(F.lit("semester"), F.col("_semester")))).otherwise(F.col("qualifiers"))
    e = F.struct(F.coalesce("entity.type", F.when(f.rlike("_(title|name)$") & coursy & (field == "course_name"), F.lit("course"))).alias("type"), F.coalesce("entity.id", "_code").alias("id"), F.col("entity.name").alias("name"))
    return facts.withColumns({"_field": field, "_qualifiers": numbered, "_entity": e}).withColumns({"field": F.col("_field"), "qualifiers": F.col("_qualifiers"), "entity": F.col("_entity")}).drop("_code", "_semester", "_field", "_qualifiers", "_entity")


def _grading(facts: DataFrame) -> DataFrame:
    graded = F.col("field").isin("assessment", "assessment_type", "examination") & (F.lower(strip(F.col("value"))).isin(GRADING) | F.coalesce(F.lower(strip(F.col("original_value"))).isin(GRADING), F.lit(False)))
    return facts.withColumn("_g", graded).withColumns({"category": F.when(F.col("_g"), F.lit("assessment")).otherwise(F.col("category")), "field": F.when(F.col("_g"), F.lit("grading_status")).otherwise(F.col("field"))}).drop("_g")


def _identity(facts: DataFrame) -> DataFrame:
    fixed = {"module_name": "module_code", "course_name": "course_code"}
    return facts.withColumn("field", F.when(is_code(F.col("value")), lookup(F.col("field"), fixed, F.col("field"))).otherwise(F.col("field")))


def _synchronised(facts: DataFrame) -> DataFrame:
    v = blank_to_null(strip(F.col("value")))
    new_id = F.coalesce("entity.id", F.when(F.col("field").isin("module_code", "course_code"), v))
    name = F.coalesce("entity.name", F.when(F.col("field").isin("module_name", "course_name"), v))
    return facts.withColumn("entity", F.struct(F.col("entity.type").alias("type"), new_id.alias("id"), name.alias("name")))


CHAIN = (_credit_field, _translated, _dynamic_field, _grading, _identity, _synchronised)


def corrected(facts: DataFrame) -> DataFrame:
    """Prepared facts through the chain: credits by entity, translation, dynamic fields, grading, codes, identities."""
    return reduce(lambda df, step: step(df), CHAIN, facts)


def unique(facts: DataFrame, order: str) -> DataFrame:
    """The first fact of each meaning (all but source and confidence), with the number of copies."""
    e, q = F.to_json("entity"), F.to_json(F.map_from_entries(F.array_sort(F.map_entries("qualifiers"))))
    key = values.signature(F.col("category"), F.col("field"), F.col("value"), F.col("original_value"), F.col("unit"), e, q)
    best = facts.withColumn("_key", key).groupBy("_key").agg(F.min_by(F.struct(*facts.columns), F.col(order)).alias("r"), F.count(F.lit(1)).alias("copies"))
    return best.select("r.*", "copies")


def identified(facts: DataFrame, document: str, order: str) -> DataFrame:
    """Adds fact_id: pdf_<document>_<number in order>_<12 digits of the meaning's hash>."""
    number = F.row_number().over(Window.partitionBy(document).orderBy(order))
    short = F.substring(values.signature(F.col("category"), F.col("field"), F.col("value"), F.to_json("entity")), 1, 12)
    return facts.withColumn("fact_id", F.concat_ws("_", F.lit("pdf"), text.snake(F.col(document).cast("string")), F.format_string("%04d", number), short))


def summary(calls: DataFrame, found: DataFrame, kept: DataFrame, document: str) -> DataFrame:
    """Per document: chunks that succeeded and failed, facts before and after the dedupe, duplicates, and the sorted pages
    that the kept facts stand on. calls: document, status. kept: document, pages (array of int)."""
    a = calls.groupBy(document).agg(F.count_if(F.col("status") == "success").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"))
    b = found.groupBy(document).agg(F.count(F.lit(1)).alias("facts_found"))
    c = kept.groupBy(document).agg(F.count(F.lit(1)).alias("facts_kept"))
    pages = kept.select(document, F.explode("pages").alias("_p")).groupBy(document).agg(F.array_sort(F.collect_set("_p")).alias("pages"))
    rows = a.join(b, document, "left").join(c, document, "left").join(pages, document, "left").fillna(0, ["facts_found", "facts_kept"])
    return rows.withColumn("duplicates", F.col("facts_found") - F.col("facts_kept")).withColumn("pages", F.coalesce("pages", F.array().cast("array<int>")))
