"""All queries of the engine's own operators, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.plans import captures, evidence, profiles, records, texts, university, web

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**web.QUERIES, **texts.QUERIES, **records.QUERIES, **captures.QUERIES, **profiles.QUERIES, **university.QUERIES, **evidence.QUERIES}

ORACLES: dict[str, str] = {**web.ORACLES, **texts.ORACLES, **records.ORACLES, **captures.ORACLES, **profiles.ORACLES, **university.ORACLES, **evidence.ORACLES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages to ordered crawl queues: extract, resolve, classify, dedupe, best link per category."""
    return web.manifest_queue(spark, sf_dir)
