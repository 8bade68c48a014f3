"""Usage of language models: totals by stage with a grand total, and costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.expr import lookup

# Dollars per million tokens, (input, output); a parameter of summary().
PRICES = {"gpt-4.1": (2.00, 8.00), "gpt-4.1-mini": (0.40, 1.60), "gpt-4.1-nano": (0.10, 0.40), "openai/gpt-oss-120b": (0.15, 0.60), "meta/llama-3.1-70b-instruct": (0.90, 0.90), "llama-3.3-70b-versatile": (0.59, 0.79)}


def summary(records: DataFrame, prices: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """stage (null: all), calls, prompt, completion and total tokens, and cost, in one rollup.

    records: stage, model, prompt_tokens, completion_tokens. Prices and costs are whole nano-dollars a token, so the
    sum does not depend on the order in which rows arrive.
    """
    table = prices or PRICES
    nano = lambda i: lookup(F.col("model"), {m: round(p[i] * 1000) for m, p in table.items()}, F.lit(0)).cast("bigint")
    rows = records.withColumn("_nano", F.col("prompt_tokens") * nano(0) + F.col("completion_tokens") * nano(1))
    return rows.rollup("stage").agg(F.count(F.lit(1)).alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"), F.sum("_nano").alias("nano_dollars"))
