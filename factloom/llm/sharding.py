"""Sharding by weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import Run, global_ranks, text_of, unsigned_crc32, with_task_ranks


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (int, from 0) whose score for this key is largest.

    A shard's score is -weight / ln(u), u in (0, 1) being drawn by xxhash64 from the key and the shard's number alone.
    So each shard wins a share of the keys in proportion to its weight, and adding, removing or reweighing one shard
    moves keys only into or out of that shard. A null key is a key of its own; equal scores go to the lower shard.
    """
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive, and there must be one at least")
    key = F.coalesce(key.cast("string"), F.lit("\x00null"))

    def score(shard: int, weight: float) -> Column:
        top = F.shiftrightunsigned(F.xxhash64(F.lit(shard), key), 11).cast("double")
        return F.lit(float(weight)) / -F.log((top + 0.5) / F.lit(float(1 << 53)))

    scores = F.array(*[F.struct(score(i, w).alias("score"), F.lit(-i).alias("shard")) for i, w in enumerate(weights)])
    return (-F.array_max(scores)["shard"]).cast("int")


def shard(df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of df: key, the columns of keep, shard, slot (its place in the shard, gapless from 0), grown_shard.

    grown: the weights after a planned change of the shard count; grown_shard is the shard under these (null without).
    Rows with one key share a shard, in slots of their own; null keys count as one key; an empty table gives no rows;
    columns of keep with the results' names are left out, any other name is free.
    Slots come from per-task counts, so no shard's rows are sorted or gathered in one place.
    """
    run = Run(df.sparkSession, "sharding")
    columns = [c for c in dict.fromkeys((key, *keep)) if c not in ("shard", "slot", "grown_shard")]
    placed = df.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)], rendezvous(F.col(f"`{key}`"), weights).alias("shard"), (rendezvous(F.col(f"`{key}`"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    ranked = global_ranks(run.table("placed", with_task_ranks(placed, "shard")), "shard", "slot")
    return ranked.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], "shard", "slot", "grown_shard")


def op4_rendezvous_sharding(documents: DataFrame, shards: int = 24) -> DataFrame:
    """The contract's digest: all documents in shards 0 to 23 by doc_id; a null text counts as no bytes."""
    rows = documents.select("doc_id", (F.octet_length(text_of()) + 8).cast("long").alias("size"), unsigned_crc32(text_of()).alias("text_crc32"))
    placed = shard(rows, "doc_id", [1.0] * shards, [1.0] * (shards + 1), keep=["size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
