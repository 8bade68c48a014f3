import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from factloom.llm import sharding


def test_odd_rows_keep_their_slots(odd, odd_rows):
    got = sharding.op4_rendezvous_sharding(odd).collect()
    assert len(got) == len(odd_rows)
    expected = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "key" and 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1


def test_growth_moves_rows_only_into_the_new_shard_and_weights_hold(spark):
    rows = spark.range(20_000).select(F.col("id").alias("k"))
    w = [1.0, 2.0, 1.0]
    got = sharding.shard(rows, "k", w, [*w, 1.0]).groupBy("shard", "grown_shard").count().collect()
    assert all(r["grown_shard"] in (r["shard"], 3) for r in got)
    share = {s: sum(r["count"] for r in got if r["shard"] == s) / 20_000 for s in range(3)}
    assert all(abs(share[s] - w[s] / 4) < 0.02 for s in range(3))
    moved = sum(r["count"] for r in got if r["grown_shard"] == 3) / 20_000
    assert abs(moved - 0.2) < 0.02


def test_shards_against_the_greatest_score_computed_by_hand(spark):
    """-weight / ln(u) of every shard for every key, with u from XXH64 of the shard's number, then of the key."""
    weights = [1.0, 2.5, 0.5, 1.0, 3.0]
    keys = [f"key {i}" for i in range(400)] + ["", "é", None]

    def best(key):
        scores = []
        for i, w in enumerate(weights):
            h = xxhash.xxh64_intdigest(("\x00null" if key is None else key).encode(), seed=xxhash.xxh64_intdigest(struct.pack("<i", i), seed=42))
            scores.append(-w / math.log(((h >> 11) + 0.5) / (1 << 53)))
        return scores.index(max(scores))

    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: (r["shard"], r["grown_shard"]) for r in sharding.shard(df, "k", weights[:4], weights).collect()}
    whole = {k: best(k) for k in keys}
    last = weights.pop()
    assert got == {k: (best(k), whole[k]) for k in keys} and last == 3.0
    assert len({s for s, _ in got.values()}) == 4


def test_columns_with_the_operators_own_names(odd, odd_rows):
    got = sharding.shard(odd.withColumn("slot", F.lit(9)), "doc_id", [1.0, 1.0], keep=["part", "nth", "key", "slot", "a"])
    assert got.columns == ["doc_id", "part", "nth", "key", "a", "shard", "slot", "grown_shard"]
    assert got.where("part = 1 and nth = 2 and grown_shard is null").count() == len(odd_rows)


def test_empty_table_and_bad_weights(nothing):
    assert sharding.op4_rendezvous_sharding(nothing).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("k"), [1.0, 0.0])
