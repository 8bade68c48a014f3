import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from factloom.llm import packing, tokenbin
from factloom.llm.common import Run
from factloom.llm.mph import Mph
from factloom.llm.tokens import encoder, tokenizer_path

LIBRARY = Tokenizer.from_file(tokenizer_path())


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcXYZ éßÀÿ'’.,!_-12½ \n\t\x0b\x1c\x85\xa0|<>́İΣςAΑ日"), max_size=40))
def test_words_encode_as_whole_texts(text):
    (got,) = encoder(tokenizer_path()).encode_many([text])
    assert np.frombuffer(got, "<u4").tolist() == ids(text)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_minimal_perfect_hash(keys):
    keys = np.array(sorted(keys), "<i8").view(np.uint64)
    built, _ = Mph.loads(Mph.build(keys).dumps())
    assert sorted(built.slots(keys).tolist()) == list(range(len(keys)))
    with pytest.raises(ValueError):
        Mph.build(np.array([3, 3], np.uint64))


def test_token_files_hold_every_row_in_order(odd, odd_rows, monkeypatch):
    got = [tuple(r) for r in tokenbin.op8_mph_token_files(odd).select("start", "doc_id", "n_tokens", "ids_crc32").collect()]
    coded = [(r[0], ids(r[1] or "") + [1]) for r in odd_rows]
    assert Counter((k, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, i in coded) == Counter(g[1:] for g in got)
    at = 0
    for start, key, n, _ in sorted(got):
        assert start == at
        at += n
    order = [k for _, k, _, _ in sorted(got)]
    assert order == sorted(order, key=lambda k: (k is not None, k or 0))


def test_lookup_by_key(spark, odd, odd_rows):
    run = Run(spark, "test-tokens")
    tokenbin.write(odd, "doc_id", "text", tokenizer_path(), 1, run.path)
    got = tokenbin.lookup(spark, run.path, [5, 9, 12345]).collect()
    assert Counter((r["key"], tuple(r["ids"])) for r in got) == Counter((r[0], tuple(ids(r[1]) + [1])) for r in odd_rows if r[0] in (5, 9))
    assert tokenbin.lookup(spark, run.path, []).count() == 0
    reader = tokenbin.Reader(run.path)
    for key in {r[0] for r in odd_rows} - {None}:
        assert Counter(tuple(x.tolist()) for x in reader.get(key)) == Counter(tuple(ids(r[1] or "") + [1]) for r in odd_rows if r[0] == key)
    assert not any(reader.get(k) for k in range(10**6, 10**6 + 500))
    run.drop()


def test_access_in_constant_steps_over_many_files_and_buckets(spark, monkeypatch):
    """Small segments and buckets: a key costs the same few reads however many files there are; a hot key spans files."""
    from pathlib import Path

    texts = [(i * 7 - 700, f"text {i} " * (i % 5)) for i in range(300)] + [(77, f"copy {i}") for i in range(200)] + [(None, "none")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    run = Run(spark, "test-many")
    tokenbin.write(df, "doc_id", "text", tokenizer_path(), 1, run.path, segment_tokens=100, bucket_keys=40)
    files = [f for f in Path(f"{run.path}/ids").glob("part-*") if f.stat().st_size]
    assert len(files) > 15 and len(list(Path(run.path).glob("index-*/bucket=*"))) > 5
    raw = sum((tokenbin.Segment(f.read_bytes()).ids.tolist() for f in sorted(files, key=lambda f: (f.name.split("-")[1], f.name.rpartition("-c")[2]))), [])
    assert raw[: len(ids("none")) + 1] == [*ids("none"), 1] and len(raw) == sum(len(ids(t)) + 1 for _, t in texts)
    reader, reads = tokenbin.Reader(run.path, buckets_kept=100), []
    inner = reader._documents
    monkeypatch.setattr(reader, "_documents", lambda *a: reads.append(a) or inner(*a))
    for k, t in texts[:300]:
        if k != 77:
            (found,) = reader.get(k)
            assert found.tolist() == [*ids(t), 1]
    assert len(reads) == len([k for k, _ in texts[:300] if k != 77])
    assert Counter(tuple(x.tolist()) for x in reader.get(77)) == Counter(tuple([*ids(t), 1]) for k, t in texts if k == 77)
    assert [reader.get(k) for k in (1, 10**12, -5)] == [[], [], []]
    damaged = sorted(files)[0].read_bytes()
    with pytest.raises(ValueError):
        tokenbin.Segment(damaged[:-1])
    run.drop()


def test_other_tokenizer_files_are_encoded_whole(tmp_path):
    import shutil

    other = tmp_path / "other.json"
    shutil.copy(tokenizer_path(), other)
    assert encoder(tokenizer_path()).by_word and not encoder(str(other)).by_word and encoder(str(other), True).by_word


def test_empty_tables(nothing):
    assert tokenbin.op8_mph_token_files(nothing).count() == 0
    assert packing.op2_vector_best_fit(nothing).count() == 0


def test_packing_places_every_piece(odd, odd_rows):
    got = packing.op2_vector_best_fit(odd).collect()
    expected = Counter()
    for r in odd_rows:
        i = np.array(ids(r[1] or "") + [0], "<u4")
        expected.update((r[0], n, a, len(i[a : a + 2048]), zlib.crc32(i[a : a + 2048].tobytes())) for n, a in enumerate(range(0, len(i), 2048)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(r["length"] for r in got) // 2048) + 1


def one_by_one(counts, caps, score):
    """Vector best fit, a piece at a time."""
    bins = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            item = (length, 1, length * length)
            open_ = [b for b in bins if all(x <= y for x, y in zip(item, b[0], strict=True))]
            if open_:
                if score == "norm":
                    best = min(open_, key=lambda b: sum(((x - y) / c) ** 2 for x, y, c in zip(b[0], item, caps, strict=True)))
                else:
                    best = max(open_, key=lambda b: sum(x / c * y / c for x, y, c in zip(b[0], item, caps, strict=True)))
            else:
                best = [caps, []]
                bins.append(best)
            best[0] = tuple(x - y for x, y in zip(best[0], item, strict=True))
            best[1].append(length)
    return bins


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 12), min_size=1, max_size=12), st.integers(40, 90), st.integers(2, 6), st.integers(1600, 4000), st.sampled_from(["norm", "dot"]))
def test_best_fit_over_classes(counts, tokens, docs, cost, score):
    got = packing.best_fit(counts, tokens, docs, cost, score=score)
    used = Counter()
    for n, pattern in got:
        assert sum(x * k for x, k in pattern) <= tokens and sum(k for _, k in pattern) <= docs and sum(x * x * k for x, k in pattern) <= cost
        for x, k in pattern:
            used[x] += n * k
    assert used == Counter(counts)
    alone = one_by_one(counts, (tokens, docs, cost), score)
    if score == "norm":
        assert sum(n for n, _ in got) == len(alone)


def test_best_fit_refuses_what_cannot_fit():
    with pytest.raises(ValueError):
        packing.best_fit({50: 1}, 100, 10, 100)
