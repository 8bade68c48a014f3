import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from factloom.llm import decontam, quality, toxicity
from factloom.llm.tokens import tokenizer_path

WORDS = ["river", "stone", "light", "paper", "window", "garden", "bottle", "meadow", "copper", "lantern", "harbour", "thimble"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of which some are bad, rude, copies, near copies, or hold a benchmark passage; and some odd rows."""
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))
    passages = [say(22) for _ in range(5)]
    docs, labels = [], []
    for i in range(500):
        text, good, rude = say(rng.randrange(20, 120)), True, False
        if i % 7 == 0:
            text, good = "### ".join(text.upper().split()) + " %%%", False
        elif i % 11 == 0:
            words = text.split()
            words.insert(5, rng.choice(["nitwit", "n1twit", "dullard"]))
            text, rude = " ".join(words), True
        elif i % 13 == 0:
            text = f"{text}. {passages[i % 5].title()}, {say(10)}"
        elif i % 17 == 0 and i > 20:
            words = docs[i - 1][1].split()
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        docs.append((i, text, "en", f"src{i % 3}", len(text)))
        labels.append((i, int(good), int(rude)))
    docs += [(600, None, None, None, None), (601, "", "en", None, 0), (None, say(30), None, None, 5)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=str)


def test_each_stage_against_its_plain_meaning(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    truth = {r["doc_id"]: r for r in labels.collect()}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows = docs.collect()
        out = stage(spark, docs, tables)
        out.write.parquet(f"{tmp_path}/{n}")
        out = spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert out.columns == docs.columns
        if name == "quality classifier":
            machine = quality.fit(docs, labels, quality.METADATA)
            assert ids(out) == sorted([r["doc_id"] for r in rows if machine.score(*quality.features(r["text"], (r["n_chars"],))) >= 0.3], key=str)
            kept = set(ids(out))
            assert np.mean([(i in kept) == bool(t["quality"]) for i, t in truth.items()]) > 0.97
        elif name == "toxicity":
            lexicon = toxicity.fit(docs, labels)
            assert ids(out) == sorted([r["doc_id"] for r in rows if lexicon.score(r["text"]) < 0.7], key=str)
            kept = set(ids(out))
            assert not any(truth[r["doc_id"]]["toxic"] and r["doc_id"] in kept for r in rows if r["doc_id"] in truth)
        elif name == "MinHash near-dedup":
            from tests.llm.test_minhash import expected

            found = {i: c for i, _, c in expected([(r["doc_id"], r["text"]) for r in rows]) if i is not None}
            assert ids(out) == sorted([r["doc_id"] for r in rows if r["doc_id"] is None or found[r["doc_id"]] == r["doc_id"]], key=str)
            assert out.count() < len(rows)
        elif name == "benchmark decontamination":
            items = [decontam.normalise(r["text"]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
            whole = [r["doc_id"] for r in rows if not any(i in decontam.normalise(r["text"] or "") for i in items)]
            assert ids(out) == sorted(whole, key=str) and len(whole) < len(rows)
        else:
            library = Tokenizer.from_file(tokenizer_path())
            want = sorted(((r["doc_id"], p, zlib.crc32(x.tobytes())) for r in rows for p, x in pieces(library.encode(r["text"] or "", add_special_tokens=False).ids + [0])), key=str)
            got = out.collect()
            assert sorted(((r["doc_id"], r["piece"], r["ids_crc32"]) for r in got), key=str) == want
            assert len({r["sequence_id"] for r in got}) <= -(-sum(r["length"] for r in got) // 2048) + 1
        docs = out


def pieces(found):
    whole = np.array(found, "<u4")
    return [(n, whole[a : a + 2048]) for n, a in enumerate(range(0, len(whole), 2048))]


def test_run_is_all_stages_in_order(spark, tables):
    got = corpus_pipeline.run(spark, tables)
    assert got.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"] and got.count() > 300
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "MinHash near-dedup", "benchmark decontamination", "best-fit packing"]


def test_run_on_empty_tables_and_with_more_columns(spark, tables, tmp_path):
    """Empty documents, labels and benchmark; and columns named as the operators' own."""
    from pathlib import Path

    from factloom.llm.common import Run

    whole = {n: spark.read.parquet(f"{tables}/{n}.parquet") for n in ("documents", "labels", "benchmark")}
    for name, empty in (("no-documents", ("documents",)), ("no-labels", ("labels",)), ("nothing", ("documents", "labels", "benchmark"))):
        for n, df in whole.items():
            (df.limit(0) if n in empty else df.limit(60)).write.parquet(f"{tmp_path}/{name}/{n}.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert got.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]
        assert (got.count() == 0) == ("documents" in empty)
    more = whole["documents"].selectExpr("*", "1 as _label", "'x' as label", "0.5 as score", "2 as part", "3 as nth", "'k' as key", "4 as size", "5 as component_id", "true as kept", "6 as item_id", "7 as `start`", "8 as _hash", "9 as quality", "10 as toxic")
    for n, df in {**whole, "documents": more}.items():
        df.write.parquet(f"{tmp_path}/more/{n}.parquet")
    opened = len(Run.opened)
    got, want = corpus_pipeline.run(spark, f"{tmp_path}/more"), corpus_pipeline.run(spark, tables)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect()), key=str) == sorted(map(tuple, want.select(key).collect()), key=str)
    assert len(Run.opened) == opened + 4  # the runs themselves and their last stages
    mine = next(r for r in Run.opened if r.path.rpartition("/")[2].startswith("pipeline"))
    assert [p.name for p in Path(mine.path).iterdir()] == ["stage-3"]
