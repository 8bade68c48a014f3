import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from factloom.llm import decontam, licenses, quality, toxicity

BENCHMARK = "item_id long, text string, doc_id long, start long"


def edits(item, text):
    """The least edits of the whole item against any whole words of text."""
    far = 10**6
    begins = [j < len(text) and text[j] != " " and (j == 0 or text[j - 1] == " ") for j in range(len(text) + 1)]
    last = [0 if b else far for b in begins]
    for i, a in enumerate(item, 1):
        row = [last[0] + 1]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
        last = row
    return min((n for j, n in enumerate(last) if j and text[j - 1] != " " and (j == len(text) or text[j] == " ")), default=far)


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(5)
    return [" ".join("".join(rng.choice("abcdeéö") for _ in range(rng.randrange(2, 8))) for _ in range(25)) for _ in range(12)]


def test_regions_within_the_budget_are_found_and_no_others(spark, passages):
    rng = random.Random(6)
    items = decontam.Items(list(range(len(passages))), [decontam.normalise(p) for p in passages])
    filler = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    docs, want = [], set()
    for k in range(80):
        i = rng.randrange(len(passages))
        signs = list(items.texts[i])
        for _ in range(rng.randrange(0, int(items.budget[i]) + 5)):
            at, kind = rng.randrange(len(signs)), rng.random()
            if kind < 0.4:
                signs[at] = rng.choice("xyz")
            elif kind < 0.7:
                signs.insert(at, rng.choice("xyz"))
            else:
                del signs[at]
        text = f"{filler(rng.randrange(30))}. {''.join(signs).upper()}, {filler(rng.randrange(30))}"
        docs.append((k, text))
        normal = decontam.normalise(text)
        want |= {(k, j, d) for j, t in enumerate(items.texts) if (d := edits(t, normal)) <= items.budget[j]}
    benchmark = spark.createDataFrame([(i, p, None, None) for i, p in enumerate(passages)], BENCHMARK)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontam.op7_qgram_bands(df, benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == want and len(want) > 30
    text = dict(docs)
    assert all(edits(items.texts[r["item_id"]], decontam.normalise(text[r["doc_id"]][r["start"] : r["end"]])) == r["edits"] for r in got)
    clean = {r["doc_id"] for r in decontam.clean(df, benchmark).collect()}
    assert clean == {k for k, _ in docs} - {k for k, _, _ in want}


def test_benchmark_in_several_passes(spark, passages, monkeypatch):
    monkeypatch.setattr(decontam, "PASS_CHARS", 300)
    benchmark = spark.createDataFrame([(i, p, None, None) for i, p in enumerate(passages)], BENCHMARK)
    df = spark.createDataFrame([(i, f"x {p} y") for i, p in enumerate(passages)] + [(99, "clean")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.op7_qgram_bands(df, benchmark).collect()} == {(i, i) for i in range(len(passages))}
    assert [r["doc_id"] for r in decontam.clean(df, benchmark).collect()] == [99]


def test_odd_rows_against_odd_items(spark, odd, odd_rows, nothing):
    benchmark = spark.createDataFrame([(1, "one two", 0, 0), (1, "one two", 0, 0), (2, None, 0, 0), (3, " ", 0, 0), (None, "one two", 0, 0), (4, odd_rows[3][1], 0, 0)], BENCHMARK)
    got = decontam.op7_qgram_bands(odd, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(8, 1), (9, 1), (4, 4), (5, 4), (6, 4), (None, 4)}
    kept = decontam.clean(odd, benchmark, least_chars=1)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows) - 7
    assert decontam.clean(odd, benchmark).count() == len(odd_rows) - 5  # "one two" is below LEAST_CHARS
    assert decontam.op7_qgram_bands(nothing, benchmark).count() == 0
    assert decontam.clean(odd, benchmark.limit(0)).count() == len(odd_rows)


def test_items_that_share_an_opening(monkeypatch):
    """Common q-grams leave the count and the bound; what is found stays, and memory stays small."""
    import pickle
    import tracemalloc

    rng = random.Random(8)
    filler = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    opening = "choose the one best answer to the question below"
    texts = [f"{opening} {filler(rng.choice([40, 45, 50]))}" for _ in range(3000)]
    items = decontam.Items(list(range(3000)), texts)
    assert len(pickle.dumps(items)) < 64 << 20
    docs = [" ".join([opening] * 45), f"{filler(9)} {texts[7]} {filler(9)} {texts[11]}x {texts[13][:-1]}", opening]
    want = {(k, i, d) for k, t in enumerate(docs) for i in (7, 11, 13, 19) if (d := edits(texts[i], t)) <= items.budget[i]}
    tracemalloc.start()
    got = {(k, i, e) for k, i, e, _, _ in decontam.hits(items, docs)}
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    assert {g for g in got if g[1] in (7, 11, 13, 19)} == want and len(want) >= 3
    small = [f"{opening} {filler(n)}" for n in (1, 2, 3, 4) for _ in range(6)]
    few = [f"{opening} {filler(2)} {small[0]}", f"{small[13]} {opening[:-6]}", " ".join([opening] * 3)]
    monkeypatch.setattr(decontam.Items, "HELD", 10**9)
    counted = decontam.Items(list(range(24)), small)
    monkeypatch.setattr(decontam.Items, "HELD", 2)
    assert sorted(decontam.hits(counted, few)) == sorted(decontam.hits(decontam.Items(list(range(24)), small), few))


def test_items_match_whole_words_only(spark):
    benchmark = spark.createDataFrame([(1, "the answer", 0, 0), (2, "Yes", 0, 0), (3, "the answer", 0, 0)], BENCHMARK)
    df = spark.createDataFrame([(1, "He lithe answers well"), (2, "So the answer: yes"), (3, "the answer"), (4, "yesterday")], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in decontam.op7_qgram_bands(df, benchmark).collect()}
    assert got == {(2, 1, 3, 13), (2, 3, 3, 13), (2, 2, 15, 18), (3, 1, 0, 10), (3, 3, 0, 10)}


def test_places_lead_back_to_the_text():
    text = "  Ab—C, İx\n9! "
    normal = decontam.normalise(text)
    at = decontam.places(text)
    assert len(at) == len(normal) and [decontam.fold(text)[p] for p, c in zip(at, normal, strict=True) if c != " "] == list(normal.replace(" ", ""))


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."


def test_licence_rules(spark, odd, odd_rows, nothing):
    texts = {1: f"x\n\n{MIT}", 2: "Text.\nReleased under the MIT License.\nMore. Licensed under CC BY-NC 4.0.", 3: "We have no licence", 4: "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0.", 5: "a\nAll rights reserved.\nall rights reserved"}
    got = {r["doc_id"]: r for r in licenses.op10_sentence_rules(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert {k: r["licences"] for k, r in got.items()} == {1: "mit", 2: "cc-by-nc-4.0,mit", 3: "", 4: "apache-2.0", 5: "proprietary"}
    assert got[1]["wrapped"] == "<mit-grant><mit-notice>"
    assert licenses.op10_sentence_rules(odd).count() == len(odd_rows) and licenses.op10_sentence_rules(nothing).count() == 0


def test_licence_tables_are_sound():
    import re

    names = set(licenses.SENTENCES)
    assert all(set(ids) <= names for _, ids in licenses.RULES)
    for listed in licenses.SENTENCES.values():
        for s in listed:
            assert re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", s)
    plain = [s for listed in licenses.SENTENCES.values() for s in listed if not re.search(licenses.ANCHORS, s)]
    assert all(any(sign in s for sign in licenses.SIGNS) for listed in licenses.SENTENCES.values() for s in listed if s not in plain)
    reachable = [s for s in plain if any(s in more for more in licenses.SENTENCES["apache-comply"])]
    assert plain == reachable


def test_licence_sql_agrees(spark, odd):
    documents = odd.select("doc_id", "text").where("doc_id is not null").toPandas()  # noqa: F841
    want = duckdb.sql(licenses.oracle()).fetchall()
    cols = ("doc_id", "sentences", "wrapped", "n_licences", "licences")
    assert Counter(want) == Counter(tuple(r[c] for c in cols) for r in licenses.op10_sentence_rules(odd.where("doc_id is not null")).collect())


def test_licences_in_wrapped_and_spaced_notices(spark):
    notices = ["All rights\nreserved.", "All rights  reserved.", "All rights\u00a0reserved.", "x\r\n\r\nAll rights\r\nreserved", "Released under CC\nBY 4.0.", "Released under (CC) BY 4.0.", "Released under CC-BY-SA 4.0.", "Released under CC_BY-NC 4.0.", "Released under\nCC  BY--ND 4.0.", "RELEASED UNDER CC0\n1.0", "All rights. reserved"]
    documents = pd.DataFrame({"doc_id": range(len(notices)), "text": notices})
    want = sorted(duckdb.sql(licenses.oracle()).fetchall())
    cols = ("doc_id", "sentences", "wrapped", "n_licences", "licences")
    got = sorted(tuple(r[c] for c in cols) for r in licenses.op10_sentence_rules(spark.createDataFrame(documents)).collect())
    assert got == want
    assert [r[4] for r in got] == ["proprietary"] * 4 + ["cc-by-4.0"] * 2 + ["cc-by-sa-4.0", "cc-by-nc-4.0", "cc-by-nd-4.0", "cc0-1.0", ""]


LABELS = "doc_id long, quality int, toxic int, text string"


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(900):
        good, rude = rng.random() < 0.8, rng.random() < 0.2
        words = [rng.choice(["river", "stone", "light", "paper", "window", "garden", "bottle"]) for _ in range(rng.randrange(5, 80))]
        if rude:
            words.insert(rng.randrange(len(words)), rng.choice(["dullard", "DULLARD", "du11ard", "nitwit", "n1tw1t"]))
        text = " ".join(words) if good else "### ".join(w.upper() for w in words) + " %%%"
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), int(rude), "x"))
    labels += [(0, None, None, None), (None, 1, 1, None), (10**6, 1, 0, None)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, LABELS), {r[0]: r for r in labels[:900]}


def test_quality_on_held_out_rows(labelled):
    docs, labels, truth = labelled
    got = quality.op5_factorisation_machine(docs, labels).collect()
    assert len(got) == 900 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]][1] for r in held]) > 0.97


def test_toxicity_on_held_out_rows(labelled):
    docs, labels, truth = labelled
    got = toxicity.op9_weighted_lexicon(docs, labels).collect()
    assert len(got) == 900 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]][2] for r in held]) > 0.97


def test_scores_of_odd_rows(labelled, odd, odd_rows, nothing):
    docs, labels, _ = labelled
    for got, empty in ((quality.op5_factorisation_machine(odd, labels), quality.op5_factorisation_machine(nothing, labels)), (toxicity.op9_weighted_lexicon(odd, labels), toxicity.op9_weighted_lexicon(nothing, labels))):
        rows = got.collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
        assert empty.count() == 0
    none = labels.limit(0)
    assert quality.op5_factorisation_machine(odd, none).count() == toxicity.op9_weighted_lexicon(odd, none).count() == len(odd_rows)
    scored = quality.score(odd, quality.Machine(0.0, np.zeros(quality.width(0)), np.zeros((quality.width(0), quality.RANK))))
    assert scored.columns.count("score") == 1 and toxicity.score(odd, toxicity.Lexicon({})).columns.count("score") == 1
    assert scored.count() == len(odd_rows) and licenses.scan(odd.withColumn("licences", odd["key"]), "text", ["key", "licences"]).columns == ["key", "sentences", "wrapped", "licences"]
    kept = quality.score(odd, quality.fit(docs, labels, quality.METADATA), quality.METADATA, keep=0.0)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, quality.RANK)))
    i, x = np.array([3, 9, 20, 41]), rng.normal(size=4)
    pairs = sum(x[a] * x[b] * m.factors[i[a]] @ m.factors[i[b]] for a in range(4) for b in range(a + 1, 4))
    assert abs(m.margin(i, x) - (0.3 + x @ m.weights[i] + pairs)) < 1e-9


def test_folding_and_exceptions():
    rude = toxicity.Lexicon({toxicity.fold("clown").strip().join("  "): 5.0, " nitw": 4.0})
    assert rude.score("you CL0WN!") > 0.5 and rude.score("сlоwn") > 0.5 and rude.score("n1twits") > 0.5
    assert rude.score("a clown fish swims") == rude.score("nothing here") < 0.5
    assert rude.score("unclowned") == rude.score("") == rude.score(None)
    assert toxicity.Lexicon({}).score("clown") < 0.5


def test_hits_against_a_naive_matcher():
    """Every pattern tried at every word, by the plain meaning of each fold."""
    import unicodedata

    alike = {**toxicity.LOOKALIKES}

    def plain(text, marks):
        text = unicodedata.normalize("NFKC", text).lower()
        signs = [toxicity.SIGNS.get(c, c) if c in toxicity.SIGNS and text[i + 1 : i + 2].isalnum() else c for i, c in enumerate(text)]
        out = "".join(alike.get(c, c if c.isalnum() or unicodedata.combining(c) else " ") for c in signs)
        if not marks:
            out = "".join(alike.get(c, c) for c in unicodedata.normalize("NFD", out) if not "\u0300" <= c <= "\u036f")
        return out.split()

    rng = random.Random(4)
    weights = {" idiot ": 3.0, " mor": 2.0, " réeu": 1.5, " reeuxa ": 1.25, " i": 0.5}
    lexicon = toxicity.Lexicon(weights, exceptions=())
    pieces = ["idiot", "ÍD10T", "1d!ot", "idiots", "moron", "m0ron", "mörbe", "réeuxpa", "RÉEUXA", "reeuxa", "ｉｄｉｏｔ", "|diot", "ıdıot", "stone", "!diot", "idiot!", "a+b", "léeu", "lamp", "ﬁne", "е", "é"]
    for _ in range(300):
        text = rng.choice([" ", ", ", "\n"]).join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        want = Counter()
        for p in weights:
            marked = any(not c.isascii() for c in p)
            for w in plain(text, marked):
                want[p] += w == p.strip() if p.endswith(" ") else w.startswith(p.strip())
        got = Counter(p for _, p, _ in lexicon.hits(toxicity.fold(text)))
        assert got == +want, text
        every, distinct = sum(weights[p] * n for p, n in want.items()), sum(weights[p] for p, n in want.items() if n)
        words = max(toxicity.LEAST_WORDS, len(plain(text, True)))
        assert np.allclose(lexicon.sums(toxicity.fold(text)), np.log1p([1000 * every / words, 1000 * distinct / words]))


def test_a_lexicon_learnt_from_tables_is_the_one_learnt_at_hand(labelled):
    docs, labels, _ = labelled
    far = toxicity.fit(docs.select("text", "doc_id"), labels)
    label = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] is not None and r["toxic"] is not None}
    near = toxicity.Lexicon.fit([(r["text"], label[r["doc_id"]]) for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["doc_id"] in label])
    assert far.weights == near.weights and np.allclose(far.line, near.line)
    assert {p.strip() for p in far.weights} >= {"duiiard", "nitwit"} and not any(p.strip() in "river stone iight paper window garden bottie" for p in far.weights)


def test_exception_words_beside_accents_and_no_labels():
    assert toxicity.Lexicon({" réeu": 2.0}).score("reeux") == toxicity.Lexicon({}).score("") < toxicity.Lexicon({" réeu": 2.0}).score("Réeux")
    assert toxicity.Lexicon.fit([]).weights == {} and toxicity.Lexicon.fit([("a b", 1)] * 9).weights == {}


def test_repeated_labelled_ids_and_clashing_columns(labelled):
    """One row of each id is learnt from, the same in any order; columns named as the sample's own do no harm."""
    docs, labels, _ = labelled
    more = docs.union(docs.where("doc_id % 3 = 0").selectExpr("doc_id", "concat('zzz ', text)", "lang", "source", "n_chars")).selectExpr("*", "1 as _label", "'x' as _m0", "2 as _hash", "3 as row")
    rows = quality.sample(more, labels, "quality", 5, (1, 2, 3, 4), 6000, ("n_chars",)).collect()
    again = quality.sample(more.repartition(3, "text"), labels, "quality", 5, (1, 2, 3, 4), 6000, ("n_chars",)).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and sorted(rows) == sorted(again)
    for op in (quality.op5_factorisation_machine, toxicity.op9_weighted_lexicon):
        one, two = ({(r["doc_id"], round(r["score"], 9)) for r in op(d, labels).collect()} for d in (more, more.repartition(5)))
        assert one == two and op(more, labels).count() == more.count()


def test_quality_scores_against_plain_arithmetic(spark, labelled):
    """The query's scores again, from the machine's numbers: features by counting, pairs one by one."""
    docs, labels, _ = labelled
    machine = quality.fit(docs, labels, quality.METADATA)
    got = {r["doc_id"]: r["score"] for r in quality.op5_factorisation_machine(docs, labels).collect()}
    for r in docs.limit(25).collect():
        words = r["text"].lower().split()
        x: dict[int, float] = Counter(zlib.crc32(w.encode()) % quality.WORD_BUCKETS for w in words)
        x = {k: 1 + np.log(n) for k, n in x.items()}
        size = sum(v * v for v in x.values()) ** 0.5
        x = {k: v / size for k, v in x.items()}
        kinds = Counter("upper" if "A" <= c <= "Z" else "lower" if "a" <= c <= "z" else "digit" if c in "0123456789" else "space" if c in " \t\n\v\f\r" else "bar" if c == "|" else "point" if c in ".,'-" else "sign" if ord(c) < 127 else "far" for c in r["text"])
        n, lines, letters = len(words), r["text"].split("\n"), kinds["upper"] + kinds["lower"] + kinds["far"]
        shares = [kinds["upper"] / letters, kinds["digit"] / len(r["text"]) / 0.5, kinds["sign"] / len(r["text"]) / 0.5, kinds["bar"] / len(r["text"]) / 0.25, kinds["point"] / len(r["text"]) / 0.25, kinds["far"] / len(r["text"]) / 0.5, sum(a == b for a, b in zip(words, words[1:])) / n, 1 - len(set(words)) / n, max(Counter(words).values()) / n, 1 - len(set(lines)) / len(lines)]
        bins = [min(15, int(16 * s**0.5)) for s in shares] + [min(15, (n + 1).bit_length() - 1), min(15, int(len(r["text"]) / n / 1.5)), min(15, int(np.log2(len(r["text"]) / len(lines) + 1)))]
        x |= {quality.WORD_BUCKETS + 16 * k + b: 14**-0.5 for k, b in enumerate(bins)}
        x[quality.WORD_BUCKETS + 16 * 13 + r["n_chars"].bit_length()] = 14**-0.5
        at = list(x)
        pairs = sum(x[a] * x[b] * float(machine.factors[a] @ machine.factors[b]) for i, a in enumerate(at) for b in at[i + 1 :])
        margin = machine.bias + sum(x[a] * machine.weights[a] for a in at) + pairs
        assert abs(got[r["doc_id"]] - 1 / (1 + np.exp(-margin))) < 1e-9


def test_disclaimers_of_bsd_and_isc(spark):
    bsd = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE\nIMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    grant = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
    documents = pd.DataFrame({"doc_id": [1, 2, 3], "text": [grant + bsd, isc, MIT]})
    want = sorted(duckdb.sql(licenses.oracle()).fetchall())
    cols = ("doc_id", "sentences", "wrapped", "n_licences", "licences")
    got = sorted(tuple(r[c] for c in cols) for r in licenses.op10_sentence_rules(spark.createDataFrame(documents)).collect())
    assert got == want and [r[4] for r in got] == ["bsd-2-clause", "isc", "mit"]
    assert "<bsd-as-is><bsd-no-liability><bsd-damage>" in got[0][2] and got[1][2] == "<isc-grant><isc-as-is>"
