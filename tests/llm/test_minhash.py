import random

import pytest

from factloom.llm import minhash


def sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def expected(rows):
    """(doc_id, set size, component) by comparing all pairs; rows with a null id take their set's component."""
    found = sets([t for _, t in rows])
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, _) in enumerate(rows):
        for m in range(k):
            j = rows[m][0]
            a, b = found[k], found[m]
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    out = []
    for (i, _), s in zip(rows, found, strict=True):
        if i is not None:
            out.append((i, len(s), root(i) if s else i))
        else:
            same = [root(j) for (j, _), o in zip(rows, found, strict=True) if j is not None and o == s and s]
            out.append((None, len(s), min(same) if same else None))
    return sorted(out, key=str)


def test_odd_rows(odd, odd_rows):
    got = minhash.op1_minhash_components(odd).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=str) == expected([(r[0], r[1]) for r in odd_rows])
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("block", [2048, 4])
def test_groups_whose_members_link_only_through_others(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    if block == 4:  # hubs and runs of a few links and sets each
        inner = minhash._linked
        monkeypatch.setattr(minhash, "_linked", lambda pairs, sets: inner(pairs, sets, hub=3))
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(3):
        chain = [rng.choice(vocabulary) for _ in range(90)]
        for step in range(14):  # each differs from the last in one word, so the ends of the chain differ much
            rows.append((1000 * g + rng.randrange(10**6), " ".join(chain)))
            chain = list(chain)
            chain[(step * 6) % 90] = rng.choice(vocabulary)
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    rows += [(2_000_000 + i, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(30))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = minhash.op1_minhash_components(df).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=str) == expected(rows)


def test_runs_of_a_block_hold_few_shingles():
    """Long sets of one bucket go into runs; each pair is tried once, and a run holds what it tries."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    n = 60
    sizes = rng.integers(900, 1100, n)
    sketch = rng.integers(0, 256, minhash.MINIMA, dtype=np.uint8).tobytes()
    rows = pa.table({"a": np.arange(n), "component": np.arange(n), "n_shingles": sizes, "rest": rng.random(n) < 0.7, "member": np.ones(n, bool), "band": np.full(n, 3), "sketch": [sketch] * n, "bands": [rng.integers(0, 1 << 40, minhash.BANDS) for _ in range(n)]})
    out = minhash._block_tries(rows, held=5000)
    pairs, runs = [], {}
    for run, a, partners in out:
        if a is None:
            assert run not in runs
            runs[run] = set(partners.tolist())
        else:
            pairs += [(run, a, b) for b in partners.tolist()]
    want = {(i, j) for i in range(n) if rows["rest"][i].as_py() for j in range(n) if i != j and 100 * min(sizes[i], sizes[j]) >= 75 * max(sizes[i], sizes[j])}
    assert {(a, b) for _, a, b in pairs} == want and len(pairs) == len(want) and len(runs) > 10
    assert all({a, b} <= runs[r] for r, a, b in pairs) and all(sizes[list(r)].sum() <= 5000 for r in runs.values())
    assert {len(r) for r in [set(p.tolist()) for _, a, p in minhash._block_tries(rows, held=1) if a is None]} == {2}


def test_long_texts_in_one_bucket(spark, monkeypatch):
    """Long texts that share minima but no links are tried in runs, and found whole."""
    monkeypatch.setattr(minhash, "HELD", 20_000)
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows, base = [], [rng.choice(vocabulary) for _ in range(6000)]
    for i in range(24):
        words = list(base)
        for _ in range(rng.choice([80, 180, 260, 420])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((100 - i, " ".join(words)))
    got = minhash.op1_minhash_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=str) == expected(rows)


def test_components_of_a_long_path(spark):
    run = minhash.Run(spark, "test-components")
    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(199) if i != 120], "a long, b long")
    got = {r["node"]: r["component"] for r in minhash.components(run, edges, "path").collect()}
    left, right = min(order[:121]), min(order[121:])
    want = {n: left for n in order[:121] if n != left} | {n: right for n in order[121:] if n != right}
    assert got == want


def test_empty_table(nothing):
    assert minhash.op1_minhash_components(nothing).count() == 0
