import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, part int, nth long, key string, digest string, size int, label int, rep long, a long"


def row(doc_id, text, n=None):
    return (doc_id, text, None, "src0", n, 0.5, 1, 2, "k", "d", 3, 4, 5, 6)


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta"]) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and blank texts, repeats, ties, a very long text, near copies, and odd signs."""
    rng = random.Random(7)
    base = words(rng, 120)
    near = base.split()
    near[50] = "other"
    long = words(rng, 60_000)
    rows = [row(1, None), row(2, ""), row(3, " \n\t "), row(4, base), row(5, base), row(5, base), row(6, " ".join(near)), row(None, base), row(None, None), row(7, long), row(8, "one two"), row(9, "One  Two"), row(10, "İd ﬁ é <|endoftext|>   ½ 'S don't !!?? 日本語")]
    return rows + [row(20 + i, words(rng, rng.randrange(3, 200)), rng.randrange(1000)) for i in range(40)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
