"""Toxicity scores by a weighted lexicon, matched by Aho-Corasick over folded text, with exception phrases."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import Run, id_crc32, map_rows, ship
from factloom.llm.quality import sample

#: At most so many labelled rows are learnt from, those whose hashed ids are smallest.
SAMPLE = 12_000
THRESHOLD = 0.7
PREFIXES = (4, 5, 6, 7, 8, 10)
LEAST_DOCS = 4
#: The chance that a lexicon takes even one pattern which toxic and other documents hold alike.
CHANCE = 0.01
#: Shorter texts' hits are measured as if they had so many words.
LEAST_WORDS = 20

# Letters of other scripts, digits and signs that stand for Latin letters. 1, | and l all become i.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ո": "n",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "|": "i", "l": "i",
}
#: These signs are letters only before another letter or digit: "$tup!d" is a word, "stupid!" ends in a sign.
SIGNS = {"$": "s", "!": "i", "+": "t"}
_SIGN = re.compile(r"[$!+](?=[^\W_])")

#: In these phrases a word of the lexicon is no insult.
EXCEPTIONS = ("clown fish", "clownfish", "trash can", "trash bin", "trash talk", "pathetic fallacy", "oxymoron", "stupidity tax", "idiot proof", "idiot board", "pond scum", "sore loser bracket")


class _Fold(dict):
    """Code point -> its folded form: look-alikes, then letters, digits and marks as they are and all else a space."""

    def __init__(self):
        super().__init__({ord(k): v for k, v in LOOKALIKES.items()})

    def __missing__(self, code: int) -> str:
        c = chr(code)
        out = c if c.isalnum() or unicodedata.combining(c) else " "
        if len(self) < 1 << 16:
            self[code] = out
        return out


_FOLD = _Fold()
_MARKS = re.compile("[\u0300-\u036f]")


def fold(text: str) -> str:
    """Compatibility forms composed (NFKC), in lower case, look-alikes and digits as letters, SIGNS within words too;
    words apart by one space or more, with one at either end."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if "$" in text or "!" in text or "+" in text:
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return f" {text.translate(_FOLD)} "


def bare(folded: str) -> str:
    """A folded text without its letters' accents: marks go, and letters that show only then meet the look-alikes."""
    if folded.isascii():
        return folded
    return _MARKS.sub("", unicodedata.normalize("NFD", folded)).translate(_FOLD)


def candidates(word: str) -> Iterator[str]:
    """A folded word as a pattern that matches it whole, and those of its beginnings."""
    yield f" {word} "
    for n in PREFIXES:
        if n < len(word):
            yield f" {word[:n]}"


def patterns(folded: str) -> Counter:
    """How often each candidate pattern matches a folded text: patterns without accents match the bare text, those with
    accents the text as it is."""
    plain = bare(folded)
    found: Counter = Counter()
    for word, n in Counter(plain.split()).items():
        for p in candidates(word):
            found[p] += n
    if plain != folded:
        for word, n in Counter(folded.split()).items():
            for p in candidates(word):
                if not p.isascii() and bare(p) != p:
                    found[p] += n
    return found


class Lexicon:
    """Weighted patterns in an automaton, and the line that turns their hits into a score.

    Patterns without accents meet the text without its accents, so an accent hides nothing; those with accents meet the
    text as it is. The score is logistic in two sums over a text, both per thousand words (LEAST_WORDS at least) and as
    logarithms, which is what normalises by length: the weights of all hits, and those of the distinct patterns that
    hit. A hit that lies within an exception phrase counts for nothing. Without hits the score is that of the line's
    constant.
    """

    def __init__(self, weights: dict[str, float], line: tuple[float, float, float] = (-3.0, 1.0, 1.0), exceptions: Iterable[str] = EXCEPTIONS):
        self.weights, self.line, self.exceptions = dict(weights), line, tuple(exceptions)
        self._automaton = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            found, self._marked = ahocorasick.Automaton(), any(bare(p) != p for p in self.weights)
            known = {p: [w, 0] for p, w in self.weights.items()}
            for phrase in self.exceptions:
                known.setdefault(f" {' '.join(bare(fold(phrase)).split())} ", [0.0, 0])[1] = 1
            for p, (w, masks) in known.items():
                found.add_word(p, (p, len(p), w, masks, bare(p) != p))
            if known:
                found.make_automaton()
            self._automaton = found
        return self._automaton

    def hits(self, folded: str) -> list[tuple[int, str, float]]:
        """(place, pattern, weight) of the hits outside exception phrases; places are those of the bare text, or, for a
        pattern with accents, of the text as it is."""
        if not self.weights:
            return []
        automaton, plain = self.automaton, bare(folded)
        hits, masked = [], []
        for end, (p, n, w, masks, marked) in automaton.iter(plain):
            if masks:
                masked.append((end - n + 1, end))
            if w and not marked:
                hits.append((end - n + 1, p, w))
        if masked:
            hits = [h for h in hits if not any(a <= h[0] and h[0] + len(h[1].rstrip()) - 1 <= b for a, b in masked)]
        if self._marked and plain != folded:
            hits += [(end - n + 1, p, w) for end, (p, n, w, _, marked) in automaton.iter(folded) if w and marked]
        return hits

    def sums(self, folded: str) -> tuple[float, float]:
        hits = self.hits(folded)
        if not hits:
            return 0.0, 0.0
        words = max(LEAST_WORDS, len(folded.split()))
        return math.log1p(1000 * math.fsum(w for _, _, w in hits) / words), math.log1p(1000 * math.fsum({p: w for _, p, w in hits}.values()) / words)

    def score(self, text: str) -> float:
        a, b, c = self.line
        every, distinct = self.sums(fold(text or ""))
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, a + b * every + c * distinct))))

    @classmethod
    def fit(cls, rows: list[tuple[str, int]], exceptions: Iterable[str] = EXCEPTIONS) -> Lexicon:
        """From (text, label), on one machine: what fit() below learns from a DataFrame."""
        held: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in rows:
            held[bool(label)].update(dict.fromkeys(patterns(fold(text)), 1))
        toxic = sum(bool(label) for _, label in rows)
        tested = [(p, n, held[0][p]) for p, n in held[1].items() if n >= LEAST_DOCS]
        found = cls(chosen(tested, len(tested), toxic, len(rows) - toxic), exceptions=exceptions)
        found.line = _logistic(np.array([[1.0, *found.sums(fold(t))] for t, _ in rows]).reshape(-1, 3), np.array([y for _, y in rows], float))
        return found


def significance(n1, n0, toxic: int, clean: int, log=np.log):
    """The likelihood-ratio statistic (G squared, one degree of freedom) of a pattern in n1 of toxic and n0 of clean
    documents; log makes it of numbers or, with Spark's, of Columns."""
    total = toxic + clean
    part = lambda seen, expected: seen * log((seen + 1e-9) / (expected + 1e-9))
    both = n1 + n0
    return 2 * (part(n1, both * toxic / total) + part(n0, both * clean / total) + part(toxic - n1, (total - both) * toxic / total) + part(clean - n0, (total - both) * clean / total))


def threshold(tested: int) -> float:
    """The statistic beyond which a pattern counts, of tested ones (Bonferroni's bound, two-sided)."""
    return NormalDist().inv_cdf(1 - CHANCE / (2 * max(1, tested))) ** 2


def chosen(rows: Iterable[tuple[str, int, int]], tested: int, toxic: int, clean: int) -> dict[str, float]:
    """Weights of the significant patterns of (pattern, toxic documents, clean documents), each a smoothed log-odds.

    Of patterns where one is the beginning of the other only the most significant is taken, the longer of equal ones.
    """
    if not toxic or not clean:
        return {}
    bound = threshold(tested)
    ranked = sorted(((float(significance(n1, n0, toxic, clean)), len(p), p, n1, n0) for p, n1, n0 in rows if n1 * clean > n0 * toxic), reverse=True)
    weights: dict[str, tuple[str, float]] = {}
    begun: set[str] = set()
    for g, _, p, n1, n0 in ranked:
        word = p.strip()
        if g < bound or word in begun or any(word[:k] in weights for k in range(1, len(word) + 1)):
            continue
        weights[word] = p, math.log((n1 + 0.5) / (toxic + 1)) - math.log((n0 + 0.5) / (clean + 1))
        begun.update(word[:k] for k in range(1, len(word) + 1))
    return dict(weights.values())


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Newton's method with a small ridge, each step halved until it gains; without both labels, a constant."""
    share = (y.sum() + 1) / (len(y) + 2)
    beta = np.array([math.log(share / (1 - share)), 0.0, 0.0])
    if len(set(y.tolist())) < 2:
        return tuple(beta.tolist())

    def gain(beta: np.ndarray) -> float:
        z = x @ beta
        return float((y * z - np.logaddexp(0, z)).sum() - ridge / 2 * (beta @ beta))

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3), x.T @ (y - p) - ridge * beta)
        size, best = 1.0, gain(beta)
        while size > 1e-9 and gain(beta + size * step) < best:
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def fit(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Lexicon:
    """A lexicon for labels.toxic, learnt from at most most rows whose crc32(doc_id as text) mod 3 is not 1.

    Candidates are whole words and beginnings of words in LEAST_DOCS toxic documents or more. Their documents are
    counted in the tasks; only the significant ones reach the driver, as chosen() says. The line is fitted by Newton's
    method on the two sums of each sampled row, taken over its whole text.
    """
    run = Run(documents.sparkSession, "lexicon")
    rows = run.table("sample", sample(documents, labels, "toxic", 3, (0, 2), most))
    sizes = {bool(r["_label"]): r["n"] for r in rows.groupBy((F.col("_label") > 0).cast("int").alias("_label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[label > 0].update(dict.fromkeys(patterns(fold(text)), 1))
            if len(held[0]) + len(held[1]) > 1 << 20:
                yield from _counted(held)
                held = (Counter(), Counter())
        yield from _counted(held)

    weights: dict[str, float] = {}
    if toxic and clean:
        counts = map_rows(rows.select("text", "_label"), count, "pattern string, n1 long, n0 long").groupBy("pattern").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        counts = run.table("patterns", counts.where(F.col("n1") >= LEAST_DOCS))
        tested = counts.count()
        ahead = counts.where(F.col("n1") * clean > F.col("n0") * toxic).where(significance(F.col("n1"), F.col("n0"), toxic, clean, F.log) >= threshold(tested) * 0.999)
        weights = chosen([(r["pattern"], r["n1"], r["n0"]) for r in ahead.collect()], tested, toxic, clean)
    lexicon = Lexicon(weights)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [lexicon.sums(fold(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([a for a, _ in sums], pa.float64()), pa.array([b for _, b in sums], pa.float64())], names=["doc_id", "label", "every", "distinct"])

    got = map_rows(rows.select("doc_id", "text", "_label"), measure, "doc_id long, label int, every double, distinct double").toArrow().sort_by("doc_id")
    every, distinct, label = (got.column(c).to_numpy().astype(float) for c in ("every", "distinct", "label"))
    lexicon.line = _logistic(np.column_stack([np.ones(len(label)), every, distinct]), (label > 0).astype(float))
    run.drop()
    return lexicon


def _counted(held: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    clean, toxic = held
    names = list(clean.keys() | toxic.keys())
    for at in range(0, len(names), 1 << 16):
        part = names[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([toxic[p] for p in part], pa.int64()), pa.array([clean[p] for p in part], pa.int64())], names=["pattern", "n1", "n0"])


def score(documents: DataFrame, lexicon: Lexicon, below: float | None = None) -> DataFrame:
    """All documents with score added, in place of a column of that name; with below, only the rows that score less, their
    columns as they are."""
    spark = documents.sparkSession
    documents = documents.drop("score") if below is None else documents
    ship(spark)
    shared = spark.sparkContext.broadcast(lexicon)
    columns, text = documents.columns, documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in batches:
            scores = np.array([lexicon.score(t) for t in batch.column(text).to_pylist()], np.float64)
            if below is None:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*columns, "score"])
            else:
                yield batch.filter(pa.array(scores < below))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(run, documents.schema if below is not None else f"{fields}, score double")


def op9_weighted_lexicon(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """The contract's digest: every document's score. Null texts score as empty ones; repeated rows and rows with a null
    id keep their rows; an empty table has none; without labels, or with one kind only, all score the same."""
    scored = score(documents.select("doc_id", "text"), fit(documents, labels, most))
    return scored.select("doc_id", (id_crc32() % 3 == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
