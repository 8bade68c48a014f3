"""Benchmark decontamination by the q-gram lemma over diagonal bands, verified by banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import map_rows, ship, text_of

Q = 10
RATE = 0.08
_BASE = np.uint64(0x100000001B3)
_TABLE_BITS = 22
#: Benchmark text that one pass over the documents holds (26 bytes a character, 59 MB in all); a larger benchmark takes
#: more passes.
PASS_CHARS = 1 << 21
#: clean() passes over items of fewer normalised characters (about four words): so short a line occurs by itself.
LEAST_CHARS = 20
#: Occurrences of q-grams that are counted at once.
RUN = 1 << 18
#: Documents are taken in slices of about so many characters, a longer one alone.
SLICE_CHARS = 1 << 21

_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Lower case, of the same length: a letter whose lower case is longer stays."""
    lower = text.lower()
    return lower if len(lower) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normalise(text: str) -> str:
    """Letters and digits in lower case; whatever lies between them is one space."""
    return " ".join(_WORD.findall(fold(text)))


def places(text: str) -> np.ndarray:
    """For each character of normalise(text), its place in text; a space stands where the word before it ends."""
    out: list[np.ndarray] = []
    for m in _WORD.finditer(fold(text)):
        if out:
            out.append(out[-1][-1:] + 1)
        out.append(np.arange(*m.span()))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _grams(codes: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial of every window of Q codes, by doubling: 2, 4, 8, and 8 + 2."""
    with np.errstate(over="ignore"):
        b2 = _BASE * _BASE
        b4 = b2 * b2
        two = codes[:-1] * _BASE + codes[1:]
        four = two[:-2] * b2 + two[2:]
        eight = four[:-4] * b4 + four[4:]
        return eight[:-2] * b2 + two[8:]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)


def _cells(grams: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)


class Items:
    """Benchmark passages with their q-grams' places, for one pass.

    A passage of n characters may differ by budget = RATE * n edits, or by as many as leave one q-gram whole. By the
    q-gram lemma a region within the budget keeps at least n - Q + 1 - Q * budget of its q-grams, all on diagonals at
    most budget apart. The bound stays valid when a passage's commonest q-grams are left out of the count, each
    lowering it by one; least is what remains, 1 or more. So q-grams that more than HELD passages hold (a prompt that a
    benchmark's items begin with) are left out as far as the bound allows. Passages under Q characters hold no q-gram
    and must occur as they are. ids[k] are the item ids of passage k: equal passages are looked for once.
    """

    HELD = 16

    def __init__(self, ids: list[int], texts: list[str]):
        equal: dict[str, list[int]] = {}
        for i, t in zip(ids, texts, strict=True):
            equal.setdefault(t, []).append(i)
        self.texts, self.ids = list(equal), list(equal.values())
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.sizes = sizes
        self.budget = np.maximum(0, np.minimum((RATE * sizes).astype(np.int64), (sizes - Q) // Q))
        self.least = np.maximum(1, sizes - Q + 1 - Q * self.budget)
        number = np.maximum(0, sizes - Q + 1)
        flat = np.concatenate([_grams(_codes(t)) for t, n in zip(self.texts, number.tolist(), strict=True) if n] or [np.empty(0, np.uint64)])
        which = np.repeat(np.arange(len(sizes), dtype=np.int32), number)
        where = (np.arange(len(flat)) - np.repeat(np.cumsum(number) - number, number)).astype(np.int32)
        order = np.argsort(flat, kind="stable")
        flat, which, where = flat[order], which[order], where[order]
        first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.empty(0, np.int64)
        held = np.repeat(np.diff(np.r_[first, len(flat)]), np.diff(np.r_[first, len(flat)]))
        # each passage's q-grams, the commonest first: those that are too common go while one is left to count
        by = np.lexsort((-held, which))
        starts = np.cumsum(number) - number
        turn = np.arange(len(flat)) - np.repeat(starts, number)
        out = (held[by] > self.HELD) & (turn < np.repeat(self.least - 1, number))
        gone = np.zeros(len(flat), bool)
        gone[by[out]] = True
        self.least = self.least - np.bincount(which[gone], minlength=len(sizes))
        flat, self.which, self.where = flat[~gone], which[~gone], where[~gone]
        first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.empty(0, np.int64)
        self.grams, self.first, self.count = flat[first], first.astype(np.int32), np.diff(np.r_[first, len(flat)]).astype(np.int32)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[_cells(self.grams).astype(np.int64)] = True
        self.short = [(i, t) for i, t in enumerate(self.texts) if 0 < len(t) < Q]


def _bounded(text: str, start: int, end: int) -> bool:
    """Whether words begin at start and end at end."""
    return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")


def _exact(item: str, text: str, low: int, high: int) -> int:
    """The first place from low on where item stands as whole words and ends by high; -1 without one."""
    at = text.find(item, low, high)
    while at >= 0 and not _bounded(text, at, at + len(item)):
        at = text.find(item, at + 1, high)
    return at


def align(item: str, text: str, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """The least edits of the whole item against any whole words of text on diagonals low to high, and their place.

    (edits, start, end) or None beyond the budget. A part begins where a word does and ends where one does. Row by row over the item; cell j stands for text place
    row + low + j. A row's insertions are a running minimum; the start is carried along with the edits, least first.
    """
    width = high - low + 1
    codes = _codes(text).astype(np.int64)
    wide = np.full(len(item) + width + 1, -1, np.int64)
    a, b = max(low, 0), min(len(codes), low + len(wide))
    if a < b:
        wide[a - low : b - low] = codes[a:b]
    spots = np.arange(width, dtype=np.int64)
    scale = np.int64(1) << 31
    barred = np.int64(1) << 60
    gap = np.concatenate([[True], codes == 33, [True]])  # whether a space or an end stands before (and at) each place
    begins = spots + low
    inside = (begins >= 0) & (begins < len(codes))
    inside[inside] = gap[begins[inside]] & ~gap[begins[inside] + 1]
    cost = np.where(inside, spots, barred)  # edits * scale + the start's column
    for row, code in enumerate(_codes(item).astype(np.int64)):
        change = cost + scale * (wide[row : row + width] != code)
        drop = np.append(cost[1:], barred) + scale  # the item's character has none in the text
        best = np.minimum(change, drop)
        ends = row + 1 + low + spots
        best[(ends < 0) | (ends > len(codes))] = barred
        cost = np.minimum.accumulate(best - scale * spots) + scale * spots
        if int(cost.min()) >> 31 > budget:
            return None
    ends = len(item) + low + spots
    inside = (ends > 0) & (ends <= len(codes))
    inside[inside] = gap[ends[inside] + 1] & ~gap[ends[inside]]
    cost = np.where(inside, cost, barred)
    at = int(np.argmin(cost))
    edits, start = int(cost[at]) >> 31, int(cost[at]) & int(scale - 1)
    if edits > budget:
        return None
    return edits, start + low, len(item) + low + at


def hits(items: Items, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, passage, edits, start, end) of all regions of normalised texts within a passage's budget, one for each place.

    Regions are whole words. Shared q-grams are counted by text, item and band of diagonals; bands are 2 * (budget + 1) wide and overlap by
    half, so every region within the budget lies whole in one of them. Bands that reach the lemma's bound are aligned.
    """
    found: list[tuple[int, int, int, int, int]] = []
    for i, short in items.short:
        found += [(k, i, 0, m.start(), m.end()) for k, t in enumerate(texts) if short in t for m in re.finditer(rf"(?<![^ ]){re.escape(short)}(?![^ ])", t)]
    last: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for k, i, b in _full_bands(items, texts):
        step, base, budget = int(items.budget[i]) + 1, int(items.sizes[i]), int(items.budget[i])
        low, high = b * step - base, (b + 2) * step - 1 - base
        regions = last.setdefault((k, i), [])
        if any(low <= s <= high for _, s, _ in regions):
            continue  # the overlapping band has shown this region
        exact = _exact(items.texts[i], texts[k], max(low, 0), high + base)  # the alignment without an edit
        place = (0, exact, exact + base) if exact >= 0 else align(items.texts[i], texts[k], low, high, budget)
        if place and not any(place[1] < e and s < place[2] for _, s, e in regions):
            regions.append(place)
    return found + [(k, i, e, s, t) for (k, i), regions in last.items() for e, s, t in regions]


def _full_bands(items: Items, texts: list[str]) -> Iterator[tuple[int, int, int]]:
    """(text, item, band) where the counted q-grams reach the lemma's bound, those with most of them first.

    Occurrences are counted RUN at a time and the counts added up, so what is held is a number for each band that
    shares a q-gram, not the occurrences themselves.
    """
    whole = "\n".join(texts)
    if len(whole) < Q or not len(items.grams):
        return
    grams = _grams(_codes(whole))
    at = np.flatnonzero(items.table[_cells(grams).view(np.int64)])
    slot = np.searchsorted(items.grams, grams[at])
    same = items.grams[np.minimum(slot, len(items.grams) - 1)] == grams[at]
    at, slot = at[same], slot[same]
    del grams
    if not len(at):
        return
    begins = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    most = int(np.diff(begins).max()) + int(items.sizes.max())  # bands of one text are fewer than that
    keys, counts, waiting = np.empty(0, np.int64), np.empty(0, np.int64), []

    def added() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([keys, *(k for k, _ in waiting)])
        distinct, where = np.unique(every, return_inverse=True)
        return distinct, np.bincount(where, np.concatenate([counts, *(n for _, n in waiting)]), len(distinct)).astype(np.int64)

    times = np.cumsum(items.count[slot], dtype=np.int64)
    cuts = [0, *np.unique(np.searchsorted(times, np.arange(RUN, times[-1], RUN), side="right")).tolist(), len(at)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a == b:
            continue
        n = items.count[slot[a:b]].astype(np.int64)
        rows = np.repeat(items.first[slot[a:b]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        spot = np.repeat(at[a:b], n)
        which = np.searchsorted(begins, spot, side="right") - 1
        item = items.which[rows].astype(np.int64)
        band = (spot - begins[which] - items.where[rows] + items.sizes[item]) // (items.budget[item] + 1)
        key = (which * len(items.sizes) + item) * (most + 1) + band + 1  # band 0 lies in band -1 too
        waiting.append(np.unique(np.concatenate([key, key - 1]), return_counts=True))
        if sum(len(k) for k, _ in waiting) > max(RUN, len(keys)):
            keys, counts = added()
            waiting = []
    keys, counts = added()
    pair, band = np.divmod(keys, most + 1)
    text, item = np.divmod(pair, len(items.sizes))
    good = np.flatnonzero(counts >= items.least[item])
    good = good[np.lexsort((band[good], -counts[good], item[good], text[good]))]
    yield from zip(text[good].tolist(), item[good].tolist(), (band[good] - 1).tolist(), strict=True)


def _passes(benchmark: DataFrame, item: str, text: str, least: int = 1) -> Iterator[Items]:
    """The benchmark's items of least normalised characters or more, in parts of about PASS_CHARS characters, by item."""
    rows = benchmark.select(F.col(f"`{item}`").cast("long").alias("i"), text_of(f"`{text}`").alias("t")).where("i is not null").orderBy("i", "t")
    ids: list[int] = []
    texts: list[str] = []
    size = 0
    for r in rows.toLocalIterator():
        normal = normalise(r["t"])
        if len(normal) < max(1, least):
            continue
        if ids and size + len(normal) > PASS_CHARS:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r["i"])
        texts.append(normal)
        size += len(normal)
    if ids:
        yield Items(ids, texts)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """The batch's texts (null: empty) in runs of about SLICE_CHARS characters, with each run's first row."""
    at, run, size = 0, [], 0
    for n, value in enumerate(batch.column(column)):
        text = value.as_py() or ""
        if run and size + len(text) > SLICE_CHARS:
            yield at, run
            at, run, size = n, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield at, run


MATCHES = "doc_id long, item_id long, edits int, start long, end long, normal_chars int"


def matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every region of a document's text within an item's edit budget: doc_id, item_id, edits, start and end (characters
    of the text itself), normal_chars (the item's size). Texts are read whole and never shuffled; the benchmark goes to
    the tasks in parts of bounded size. Null and empty texts hold nothing, null or empty items match nothing.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    out = spark.createDataFrame([], MATCHES)
    for n, items in enumerate(_passes(benchmark, "item_id", "text")):
        shared = spark.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                for at, texts in _slices(batch, 1):
                    found = []
                    for k, i, edits, start, end in hits(items, [normalise(t) for t in texts]):
                        place = places(texts[k])
                        found += [(batch.column(0)[at + k].as_py(), item, edits, int(place[start]), int(place[end - 1]) + 1, int(items.sizes[i])) for item in items.ids[i]]
                    if found:
                        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "edits", "start", "end", "normal_chars"])

        part = map_rows(rows, search, MATCHES)
        out = part if n == 0 else out.unionByName(part)
    return out


def clean(documents: DataFrame, benchmark: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The documents, all columns as they are, without those that hold a region within an item's budget.

    Items of fewer than least_chars normalised characters are passed over: a line like "Yes" stands in documents that
    know nothing of the benchmark. Null and empty texts and null ids stay; repeated rows stay or go together.
    """
    spark = documents.sparkSession
    ship(spark)
    names, text = documents.columns, documents.columns.index("text")
    out = documents
    for items in _passes(benchmark, "item_id", "text", least_chars):
        shared = spark.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for at, texts in _slices(batch, text):
                    good[[at + h[0] for h in hits(items, [normalise(t) for t in texts])]] = False
                yield batch.filter(pa.array(good))

        out = out.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(keep, documents.schema)
    return out


def op7_qgram_bands(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All benchmark passages in all documents, as matches() gives them: repeated documents and items each have their own
    rows, a null doc_id stays null, and an empty table on either side has no match."""
    return matches(documents, benchmark)
