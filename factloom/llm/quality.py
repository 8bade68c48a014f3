"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import id_crc32, map_rows, ship, text_of

WORD_BUCKETS = 1 << 16
STAT_BINS = 16
RANK = 8
#: At most so many labelled rows are learnt from, those whose hashed ids are smallest.
SAMPLE = 6000
SAMPLE_PARTS = 32

_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(65, 91)]] = 1
_KINDS[[*range(97, 123)]] = 2
_KINDS[[*range(48, 58)]] = 3
_KINDS[[9, 10, 11, 12, 13, 32]] = 4
_KINDS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 5
_KINDS[ord("|")] = 6
_KINDS[[ord(c) for c in ".,'-"]] = 7
STATS = 13


def _bin(share: float, scale: float = 1.0) -> int:
    """Bins of a share that are finer near 0: the bounds grow with the square."""
    return min(STAT_BINS - 1, int(STAT_BINS * math.sqrt(max(0.0, share / scale))))


def statistics(text: str, words: list[str], counts: Counter) -> list[int]:
    """The bins of STATS statistics of a whole text, its words and their counts."""
    kinds = np.bincount(_KINDS[np.frombuffer(text.encode(), np.uint8)], minlength=8)
    size, letters, n = max(1, int(kinds.sum())), max(1, int(kinds[0] + kinds[1] + kinds[2])), max(1, len(words))
    lines = text.split("\n")
    distinct = len(counts)
    return [
        _bin(kinds[1] / letters),
        _bin(kinds[3] / size, 0.5),
        _bin(kinds[5] / size, 0.5),
        _bin(kinds[6] / size, 0.25),
        _bin(kinds[7] / size, 0.25),
        _bin(kinds[0] / size, 0.5),
        _bin(sum(map(eq, words, words[1:])) / n),
        _bin(1 - distinct / n),
        _bin(max(counts.values(), default=0) / n),
        _bin(1 - len(set(lines)) / len(lines)),
        min(STAT_BINS - 1, int(math.log2(len(words) + 1))),
        min(STAT_BINS - 1, int(size / n / 1.5)),
        min(STAT_BINS - 1, int(math.log2(size / len(lines) + 1))),
    ]


def features(text: str, metadata: Sequence[object] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): each hashed word once, then a bin for each statistic and each metadata value.

    Word values are 1 + ln(count), scaled to one in length all together; the others are 1 each over their number's
    root. A null text is empty; null metadata is a value of its own; integers count by their power of two.
    """
    words = (text or "").lower().split()
    counts = Counter(words)
    buckets: dict[int, int] = {}
    for word, n in counts.items():
        b = zlib.crc32(word.encode()) % WORD_BUCKETS
        buckets[b] = buckets.get(b, 0) + n
    values = 1 + np.log(np.fromiter(buckets.values(), np.float64, len(buckets)))
    values /= max(1e-9, math.sqrt(float(values @ values)))
    others = [WORD_BUCKETS + STAT_BINS * k + b for k, b in enumerate(statistics(text or "", words, counts))]
    last = WORD_BUCKETS + STAT_BINS * STATS
    others += [last + 64 * k + (min(62, int(v).bit_length()) if isinstance(v, int) and not isinstance(v, bool) else 63 if v is None else zlib.crc32(str(v).encode()) % 63) for k, v in enumerate(metadata)]
    indices = np.concatenate([np.fromiter(buckets, np.int64, len(buckets)), np.array(others, np.int64)])
    return indices, np.concatenate([values, np.full(len(others), 1 / math.sqrt(len(others)))])


def width(metadata: int) -> int:
    return WORD_BUCKETS + STAT_BINS * STATS + 64 * metadata


class Machine:
    """A factorisation machine: bias + w.x + half of (|sum of x v|^2 - sum of |x v|^2), in time linear in x."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors
        self.squares = (factors**2).sum(1)

    def margin(self, indices: np.ndarray, values: np.ndarray) -> float:
        total = values @ self.factors[indices]
        return self.bias + float(values @ self.weights[indices]) + 0.5 * float(total @ total - (values**2) @ self.squares[indices])

    def score(self, indices: np.ndarray, values: np.ndarray) -> float:
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, self.margin(indices, values)))))

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, epochs: int = 12, rate: float = 0.25, decay: float = 1e-4, batch: int = 64, seed: int = 5) -> Machine:
        """Logistic loss, mini-batches, AdaGrad. With one label only (or none) the score is that label's share."""
        share = (float(labels.sum()) + 1) / (len(labels) + 2)
        bias, weights = math.log(share / (1 - share)), np.zeros(size)
        rng = np.random.default_rng(seed)
        factors = rng.normal(0, 0.02, (size, RANK))
        if len(set(labels.tolist())) < 2:
            return cls(bias, weights, np.zeros((size, RANK)))
        sum_b, sum_w, sum_v = 1e-6, np.full(size, 1e-6), np.full((size, RANK), 1e-6)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                sizes = np.array([len(rows[i][0]) for i in part])
                index, value = (np.concatenate([rows[i][k] for i in part]) for k in (0, 1))
                starts, owner = np.r_[0, np.cumsum(sizes)[:-1]], np.repeat(np.arange(len(part)), sizes)
                scaled = value[:, None] * factors[index]
                total = np.add.reduceat(scaled, starts)
                margin = bias + np.add.reduceat(value * weights[index], starts) + 0.5 * ((total**2).sum(1) - np.add.reduceat((scaled**2).sum(1), starts))
                error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[part]
                grad_b = float(error.mean())
                sum_b += grad_b**2
                bias -= rate * grad_b / math.sqrt(sum_b)
                each = error[owner] * value / len(part)
                slots, where = np.unique(index, return_inverse=True)
                grad_w = np.bincount(where, each, len(slots)) + decay * weights[slots]
                grad_v = each[:, None] * (total[owner] - scaled)
                grad_v = np.stack([np.bincount(where, grad_v[:, k], len(slots)) for k in range(RANK)], 1) + decay * factors[slots]
                sum_w[slots] += grad_w**2
                sum_v[slots] += grad_v**2
                weights[slots] -= rate * grad_w / np.sqrt(sum_w[slots])
                factors[slots] -= 0.2 * rate * grad_v / np.sqrt(sum_v[slots])
        return cls(bias, weights, factors)


def sample(documents: DataFrame, labels: DataFrame, label: str, modulus: int, keep: Sequence[int], most: int, columns: Sequence[str] = ()) -> DataFrame:
    """doc_id, text, _label and the named columns (as _m0, _m1, ...) of at most most labelled documents with
    crc32(id) mod modulus in keep, one row for each id.

    The sample is the labelled ids with the smallest hashes, so it is the same however the tables are split. These
    few rows go to the documents' tasks. Of an id's differing labels the least counts, of its rows the one whose text
    has the least hash; an id's rows are reduced to one where they are read, so repeated ids stay bounded too.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where((id_crc32() % modulus).isin(list(keep)))
    chosen = chosen.groupBy("doc_id").agg(F.min(label).cast("int").alias("_label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    names = [f"_m{i}" for i in range(len(columns))]
    rows = documents.select(F.col("doc_id").alias("doc_id"), text_of().alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)])
    one = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("_hash"), "text", *names, "_label")).alias("row"))
    one = one.select(F.col("doc_id").cast("long").alias("doc_id"), "row.text", "row._label", *[f"row.{n}" for n in names])
    return one.repartition(SAMPLE_PARTS, "doc_id")  # else so few rows would be one task


def fit(documents: DataFrame, labels: DataFrame, metadata: Sequence[str] = (), most: int = SAMPLE) -> Machine:
    """A machine for labels.quality, learnt from at most most rows whose crc32(doc_id as text) mod 5 is not 0."""
    names = [f"_m{i}" for i in range(len(metadata))]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t, m) for t, m in zip(batch.column(1).to_pylist(), _metadata(batch, names), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([i.astype(np.int32) for i, _ in rows], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in rows], pa.list_(pa.float32()))], names=["doc_id", "label", "i", "v"])

    chosen = sample(documents, labels, "quality", 5, (1, 2, 3, 4), most, metadata)
    got = map_rows(chosen, gather, "doc_id long, label int, i array<int>, v array<float>").toArrow().sort_by("doc_id")
    rows = [(i.values.to_numpy().astype(np.int64), v.values.to_numpy().astype(np.float64)) for i, v in zip(got.column("i"), got.column("v"), strict=True)]
    return Machine.fit(rows, got.column("label").to_numpy().astype(float), width(len(names)))


def _metadata(batch: pa.RecordBatch, names: Sequence[str]) -> list[tuple]:
    return list(zip(*(batch.column(n).to_pylist() for n in names), strict=True)) if names else [()] * batch.num_rows


def score(documents: DataFrame, machine: Machine, metadata: Sequence[str] = (), keep: float | None = None) -> DataFrame:
    """All documents with score added, in place of a column of that name; with keep, only the rows that score as much or
    more, their columns as they are."""
    spark, names = documents.sparkSession, list(metadata)
    documents = documents.drop("score") if keep is None else documents
    ship(spark)
    shared = spark.sparkContext.broadcast(machine)
    columns, text = documents.columns, documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            scores = np.array([machine.score(*features(t, m)) for t, m in zip(batch.column(text).to_pylist(), _metadata(batch, names), strict=True)], np.float64)
            if keep is None:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*columns, "score"])
            else:
                yield batch.filter(pa.array(scores >= keep))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(run, documents.schema if keep is not None else f"{fields}, score double")


METADATA = ("n_chars",)
THRESHOLD = 0.3


def op5_factorisation_machine(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """The contract's digest: every document's score. Null texts score as empty ones; repeated rows and rows with a null
    id keep their rows; an empty table has none; without labels, or with one kind only, all score the same."""
    machine = fit(documents, labels, METADATA, most)
    scored = score(documents.select("doc_id", "text", *METADATA), machine, METADATA)
    return scored.select("doc_id", (id_crc32() % 5 == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
