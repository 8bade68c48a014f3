"""Best-fit packing of token pieces into sequences under token, document and attention-cost capacities."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import Run, global_ranks, map_rows, running_count, text_of
from factloom.llm.tokens import encoder, tokenizer_path

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def pieces(documents: DataFrame, tokenizer: str, end_id: int, most: int, by_word: bool | None = None) -> DataFrame:
    """The documents' ids, each followed by end_id, cut into pieces of most ids where longer; the last may be shorter.

    part and nth (earlier pieces of this task of the same length) are for common.global_ranks, once written.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder, end, seen = TaskContext.get().partitionId(), encoder(tokenizer, by_word), struct.pack("<I", end_id), {}
        for batch in batches:
            rows = []
            for k, data in zip(batch.column(0).to_pylist(), coder.encode_many(batch.column(1).to_pylist()), strict=True):
                ids = memoryview(data + end)
                rows += [(k, n, at // 4, (len(x := ids[at : at + 4 * most])) // 4, zlib.crc32(x)) for n, at in enumerate(range(0, len(ids), 4 * most))]
            lengths = np.array([r[3] for r in rows], dtype=np.int64)
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.array(np.full(len(rows), part, np.int32)), pa.array(running_count(lengths, seen))], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return map_rows(documents.select(F.col("doc_id").cast("long"), text_of().alias("text")), cut, PIECE)


def best_fit(counts: dict[int, int], most_tokens: int, most_docs: int, most_cost: int, weights: Sequence[float] = (1.0, 1.0, 1.0), score: str = "norm") -> list[tuple[int, list[tuple[int, int]]]]:
    """Vector best fit, decreasing, of counts[length] pieces; returns (bins, [(length, pieces in each of them)]).

    A piece takes (length, 1, length squared) of a bin's residual (tokens, documents, attention cost); attention costs
    the square, since it stays within a piece. Longest pieces go first. Among the open bins where all three still fit,
    score "norm" takes the one with the least weighted norm of what remains, "dot" the one with the greatest weighted
    dot product of piece and residual, each measured in parts of the capacity; only if none fits, a new bin opens.

    Bins with one history are one state with a number of bins, pieces of one length are one class, and whole states
    take pieces at once, as placing them one by one would. A class splits at most two states, so there are at most
    about three times as many states as lengths, whatever the counts: the work does not grow with the corpus.
    """
    capacity = np.array([most_tokens, most_docs, most_cost], dtype=np.int64)
    weight = np.asarray(weights, dtype=float)
    if score not in ("norm", "dot"):
        raise ValueError(score)
    residual = np.empty((0, 3), dtype=np.int64)
    bins: list[int] = []
    held: list[list[tuple[int, int]]] = []
    done: list[tuple[int, list[tuple[int, int]]]] = []

    def opened(left: np.ndarray, n: int, pattern: list[tuple[int, int]]) -> None:
        nonlocal residual
        residual = np.vstack([residual, left])
        bins.append(n)
        held.append(pattern)

    def grown(pattern: list[tuple[int, int]], length: int, n: int) -> list[tuple[int, int]]:
        if pattern and pattern[-1][0] == length:
            return [*pattern[:-1], (length, pattern[-1][1] + n)]
        return [*pattern, (length, n)]

    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    for place, length in enumerate(lengths):
        item, count = np.array([length, 1, length * length], dtype=np.int64), counts[length]
        if (item > capacity).any():
            raise ValueError(f"a piece of {length} ids fits no sequence")
        while count:
            fits = np.flatnonzero((residual >= item).all(1) & (np.array(bins, dtype=np.int64) > 0)) if bins else []
            if not len(fits):
                most = int((capacity // item).min())
                if count >= most:
                    opened(capacity - most * item, count // most, [(length, most)])
                if rest := count % most:
                    opened(capacity - rest * item, 1, [(length, rest)])
                break
            left = residual[fits]
            if score == "norm":
                best = fits[np.argmin((weight * ((left - item) / capacity) ** 2).sum(1))]
                most = int((residual[best] // item).min())
            else:
                best = fits[np.argmax((weight * (left / capacity) * (item / capacity)).sum(1))]
                most = 1
            pattern, free = held[best], residual[best].copy()
            if full := min(bins[best], count // most):
                bins[best] -= full
                count -= full * most
                opened(free - most * item, full, grown(pattern, length, most))
            if bins[best] and 0 < count < most:
                bins[best] -= 1
                opened(free - count * item, 1, grown(pattern, length, count))
                count = 0
        shortest = lengths[-1]
        if place % 64 == 63:  # bins that no later piece fits are closed
            open_ = (residual >= np.array([shortest, 1, shortest * shortest])).all(1) & (np.array(bins) > 0)
            done += [(n, p) for n, p, o in zip(bins, held, open_, strict=True) if n and not o]
            residual, bins, held = residual[open_], [n for n, o in zip(bins, open_, strict=True) if o], [p for p, o in zip(held, open_, strict=True) if o]
    return done + [(n, p) for n, p in zip(bins, held, strict=True) if n]


def pack(written: DataFrame, most_tokens: int, most_docs: int, most_cost: int, weights: Sequence[float] = (1.0, 1.0, 1.0), score: str = "norm") -> DataFrame:
    """Adds sequence_id and offset (gapless from 0 in each sequence) to a written table of pieces().

    Only the number of pieces of each length (at most most_tokens numbers) reaches the driver; the patterns that
    best_fit makes of them go back to the tasks, where a piece's rank among those of its length gives its place.
    """
    counts = {r["length"]: r["n"] for r in written.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    used: dict[int, int] = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    for n, pattern in best_fit(counts, most_tokens, most_docs, most_cost, weights, score):
        at = 0
        for length, each in pattern:
            rows.append((length, used[length], sequence, each, at))
            used[length] += n * each
            at += length * each
        sequence += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    shared = written.sparkSession.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        firsts, groups = {}, np.flatnonzero(np.r_[True, table[1:, 0] != table[:-1, 0]]) if len(table) else []
        for a, b in zip(groups, [*groups[1:], len(table)], strict=True):
            firsts[int(table[a, 0])] = (a, b)
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            order, row = np.argsort(length, kind="stable"), np.empty(len(length), np.int64)
            cuts = np.flatnonzero(np.r_[True, np.diff(length[order]) != 0]) if len(order) else []
            for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
                lo, hi = firsts[int(length[order[a]])]
                row[order[a:b]] = lo + np.searchsorted(table[lo:hi, 1], rank[order[a:b]], side="right") - 1
            _, since, base, each, at = table[row].T if len(row) else np.empty((5, 0), np.int64)
            bin_, slot = np.divmod(rank - since, np.maximum(each, 1))
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(base + bin_, pa.int64()), pa.array(at + slot * length, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = global_ranks(written, "length", "rank").select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return map_rows(ranked, place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op2_vector_best_fit(documents: DataFrame, tokenizer: str | None = None, most_tokens: int = 2048, end_id: int = 0) -> DataFrame:
    """The contract's digest: every piece of every document, in as few sequences as vector best fit needs.

    The contract bounds tokens only, so the other two capacities are set where they never bind: as many documents as
    ids, and the cost of one whole-length piece. Null texts hold the end id alone; repeated and null ids keep their
    rows; an empty table has no sequence.
    """
    run = Run(documents.sparkSession, "packing")
    written = run.table("pieces", pieces(documents, tokenizer or tokenizer_path(), end_id, most_tokens))
    return pack(written, most_tokens, most_tokens, most_tokens**2)
