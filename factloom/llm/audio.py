"""Texts as 8-bit audio: lossless WAV media, polyphase resampling, log-mel tensors and hysteresis energy segments."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import Run, map_rows, text_of

BLOCK = 192
RATE, UP, DOWN = 12_000, 2, 3
HEARD = RATE * UP // DOWN
FRAME, HOP, BANDS = 512, 256, 24
TENSOR = (32, BANDS)
#: Samples that are resampled at once, and frames that are transformed at once; neither changes a result.
CHUNK = BLOCK * 4096
FRAMES = 2048
#: Samples around a chunk that the resampler's taps reach, and more: a multiple of DOWN.
REACH = 16 * DOWN
ROWS_OUT = 256


def padded(data: bytes) -> bytes:
    """Spaces appended up to a positive multiple of BLOCK bytes."""
    return data + b" " * (-len(data) % BLOCK or (0 if data else BLOCK))


def wav(samples: bytes) -> bytes:
    """A RIFF/WAVE file of one channel of unsigned 8-bit samples."""
    form = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(samples))
    return b"RIFF" + struct.pack("<I", len(form) + len(samples)) + form + samples


def samples_of(media: bytes) -> bytes:
    """The samples of a file that wav() wrote, found by its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, kind = 12, None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            kind = struct.unpack_from("<HH", media, at + 8) + struct.unpack_from("<H", media, at + 22)
        if name == b"data":
            if kind != (1, 1, 8) or at + 8 + size > len(media):
                raise ValueError("not whole 8-bit mono samples")
            return media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


@cache
def _phases() -> list[np.ndarray]:
    """The resampler's low-pass (a Kaiser-windowed sinc cut at the lower of the two rates), split by phase."""
    half = 8 * max(UP, DOWN)
    t = np.arange(-half, half + 1)
    taps = np.sinc(t / max(UP, DOWN)) * np.kaiser(len(t), 6.0)
    taps *= UP / taps.sum()
    return [taps[p::UP].astype(np.float32) for p in range(UP)]


def resample(x: np.ndarray) -> np.ndarray:
    """x at RATE, a multiple of DOWN samples long, as UP / DOWN times as many at HEARD; each phase has its own taps.

    Beyond its ends x counts as 0. Output m is centred on the input's sample m * DOWN / UP.
    """
    half = 8 * max(UP, DOWN)
    n, out = len(x) // DOWN, np.empty(len(x) // DOWN * UP, dtype=np.float32)
    room = half // UP + 1
    wide = np.concatenate([np.zeros(room, np.float32), x, np.zeros(room + DOWN, np.float32)])
    for m in range(UP):
        at = m * DOWN + half
        taps, base = _phases()[at % UP], at // UP + room
        total = np.zeros(n, np.float32)
        for k, tap in enumerate(taps):
            first = base - k
            total += tap * wide[first : first + DOWN * n : DOWN][:n]
        out[m::UP] = total
    return out


@cache
def _mel() -> np.ndarray:
    """Triangular filters, evenly spaced on the mel scale, over the spectrum's bins."""
    to_mel, from_mel = (lambda f: 2595 * np.log10(1 + f / 700)), (lambda m: 700 * (10 ** (m / 2595) - 1))
    edges = from_mel(np.linspace(to_mel(40.0), to_mel(HEARD / 2), BANDS + 2))
    bins = np.arange(FRAME // 2 + 1) * HEARD / FRAME
    rise = (bins[:, None] - edges[None, :-2]) / (edges[1:-1] - edges[:-2])
    fall = (edges[None, 2:] - bins[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


@cache
def _window() -> np.ndarray:
    return np.hanning(FRAME + 1)[:-1].astype(np.float32)


def log_mel(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For overlapped frames: decibels in each band as whole numbers (int8), and the frame's level in decibels."""
    frames = max(1, -(-(len(y) - FRAME) // HOP) + 1)
    wide = np.zeros((frames - 1) * HOP + FRAME, np.float32)
    wide[: len(y)] = y
    cut = np.lib.stride_tricks.sliding_window_view(wide, FRAME)[::HOP]
    power = np.abs(np.fft.rfft(cut * _window(), axis=1).astype(np.complex64)) ** 2
    level = 10 * np.log10(1e-7 + np.einsum("ij,ij->i", cut, cut, dtype=np.float64) / FRAME)
    return np.clip(np.rint(10 * np.log10(1e-6 + power @ _mel())), -128, 127).astype(np.int8), level


def segments(level: np.ndarray, rise: float = 0.5, fall: float = -0.5) -> list[tuple[int, int]]:
    """Runs of frames that begin rise decibels above the median level and last until it is fall below it."""
    middle = np.median(level)
    event = np.where(level >= middle + rise, 1, np.where(level < middle + fall, -1, 0))
    last = np.maximum.accumulate(np.where(event != 0, np.arange(len(event)), -1))
    on = (last >= 0) & (event[np.maximum(last, 0)] == 1)
    edges = np.diff(np.r_[0, on.astype(np.int8), 0])
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))


def _heard(samples: bytes) -> Iterator[np.ndarray]:
    """The resampled signal in pieces: each chunk is resampled with its neighbours' samples around it, as the whole is."""
    for a in range(0, len(samples), CHUNK):
        b = min(len(samples), a + CHUNK)
        low, high = max(0, a - REACH), min(len(samples), b + REACH)
        x = (np.frombuffer(samples, np.uint8, high - low, low).astype(np.float32) - 128) / 128
        yield resample(x)[(a - low) * UP // DOWN : (b - low) * UP // DOWN]


def _frames(samples: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """log_mel() of the whole signal, FRAMES frames at a time; what a piece's last frames lack waits for the next piece."""
    held, done, need = np.empty(0, np.float32), 0, (FRAMES - 1) * HOP + FRAME
    for piece in _heard(samples):
        held = np.concatenate([held, piece])
        while len(held) >= need:
            yield log_mel(held[:need])
            held, done = held[FRAMES * HOP :], done + FRAMES
    if not done or len(held) > FRAME - HOP:
        yield log_mel(held)


def analyse(samples: bytes) -> tuple[np.ndarray, list[tuple[float, float]], list[tuple[float, float]]]:
    """(tensors of shape (n, *TENSOR), their time spans, the energy segments' time spans), seconds from the start.

    The signal is analysed as one, whatever its length: resampler, frames, median level and segments know no seams. Only
    CHUNK samples and FRAMES frames are worked on at once; what stays is the result and a level for each frame. The last
    tensor is filled up with -128.
    """
    parts = list(_frames(samples))
    bands, level = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    step, until = HOP / HEARD, len(samples) / RATE
    full = np.full((-(-len(bands) // TENSOR[0]) * TENSOR[0], BANDS), -128, np.int8)
    full[: len(bands)] = bands
    tensors = full.reshape(-1, *TENSOR)
    spans = [(i * TENSOR[0] * step, min(until, (i + 1) * TENSOR[0] * step)) for i in range(len(tensors))]
    return tensors, spans, [(a * step, min(until, b * step)) for a, b in segments(level)]


SPAN = pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())])
_MEDIA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])
_FEATURES = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("tensors", pa.binary()), ("segments", pa.list_(SPAN)), ("feature", pa.string())])
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, tensors binary, segments array<struct<start_s: double, end_s: double>>, feature string"


def media(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes (the text's UTF-8 bytes) and media (a WAV file of these bytes, padded) of every row."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_OUT):
                batch = whole.slice(at, ROWS_OUT)
                data = [t.encode() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in data], pa.int64()), pa.array([wav(padded(x)) for x in data], pa.binary())], schema=_MEDIA)

    return map_rows(documents.select(F.col("doc_id").cast("long"), text_of().alias("text")), store, "doc_id long, n_bytes long, media binary")


def features(stored: DataFrame) -> DataFrame:
    """Reads media() rows back: digests of payload and file, log-mel tensors with time spans, segments, and a summary.

    tensors is a stream in Arrow's own format, with a column tensor of Arrow's fixed-shape tensor type (TENSOR[0] frames
    of BANDS whole decibels, int8) and the columns start_s and end_s; to_arrow() opens it. feature names the tensors, the
    segments, each band's mean level and a checksum of the tensors.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_OUT):
                rows: dict[str, list] = {f.name: [] for f in _FEATURES}
                for doc_id, n_bytes, file in zip(*(whole.slice(at, ROWS_OUT).column(c).to_pylist() for c in ("doc_id", "n_bytes", "media")), strict=True):
                    payload = samples_of(file)
                    tensors, spans, parts = analyse(payload)
                    levels = tensors.reshape(-1, BANDS)
                    used = levels[levels[:, 0] > -128] if (levels[:, 0] > -128).any() else levels
                    feature = f"tensors={len(tensors)};segments={len(parts)};mel={','.join(str(int(m)) for m in used.sum(0, dtype=np.int64) // len(used))};crc={zlib.crc32(tensors.tobytes()):08x}"
                    values = (doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(file), hashlib.sha256(file).hexdigest(), _stream(tensors, spans), [{"start_s": a, "end_s": b} for a, b in parts], feature)
                    for name, value in zip(rows, values, strict=True):
                        rows[name].append(value)
                yield pa.RecordBatch.from_pydict(rows, schema=_FEATURES)

    return map_rows(stored.select("doc_id", "n_bytes", "media"), read, FEATURES)


def _stream(tensors: np.ndarray, spans: list[tuple[float, float]]) -> bytes:
    columns = {"tensor": pa.FixedShapeTensorArray.from_numpy_ndarray(tensors), "start_s": pa.array([a for a, _ in spans], pa.float64()), "end_s": pa.array([b for _, b in spans], pa.float64())}
    batch, out = pa.RecordBatch.from_pydict(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def to_arrow(tensors: bytes) -> pa.Table:
    """A row's tensors, of Arrow's fixed-shape type, with their time spans."""
    return pa.ipc.open_stream(tensors).read_all()


def op3_audio_features(documents: DataFrame) -> DataFrame:
    """The contract's digest of every text: stored as WAV files in a table, read back, analysed, and stored again.

    Null texts are empty, that is one block of spaces; repeated rows and null ids keep their rows; an empty table has
    none. Texts of any length are analysed whole.
    """
    run = Run(documents.sparkSession, "audio")
    heard = run.table("features", features(run.table("media", media(documents))))
    run.drop("media")
    return heard.drop("tensors", "segments")
