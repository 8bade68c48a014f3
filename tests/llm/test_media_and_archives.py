import base64
import gzip
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import audio, warc


@settings(max_examples=50, deadline=None)
@given(st.binary(max_size=2000))
def test_payload_round_trip(data):
    payload = audio.padded(data)
    assert len(payload) % 192 == 0 and len(payload) >= 192 and payload.rstrip(b" ") == data.rstrip(b" ")
    assert audio.samples_of(audio.wav(payload)) == payload


def test_damaged_files_are_told():
    with pytest.raises(ValueError):
        audio.samples_of(b"RIFF")
    with pytest.raises(ValueError):
        audio.samples_of(audio.wav(bytes(192))[:-1])


def test_resampling_keeps_a_tone():
    t = np.arange(192 * 100)
    x = np.sin(2 * np.pi * 600 * t / audio.RATE).astype(np.float32)
    y = audio.resample(x)
    assert len(y) == len(x) * audio.UP // audio.DOWN
    want = np.sin(2 * np.pi * 600 * np.arange(len(y)) / audio.HEARD)
    assert np.abs(y[100:-100] - want[100:-100]).max() < 0.01
    high = np.sin(2 * np.pi * 5800 * t / audio.RATE).astype(np.float32)
    assert np.abs(audio.resample(high)[100:-100]).max() < 0.1


def test_hysteresis():
    level = np.array([0.0, 0, 0, 3, 0.2, 0.2, -3, 0.2, 0, 3])
    assert audio.segments(level) == [(3, 6), (9, 10)]


def test_odd_rows_as_audio(odd, odd_rows):
    got = audio.op3_audio_features(odd).collect()
    want = Counter()
    for r in odd_rows:
        data = (r[1] or "").encode()
        payload = audio.padded(data)
        want[(r[0], len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(payload) + 44, hashlib.sha256(audio.wav(payload)).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"], r["media_sha256"]) for r in got) == want
    features = {}
    for r in got:
        assert features.setdefault(r["payload_sha256"], r["feature"]) == r["feature"]


def test_tensors_have_a_fixed_shape_and_time_spans(odd):
    row = audio.features(audio.media(odd.where("doc_id = 7"))).first()
    table = audio.to_arrow(bytes(row["tensors"]))
    kind = table.schema.field("tensor").type
    assert kind.extension_name == "arrow.fixed_shape_tensor" and kind.shape == list(audio.TENSOR) and table.num_rows > 1
    spans = table.select(["start_s", "end_s"]).to_pylist()
    assert all(a["start_s"] < a["end_s"] for a in spans)
    assert abs(spans[-1]["end_s"] - row["payload_bytes"] / audio.RATE) < 1e-6


def plainly(payload):
    """Frames' band levels and segments by the definitions: an upsampled convolution, a loop over frames, a loop over levels."""
    x = (np.frombuffer(payload, np.uint8).astype(float) - 128) / 128
    half = 8 * max(audio.UP, audio.DOWN)
    t = np.arange(-half, half + 1) / max(audio.UP, audio.DOWN)
    taps = np.sinc(t) * np.kaiser(len(t), 6.0)
    up = np.zeros(len(x) * audio.UP)
    up[:: audio.UP] = x
    y = np.convolve(up, taps * audio.UP / taps.sum())[half : half + len(up)][:: audio.DOWN]
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(40), mel(audio.HEARD / 2), audio.BANDS + 2) / 2595) - 1)
    weights = [np.array([max(0.0, min((f - low) / (middle - low), (high - f) / (high - middle))) for f in np.arange(audio.FRAME // 2 + 1) * audio.HEARD / audio.FRAME]) for low, middle, high in zip(edges, edges[1:], edges[2:], strict=False)]
    bands, levels, at = [], [], 0
    while not at or at + audio.FRAME - audio.HOP < len(y):
        frame = np.zeros(audio.FRAME)
        frame[: len(y[at : at + audio.FRAME])] = y[at : at + audio.FRAME]
        levels.append(10 * np.log10(1e-7 + np.mean(frame**2)))
        power = np.abs(np.fft.rfft(frame * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(audio.FRAME) / audio.FRAME)))) ** 2
        bands.append([10 * np.log10(1e-6 + power @ w) for w in weights])
        at += audio.HOP
    middle, on, runs = np.median(levels), False, []
    for i, level in enumerate(levels):
        if not on and level >= middle + 0.5:
            on, begun = True, i
        elif on and level < middle - 0.5:
            on = False
            runs.append((begun, i))
    return np.array(bands), runs + ([(begun, len(levels))] if on else [])


def test_features_against_the_definitions(spark):
    rng = np.random.default_rng(3)
    texts = ["", "a", "word " * 900, "".join(map(chr, rng.integers(32, 127, 9000))), ("loud ÿÿÿ~~~ " * 60 + "      " * 200) * 4]
    rows = audio.features(audio.media(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    for r in rows:
        payload = audio.padded(texts[r["doc_id"]].encode())
        bands, runs = plainly(payload)
        got = audio.to_arrow(bytes(r["tensors"])).column("tensor").combine_chunks().to_numpy_ndarray().reshape(-1, audio.BANDS)
        assert (got[len(bands) :] == -128).all() and len(got) - len(bands) < audio.TENSOR[0]
        assert np.abs(got[: len(bands)] - bands).max() < 0.51
        step, end = audio.HOP / audio.HEARD, len(payload) / audio.RATE
        assert np.allclose([(s["start_s"], s["end_s"]) for s in r["segments"]], [(a * step, min(end, b * step)) for a, b in runs]) if runs else not r["segments"]
        used = got[: len(bands)].astype(int)
        assert r["feature"] == f"tensors={-(-len(bands) // 32)};segments={len(runs)};mel={','.join(str(m) for m in used.sum(0) // len(bands))};crc={zlib.crc32(got.tobytes()):08x}"


def test_long_texts_have_no_seams(monkeypatch):
    rng = np.random.default_rng(2)
    payload = audio.padded(rng.integers(32, 127, 1_500_000).astype(np.uint8).tobytes())
    want = audio.analyse(payload)
    for chunk in (192 * 37, 1 << 40):
        monkeypatch.setattr(audio, "CHUNK", chunk // 192 * 192)
        got = audio.analyse(payload)
        assert (got[0] == want[0]).all() and got[1:] == want[1:]
    bands, runs = plainly(payload[: 192 * 4200])
    tensors, _, parts = audio.analyse(payload[: 192 * 4200])
    assert np.abs(tensors.reshape(-1, audio.BANDS)[: len(bands)] - bands).max() < 0.51 and len(parts) == len(runs)


PAGES = "page_id long, url string, html string, capture string, digest string, revisit boolean, row long"


def test_archives_of_odd_pages(spark):
    big = "x" * 300_000 + "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"
    rows = [(1, "http://a.example/x?y#z", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://a.example", None), (4, "bad\r\nurl", ""), (None, "http://b.example/", "<p>é</p>"), (5, "http://c.example/\r\nX: y", big), (6, "u", big), (6, "u", big), (1, "http://a.example/x?y#z", "<p>é</p>")]
    df = spark.createDataFrame([(*r, None, None, None, None) for r in rows], PAGES).repartition(3)
    got = Counter(tuple(r) for r in warc.op6_transaction_assembly(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    first = {}
    for i, _, h in rows:
        first[h or ""] = min(first.get(h or "", 10**9), i if i is not None else 10**9)
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        response = (i if i is not None else 10**9) == first[h or ""]
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if response else "revisit", None if response else first[h or ""])] += 1
    assert got == want


def test_captures_hold_the_whole_transaction(spark):
    df = spark.createDataFrame([(1, "http://a.example/x?y", "<p>é</p>", None, None, None, None)], PAGES)
    run = warc.Run(spark, "test-warc")
    warc.write(df, f"{run.path}/a")
    (row,) = warc.captures(warc.read(spark, f"{run.path}/a")).collect()
    assert row["response"]["payload"].decode() == "<p>é</p>" and row["response"]["target_uri"] == "http://a.example/x?y"
    assert len(row["requests"]) == len(row["metadata"]) == 1 and row["requests"][0]["fields"]["host"] == "a.example"
    run.drop()


def test_least_bytes_and_empty_table(spark):
    df = spark.createDataFrame([(i, "u", "ab", None, None, None, None) for i in (1, 2)], PAGES)
    assert {r["record_type"] for r in warc.op6_transaction_assembly(df, least=3).collect()} == {"response"}
    assert warc.op6_transaction_assembly(spark.createDataFrame([], PAGES)).count() == 0


def test_reader_takes_members_and_refuses_damage():
    record = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <x>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.records_of(gzip.compress(record) + gzip.compress(record))] == [b"abc", b"abc"]
    for damaged in (record[:-6], b"junk" + record):
        with pytest.raises(ValueError):
            list(warc.records_of(damaged))


def test_files_are_members_bounded_in_bytes(spark):
    import zlib as z
    from pathlib import Path

    rows = [(i, f"http://a.example/{i}", "same" if i % 3 == 0 else f"page {i} " * 50, None, None, None, None) for i in range(1, 400)]
    run = warc.Run(spark, "test-files")
    warc.write(spark.createDataFrame(rows, PAGES).repartition(2), f"{run.path}/a", file_bytes=20_000)
    files = [f.read_bytes() for f in Path(f"{run.path}/a").rglob("part-*")]
    assert len(files) > 2 and max(map(len, files)) < 22_000
    records = [r for f in files for r in warc.records_of(f)]
    assert len(records) == 3 * len(rows)
    for f in files:
        members, rest = 0, f
        while rest:
            one = z.decompressobj(31)
            whole = one.decompress(rest)
            assert whole.startswith(b"WARC/1.1") and whole.endswith(b"\r\n\r\n")
            rest, members = one.unused_data, members + 1
        assert gzip.decompress(f).count(b"WARC/1.1\r\nWARC-Type") == members
    by_id = {h["warc-record-id"]: (h, b) for h, b in records}
    assert len(by_id) == len(records)
    revisits = [h for h, _ in records if h["warc-type"] == "revisit"]
    assert len(revisits) == 132
    for h in revisits:
        first, block = by_id[h["warc-refers-to"]]
        assert first["warc-type"] == "response" and block.endswith(b"same") and first["warc-target-uri"] == h["warc-refers-to-target-uri"] == "http://a.example/3"
        assert first["warc-payload-digest"] == h["warc-payload-digest"] and h["warc-refers-to-date"] == first["warc-date"]
    run.drop()


def test_large_records_end_in_an_empty_member():
    import pyarrow as pa

    big = "WARC/1.1\r\nContent-Length: 17000000\r\n\r\n" + "x" * 17_000_000
    (file,) = warc._bundled(iter([pa.RecordBatch.from_arrays([pa.array([big])], names=["value"])]))
    (found,) = warc.records_of(file.column(0)[0].as_py() + b"\0")
    assert found[1] == b"x" * 17_000_000
    whole = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 50_000
    assert sum(1 for _ in warc.records_of(gzip.compress(whole))) == sum(1 for _ in warc.records_of(whole)) == 50_000
    with pytest.raises(ValueError):
        list(warc.records_of(gzip.compress(whole)[:-20]))
