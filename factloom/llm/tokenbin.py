"""Token-id files: raw id payloads, and a minimal perfect hash index from document keys to places in them."""

from __future__ import annotations

import struct
import zlib
from collections import OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import Run, map_rows, text_of
from factloom.llm.mph import Mph, fingerprints
from factloom.llm.tokens import encoder, tokenizer_path

#: A file's first and last bytes. The last one is 0, which the text writer puts there as its line end.
MAGIC, INDEX_MAGIC = b"FLTOK\x00\x02\x00", b"FLIDX\x00\x01\x00"
#: Magic, id width, documents, nulls, ids, part, segment, and a reserved 0.
HEAD = struct.Struct("<8s7Q")
INDEX_HEAD = struct.Struct("<8sQQ")
SEGMENT_TOKENS = 1 << 23
SEGMENT_DOCS = 1 << 17
#: Keys in one bucket of the index, about.
BUCKET_KEYS = 1 << 20
PLACES = "part int, segment int, ordinal int, key long, local long, n_tokens long, ids_crc32 long"


class Segment:
    """One file of ids: HEAD; the ids of all documents, in order, as unsigned little-endian numbers of width bytes, filled
    up to a multiple of 8 bytes; the keys (i64, nulls first and as 0); the documents' offsets among the ids (u64, one more
    than documents); MAGIC."""

    def __init__(self, data: bytes):
        magic, self.width, docs, self.nulls, tokens, self.part, self.number, _ = HEAD.unpack_from(data)
        at = keys_at(self.width, tokens)
        if magic != MAGIC or data[-8:] != MAGIC or len(data) != at + 16 * docs + 16:
            raise ValueError("not a whole file of ids")
        self.ids = np.frombuffer(data, f"<u{self.width}", tokens, HEAD.size)
        self.keys = np.frombuffer(data, "<i8", docs, at)
        self.offsets = np.frombuffer(data, "<u8", docs + 1, at + 8 * docs).astype(np.int64)

    @staticmethod
    def dumps(part: int, number: int, keys: list[int | None], ids: list[bytes], width: int) -> bytes:
        payload = b"".join(ids)
        if width == 2:
            payload = np.frombuffer(payload, "<u4").astype("<u2").tobytes()
        nulls, tokens = sum(k is None for k in keys), len(payload) // width
        ends = np.r_[0, np.cumsum([len(x) // 4 for x in ids])].astype("<u8")
        return b"".join([HEAD.pack(MAGIC, width, len(keys), nulls, tokens, part, number, 0), payload, bytes(-len(payload) % 8), np.array([k or 0 for k in keys], "<i8").tobytes(), ends.tobytes(), MAGIC])


def keys_at(width: int, tokens: int) -> int:
    return HEAD.size + -(-width * tokens // 8) * 8


class Bucket:
    """One file of the index: INDEX_HEAD with the number of keys and of all buckets; for each slot of the hash its key's
    fingerprint (u32) and place (5 u32: part, segment and ordinal of the key's first document, part and segment of its
    last); the hash; INDEX_MAGIC. A key that the files lack has a slot too, which its fingerprint, and then the key at
    that place, refuses."""

    def __init__(self, prints: np.ndarray, places: np.ndarray, mph: Mph):
        self.prints, self.places, self.mph = prints, places, mph

    @classmethod
    def build(cls, keys: np.ndarray, places: np.ndarray) -> Bucket:
        keys = np.ascontiguousarray(keys, "<i8").view(np.uint64)
        mph = Mph.build(keys)
        slots = mph.slots(keys)
        prints, placed = np.empty(len(keys), "<u4"), np.empty((len(keys), 5), "<u4")
        prints[slots], placed[slots] = fingerprints(keys), places
        return cls(prints, placed, mph)

    def dumps(self, buckets: int) -> bytes:
        return INDEX_HEAD.pack(INDEX_MAGIC, len(self.prints), buckets) + self.prints.tobytes() + self.places.tobytes() + self.mph.dumps() + INDEX_MAGIC

    @classmethod
    def loads(cls, data: bytes) -> Bucket:
        magic, n, _ = INDEX_HEAD.unpack_from(data)
        if magic != INDEX_MAGIC or data[-8:] != INDEX_MAGIC:
            raise ValueError("not a whole file of an index")
        at = INDEX_HEAD.size
        prints, places = np.frombuffer(data, "<u4", n, at), np.frombuffer(data, "<u4", 5 * n, at + 4 * n).reshape(n, 5)
        return cls(prints, places, Mph.loads(data, at + 24 * n)[0])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """A row of five numbers for each key; -1 where slot or fingerprint refuse it."""
        keys = np.ascontiguousarray(keys, "<i8").view(np.uint64)
        slots = self.mph.slots(keys)
        found = slots >= 0
        found[found] = self.prints[slots[found]] == fingerprints(keys[found])
        out = np.full((len(keys), 5), -1, np.int64)
        out[found] = self.places[slots[found]]
        return out


def bucket_of(key: int, buckets: int) -> int:
    """The bucket as Spark's pmod(xxhash64(key), buckets) gives it."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    return (h - (1 << 64) if h >> 63 else h) % buckets


def _raw(df: DataFrame, path: str, *by: str) -> None:
    """Writes the binary column value, each row as a file of its own. Spark's text writer commits the files and ends each
    by a 0, so the rows come without their last byte, which is 0."""
    df.select(*by, F.col("value").cast("string").alias("value")).write.partitionBy(*by).option("lineSep", "\x00").option("compression", "none").option("maxRecordsPerFile", 1).text(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.where("length > 0")


def write(documents: DataFrame, key: str, text: str, tokenizer: str, end_id: int, path: str, by_word: bool | None = None, segment_tokens: int = SEGMENT_TOKENS, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Writes the ids of all texts, in ascending order of the integer key, into files in path/ids, and their index into
    path/index-<buckets>; returns places(): a row for each document, as read back from the files.

    A file (Segment) holds whole documents, up to segment_tokens ids (one longer document fills one alone), as raw 16-bit
    ids where the vocabulary fits, else 32-bit ids. Ranges of keys go to tasks, so part and segment follow the key's
    order; rows of one key are told apart by their text's hash, so that many such rows still spread. Null keys come first
    and have no place in the index; null texts are empty and so hold the end id alone.

    The index is one minimal perfect hash over all distinct keys, cut by the keys' hash into buckets of about bucket_keys,
    a file for each. It is built from the files as read back; then each bucket is read back and asked for all its keys.
    """
    spark = documents.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder, end = TaskContext.get().partitionId(), encoder(tokenizer, by_word), struct.pack("<I", end_id)
        width = 2 if max(coder.vocab_size, end_id + 1) <= 1 << 16 else 4
        keys, ids, tokens, number = [], [], 0, 0
        file = lambda: pa.RecordBatch.from_arrays([pa.array([Segment.dumps(part, number, keys, ids, width)[:-1]], pa.binary())], names=["value"])
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), coder.encode_many(batch.column(1).to_pylist()), strict=True):
                data += end
                if keys and (tokens + len(data) // 4 > segment_tokens or len(keys) >= SEGMENT_DOCS):
                    yield file()
                    keys, ids, tokens, number = [], [], 0, number + 1
                keys.append(k)
                ids.append(data)
                tokens += len(data) // 4
        if keys:
            yield file()

    rows = documents.select(F.col(f"`{key}`").cast("long").alias("key"), text_of(f"`{text}`").alias("text"))
    order = ("key", F.xxhash64("text"))
    _raw(map_rows(rows.repartitionByRange(*order).sortWithinPartitions(*order), encode, "value binary"), f"{path}/ids")
    found = places(spark, path)
    found.write.parquet(f"{path}/places", compression="zstd")
    found = spark.read.schema(found.schema).parquet(f"{path}/places")
    _write_index(found, path, bucket_keys)
    return found


def places(spark: SparkSession, path: str) -> DataFrame:
    """Reads all files of ids: part, segment and ordinal of every document, its key, local (ids before it in its file),
    n_tokens and ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PLACES.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                s = Segment(content.as_py())
                ids, ends, n = memoryview(s.ids.astype("<u4").tobytes()), s.offsets, len(s.keys)
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                keys = pa.array(s.keys, pa.int64(), mask=np.arange(n) < s.nulls)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, s.part, np.int32)), pa.array(np.full(n, s.number, np.int32)), pa.array(np.arange(n, dtype=np.int32)), keys, pa.array(ends[:-1]), pa.array(np.diff(ends)), pa.array(crcs, pa.int64())], names=names)

    return map_rows(_stored(spark, f"{path}/ids").select("content"), read, PLACES)


def _write_index(found: DataFrame, path: str, bucket_keys: int) -> None:
    spark = found.sparkSession
    firsts = found.where("key is not null").groupBy("key").agg(F.min(F.struct("part", "segment", "ordinal")).alias("first"), F.max(F.struct("part", "segment")).alias("last"))
    n = found.where("key is not null").agg(F.approx_count_distinct("key").alias("n")).first()["n"]
    buckets = max(1, -(-n // bucket_keys))
    five = [F.col(c).cast("long").alias(f"p{i}") for i, c in enumerate(("first.part", "first.segment", "first.ordinal", "last.part", "last.segment"))]
    firsts = firsts.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"), "key", *five)
    names = [f"p{i}" for i in range(5)]

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        data = Bucket.build(keys["key"].to_numpy(), keys[names].to_numpy()).dumps(buckets)
        return pd.DataFrame({"bucket": [keys["bucket"].iloc[0]], "value": [data[:-1]]})

    def missed(keys: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
        wrong = len(keys)
        if len(files) == 1:
            wrong -= int((Bucket.loads(files["content"].iloc[0]).find(keys["key"].to_numpy()) == keys[names].to_numpy()).all(1).sum())
        return pd.DataFrame({"wrong": [wrong]})

    _raw(firsts.groupBy("bucket").applyInPandas(build, "bucket int, value binary"), f"{path}/index-{buckets}", "bucket")
    files = _stored(spark, f"{path}/index-{buckets}").select(F.regexp_extract("path", r"bucket=(\d+)", 1).cast("int").alias("bucket"), "content")
    wrong = firsts.groupBy("bucket").cogroup(files.groupBy("bucket")).applyInPandas(missed, "wrong long").agg(F.sum("wrong")).first()[0]
    if wrong:
        raise ValueError(f"the index misses {wrong} keys")


def documents_of(found: DataFrame) -> DataFrame:
    """One row per document of places(): key, start (ids of all documents before it), n_tokens, ids_crc32."""
    sizes = found.groupBy("part", "segment").agg(F.sum("n_tokens").alias("tokens"))
    earlier = lambda w: F.coalesce(F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row for each task that wrote: the only rows ordered in one place
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens")).select("part", earlier(Window.orderBy("part")).alias("before"))
    bases = sizes.select("part", "segment", earlier(Window.partitionBy("part").orderBy("segment")).alias("inside")).join(parts, "part").select("part", "segment", (F.col("before") + F.col("inside")).alias("base"))
    return found.join(bases, ["part", "segment"]).select("key", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


class Reader:
    """Keyed access to the files of write(): a key costs one bucket of the index (kept once read), and one file's head,
    two offsets and the ids themselves, whatever the number of documents.

    Opening lists the index folder's name and one file name. Works wherever Arrow reads the path.
    """

    def __init__(self, path: str, buckets_kept: int = 8):
        from pyarrow import fs

        self.files, self.root = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
        listed = self.files.get_file_info(fs.FileSelector(self.root))
        self.buckets = next(int(f.base_name.rpartition("-")[2]) for f in listed if f.base_name.startswith("index-"))
        names = sorted(f.path for f in self.files.get_file_info(fs.FileSelector(f"{self.root}/ids", allow_not_found=True)) if f.base_name.startswith("part-"))
        self.name = names[0].rpartition("/")[2].split("-", 2)[2].rpartition("-c")[0] if names else ""
        self.held: OrderedDict[int, Bucket | None] = OrderedDict()
        self.kept = buckets_kept

    def _bucket(self, number: int) -> Bucket | None:
        from pyarrow import fs

        if number not in self.held:
            folder = fs.FileSelector(f"{self.root}/index-{self.buckets}/bucket={number}", allow_not_found=True)
            names = [f.path for f in self.files.get_file_info(folder) if f.base_name.startswith("part-")]
            if len(self.held) >= self.kept:
                self.held.popitem(last=False)
            self.held[number] = Bucket.loads(self.files.open_input_file(names[0]).read()) if names else None
        self.held.move_to_end(number)
        return self.held[number]

    def _documents(self, key: int, part: int, segment: int, at: int) -> Iterator[np.ndarray]:
        """The ids of the documents from ordinal at on that have the key."""
        with self.files.open_input_file(f"{self.root}/ids/part-{part:05d}-{self.name}-c{segment:03d}.txt") as file:
            magic, width, docs, nulls, tokens, of, number, _ = HEAD.unpack(file.read_at(HEAD.size, 0))
            if magic != MAGIC or (of, number) != (part, segment):
                raise ValueError(f"part {part}, segment {segment} is damaged")
            begun = keys_at(width, tokens)
            while nulls <= at < docs and struct.unpack("<q", file.read_at(8, begun + 8 * at))[0] == key:
                a, b = struct.unpack("<2Q", file.read_at(16, begun + 8 * docs + 8 * at))
                yield np.frombuffer(file.read_at(width * (b - a), HEAD.size + width * a), f"<u{width}")
                at += 1

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of all documents with the key, in the files' order; none if there are none."""
        from pyarrow import fs

        bucket = self._bucket(bucket_of(key, self.buckets))
        place = bucket.find(np.array([key]))[0].tolist() if bucket else [-1]
        if place[0] < 0:
            return []
        first, at, last = (place[0], place[1]), place[2], (place[3], place[4])
        found = list(self._documents(key, *first, at))
        if found and first != last:  # one key's documents go on in other files: their names are listed
            names = [f.base_name for f in self.files.get_file_info(fs.FileSelector(f"{self.root}/ids")) if f.base_name.startswith("part-") and f.size]
            numbers = sorted((int(n.split("-")[1]), int(n.rpartition("-c")[2].split(".")[0])) for n in names)
            found += [ids for p in numbers if first < p <= last for ids in self._documents(key, *p, 0)]
        return found


def lookup(spark: SparkSession, path: str, keys: Iterable[int] | DataFrame) -> DataFrame:
    """The ids (array of int) of all documents with one of the keys (numbers, or the first column of a DataFrame), by a
    Reader in each task; keys that the files lack have no row."""
    if not isinstance(keys, DataFrame):
        keys = spark.createDataFrame([(int(k),) for k in sorted(set(keys))], "key long")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(path)
        for batch in batches:
            for key in batch.column(0).to_pylist():
                found = reader.get(key) if key is not None else []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(found), pa.int64()), pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))], names=["key", "ids"])

    first = keys.columns[0]
    return map_rows(keys.select(F.col(f"`{first}`").cast("long").alias("key")), fetch, "key long, ids array<int>")


def op8_mph_token_files(documents: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """The contract's digest: every document as read back from its files; repeated and null ids each keep their rows; an
    empty table has none."""
    run = Run(documents.sparkSession, "tokenbin")
    return documents_of(write(documents, "doc_id", "text", tokenizer or tokenizer_path(), end_id, run.path)).withColumnRenamed("key", "doc_id")
