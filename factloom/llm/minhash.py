"""Near-duplicates: universal hash minima in bands, verification on whole shingle sets, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import Run, map_rows, text_of
from factloom.llm.mph import mix

WORDS = 5
SHARE = 75
BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
#: Least share of equal minima for which a pair's whole sets are compared in full(). At a similarity of 0.75 the share
#: of 128 minima falls below it with a probability of 0.2 in a million.
ALIKE = 0.54
#: Members to a side of a block; a member's copies in a bucket's blocks are one for each BLOCK others.
BLOCK = 2048
#: Shingles of all sets that one check of a block holds, unless a single pair has more.
HELD = 1 << 20
#: Links of one hub that are confirmed in one place.
HUB = 1024
SLICE_CHARS = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LONG_WORD = 64
_WORD_STEP, _SHINGLE_STEP = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def _universal() -> tuple[np.ndarray, np.ndarray]:
    """The factors (odd) and terms of MINIMA multiply-shift functions, drawn once from a fixed seed."""
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) << np.uint64(1) | np.uint64(1), rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64)


def _words(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words data[begins:ends], letter by letter over all words at once; longer ones by xxhash."""
    sizes = ends - begins
    order = np.argsort(-np.minimum(sizes, _LONG_WORD), kind="stable")
    at, left = begins[order], sizes[order]
    out = np.zeros(len(at), np.uint64)
    if not len(at):
        return out
    still = np.searchsorted(-left, -np.arange(min(int(left.max()), _LONG_WORD)), side="left")
    with np.errstate(over="ignore"):
        for k, n in enumerate(still.tolist()):
            out[:n] = out[:n] * _WORD_STEP + (data[at[:n] + k].astype(np.uint64) + np.uint64(1))
    for i in np.flatnonzero(left > _LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[at[i] : at[i] + left[i]].tobytes())
    hashes = np.empty_like(out)
    hashes[order] = out
    return mix(hashes, 1)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): text k's shingles, with repeats, are hashes[bounds[k]:bounds[k + 1]].

    Words are runs of bytes other than 9 to 13 and 32, A-Z lowered; a shingle is WORDS of them, or all of a shorter
    text. A text without words has none.
    """
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    data = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    space = _SPACE[data]
    begins = np.flatnonzero(~space & np.r_[True, space[:-1]])
    ends = np.flatnonzero(~space & np.r_[space[1:], True]) + 1
    hashes = _words(data, begins, ends)
    starts = np.r_[0, np.cumsum([len(c) + 1 for c in coded])]
    first = np.searchsorted(begins, starts)
    count = np.diff(first)
    sizes = np.where(count >= WORDS, count - WORDS + 1, (count > 0).astype(np.int64))
    bounds = np.r_[0, np.cumsum(sizes)]
    out, whole = np.empty(int(bounds[-1]), np.uint64), np.ones(int(bounds[-1]), bool)
    short = np.flatnonzero((count > 0) & (count < WORDS))
    with np.errstate(over="ignore"):
        for k in short.tolist():
            h = np.uint64(count[k])
            for w in hashes[first[k] : first[k + 1]]:
                h = h * _SHINGLE_STEP + w
            out[bounds[k]] = h
        whole[bounds[short]] = False
        if len(hashes) >= WORDS:
            owner = np.repeat(np.arange(len(texts)), count)
            n = len(hashes) - WORDS + 1
            h = hashes[:n].copy()
            for k in range(1, WORDS):
                h = h * _SHINGLE_STEP + hashes[k : k + n]
            out[whole] = h[owner[:n] == owner[WORDS - 1 :]]
    return mix(out, 2), bounds


def minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of MINIMA minima (uint32) for each of the parts of hashes that begin at starts, none of them empty."""
    out = np.empty((len(starts), MINIMA), np.uint32)
    with np.errstate(over="ignore"):
        for k, (a, b) in enumerate(zip(*_universal(), strict=True)):
            out[:, k] = np.minimum.reduceat(((hashes * a + b) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """doc_ids and texts of a batch, in runs of about SLICE_CHARS characters; a longer text is a run of its own."""
    ids, texts, size = [], [], 0
    for i, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        text = value.as_py()
        if texts and size + len(text) > SLICE_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(text)
        size += len(text)
    if texts:
        yield ids, texts


def signatures(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles (distinct), digest (of the sorted set; null if empty), bands (a key for the minima
    of each band, holding the band's number), sketch (a byte of each minimum)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _slices(batch):
                hashes, bounds = shingles(texts)
                sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                some = np.flatnonzero(np.diff(bounds))
                low = minima(hashes, bounds[some])
                keys = np.empty((len(some), BANDS), np.uint64)
                with np.errstate(over="ignore"):
                    for b in range(BANDS):
                        h = np.full(len(some), b, np.uint64)
                        for k in range(ROWS):
                            h = h * _SHINGLE_STEP + low[:, b * ROWS + k]
                        keys[:, b] = mix(h, 3)
                sketch = mix(low.reshape(-1).astype(np.uint64), 4).astype(np.uint8).reshape(low.shape)
                bands, sketches = [None] * len(ids), [None] * len(ids)
                for row, k in enumerate(some.tolist()):
                    bands[k], sketches[k] = keys[row].view(np.int64), sketch[row].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], names=["doc_id", "n_shingles", "digest", "bands", "sketch"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return map_rows(rows, sign, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary")


def shingle_sets(documents: DataFrame) -> DataFrame:
    """Per row with words: doc_id, digest and items (its set's hashes, sorted, as signed 64-bit integers)."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _slices(batch):
                hashes, bounds = shingles(texts)
                sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                kept = [(i, xxhash.xxh3_128_digest(s.tobytes()), s.view(np.int64)) for i, s in zip(ids, sets, strict=True) if len(s)]
                if kept:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), (pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True)], names=["doc_id", "digest", "items"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return map_rows(rows, collect, "doc_id long, digest binary, items array<long>")


def components(run: Run, edges: DataFrame, name: str, most: int = 60) -> DataFrame:
    """node and component (the smallest node reachable) for all nodes of edges (a, b), by large-star and small-star.

    Large-star links each node's greater neighbours to the least of its neighbours and itself; small-star links the
    lesser neighbours and the node itself to the least. Rounds alternate both until the links stay, as stars around
    the least nodes. Each round writes a table; minima are aggregated before they are joined back, so no neighbour
    list is ever gathered.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = run.table(f"{name}-0", edges)
    state = None
    for step in range(1, most + 1):
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if (seen["n"], seen["h"]) == state or not seen["n"]:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        state = seen["n"], seen["h"]
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = edges.join(least, edges.lo == least.u).select("hi", F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        pairs = F.explode(F.array(F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo"))))
        small = large.join(least, "hi").select(pairs.alias("p")).select("p.hi", "p.lo").where("hi <> lo").distinct()
        edges = run.table(f"{name}-{step}", small)
        run.drop(f"{name}-{step - 1}")
    raise RuntimeError(f"components did not settle in {most} rounds")


def _linked(pairs: DataFrame, sets: DataFrame, hub: int = HUB) -> DataFrame:
    """The pairs (a, b) whose whole sets share SHARE percent of their union. The pairs of an a that has more than hub of
    them are spread over as many places as that takes, each with a copy of its set."""
    spread = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hub).select("a", F.ceil(F.col("n") / hub).cast("int").alias("places"))
    salted = pairs.join(spread, "a", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("places")).cast("int"), F.lit(0)).alias("salt"))
    one, two = (sets.select(F.col("doc_id").alias(c), F.col("items").alias(f"_{c}")) for c in "ab")
    copies = one.join(spread, "a", "left").select("a", "_a", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("places"), F.lit(1)) - 1)).alias("salt"))
    joined = salted.join(two, "b").join(copies, ["a", "salt"])
    common = F.size(F.array_intersect("_a", "_b"))
    return joined.where(100 * common >= SHARE * (F.size("_a") + F.size("_b") - common)).select("a", "b")


_TRIED = "block long, run int, a long, partners array<long>"


def _block_tries(rows: pa.Table, held: int = HELD) -> list[tuple[int, int | None, np.ndarray]]:
    """For a block of one bucket: its remaining members with the others whose sketch and size allow a link, in runs.

    Pairs of one component are left out, and pairs that an earlier band holds too, since that band's bucket has them. A
    run's sets have held shingles together, or it is one pair; its last entry, without a member of its own, lists all
    that the run needs, each once.
    """
    ids, parts, sizes, rest, other = (rows.column(c).to_numpy() for c in ("a", "component", "n_shingles", "rest", "member"))
    if not rest.any() or len(rows) < 2:
        return []
    band = rows.column("band")[0].as_py()
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(len(rows), MINIMA)
    earlier = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(rows), BANDS)[:, :band]
    members = np.flatnonzero(other)
    out: list[tuple[int, int | None, np.ndarray]] = []
    run, needed, size = 0, {}, 0

    def closed() -> tuple[int, None, np.ndarray]:
        return run, None, np.unique(np.fromiter(needed, np.int64, len(needed)))

    for i in np.flatnonzero(rest).tolist():
        may = members[(parts[members] != parts[i]) & (100 * np.minimum(sizes[members], sizes[i]) >= SHARE * np.maximum(sizes[members], sizes[i]))]
        may = may[(sketch[may] == sketch[i]).sum(1) >= ALIKE * MINIMA]
        may = may[~(earlier[may] == earlier[i]).any(1)]
        partners: list[int] = []
        for j in may.tolist():
            more = sum(int(sizes[k]) for k in {i, j} if int(ids[k]) not in needed)
            if needed and size + more > held:
                if partners:
                    out.append((run, int(ids[i]), np.unique(partners)))
                out.append(closed())
                run, needed, size, partners = run + 1, {}, 0, []
                more = int(sizes[i]) + int(sizes[j])
            size += more
            needed |= {int(ids[i]): None, int(ids[j]): None}
            partners.append(int(ids[j]))
        if partners:
            out.append((run, int(ids[i]), np.unique(partners)))
    if needed:
        out.append(closed())
    return out


def _tries(batches: Iterator[pa.RecordBatch], held_shingles: int = HELD) -> Iterator[pa.RecordBatch]:
    """The tries of each block, of rows sorted by block; a block that goes on in the next batch waits for it."""
    held: pa.Table | None = None

    def done(rows: pa.Table) -> pa.RecordBatch:
        blocks = rows.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
        out = [(int(blocks[a]), *t) for a, b in zip(cuts[:-1], cuts[1:], strict=True) for t in (_block_tries(rows.slice(a, b - a), held_shingles) if b > a else [])]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.list_(pa.int64()))], names=["block", "run", "a", "partners"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        blocks = rows.column("block").to_numpy()
        first = int(np.argmax(blocks == blocks[-1]))
        if first:
            yield done(rows.slice(0, first))
        held = rows.slice(first)
    if held is not None:
        yield done(held)


def _checks(tries: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """The links among a run's tries, on whole sets."""
    items, out = dict(zip(sets["doc_id"].tolist(), sets["items"], strict=True)), []
    for a, partners in zip(tries["a"].tolist(), tries["partners"], strict=True):
        one = items[a]
        for b in partners.tolist():
            two = items[b]
            common = len(np.intersect1d(one, two, assume_unique=True))
            if 100 * common >= SHARE * (len(one) + len(two) - common):
                out.append((a, b))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def full(run: Run, members: DataFrame, parts: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """The links that parts (node, component) does not know yet, between members (key, band, a) of one bucket.

    In each bucket all members outside its largest component are tried against all members of other components, in
    blocks of BLOCK by BLOCK, so that no bucket meets whole in one task; only links leave a block, not its pairs. A block
    holds sketches; whole sets meet in runs of HELD shingles.
    """
    of = F.coalesce(F.col("component"), F.col("a"))
    placed = members.join(parts.withColumnRenamed("node", "a"), "a", "left").select("key", "band", "a", of.alias("component"))
    counts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    keys = counts.groupBy("key").agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    keys = keys.select("key", F.col("top.component").alias("_top"), F.ceil(F.col("all") / BLOCK).cast("int").alias("_columns"), F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("_rows"))
    mixed = run.table("mixed", placed.join(keys, "key").withColumn("rest", F.col("component") != F.col("_top")))
    spread = lambda n, seed: F.pmod(F.xxhash64("a", F.lit(seed)), F.col(n)).cast("int")
    all_ = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    as_rest = mixed.where("rest").select("*", spread("_rows", 1).alias("_i"), all_("_columns").alias("_j"), F.lit(True).alias("is_rest"))
    as_member = mixed.select("*", spread("_columns", 2).alias("_j"), all_("_rows").alias("_i"), F.lit(False).alias("is_rest"))
    blocks = as_rest.unionByName(as_member).groupBy(F.xxhash64("key", "_i", "_j").alias("block"), "band", "a", "component").agg(F.max("is_rest").alias("rest"), F.max(~F.col("is_rest")).alias("member"))
    rows = blocks.join(signed.select(F.col("doc_id").alias("a"), "n_shingles", "sketch", "bands"), "a")
    held = HELD
    tries = run.table("tries", map_rows(rows.repartition("block").sortWithinPartitions("block"), lambda batches: _tries(batches, held), _TRIED))
    needed = tries.where("a is null").select(F.col("block").alias("of_block"), F.col("run").alias("of_run"), F.explode("partners").alias("doc_id")).join(sets.select("doc_id", "items"), "doc_id")
    return tries.where("a is not null").groupBy("block", "run").cogroup(needed.groupBy("of_block", "of_run")).applyInPandas(_checks, "a long, b long")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and kept (doc_id = component_id), by words of whole texts.

    1. Rows with equal sets are one class, under the smallest doc_id in it; only classes go on.
    2. A class meets others under the same minima in one of BANDS bands of ROWS. Two sets with a similarity of 0.75
       share no band with a probability of 5.2 in a million, and 4. passes over 0.2 in a million of those it tries; what
       is found is whole but for these.
    3. In each bucket the class with the most neighbours is linked to all others, each link confirmed on whole sets.
       Components come from these links, by large-star and small-star.
    4. Where a bucket still holds several components, full() tries what is left, and components are joined by it.

    Rows without words (null, empty or white-space texts) are linked with nothing. Rows with a null doc_id take part
    in no class of their own: they get the component of the class with their set, or null, and are not kept. Rows that
    share a doc_id are one document, so their sets' classes are one component.
    """
    run = Run(documents.sparkSession, "minhash")
    signed = run.table("signed", signatures(documents))
    classes = run.table("classes", signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep")).where("rep is not null"))
    heads = signed.join(classes, (signed.doc_id == classes.rep) & (signed.digest == classes.digest), "left_semi")
    heads = run.table("heads", heads.select("doc_id", "digest", "n_shingles", "sketch", "bands"), codec="uncompressed")
    banded = heads.select(F.col("doc_id").alias("a"), F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = run.table("members", banded.join(shared, "key").select("key", "band", "a", "size"))

    degrees = members.groupBy("a").agg(F.sum("size").alias("degree"))
    centres = members.join(degrees, "a").groupBy("key").agg(F.max(F.struct("degree", (-F.col("a")).alias("a"))).alias("top")).select("key", (-F.col("top.a")).alias("centre"))
    stars = members.join(centres, "key").where("a <> centre").select(F.col("centre").alias("a"), F.col("a").alias("b")).distinct()
    nodes = members.select(F.col("a").alias("doc_id")).distinct().join(heads.select("doc_id", "digest"), "doc_id")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(nodes.select("doc_id"), "doc_id", "left_semi")
    sets = run.table("sets", shingle_sets(texts).join(nodes, ["doc_id", "digest"], "left_semi"), codec="uncompressed")
    parts = components(run, _linked(stars, sets), "stars")

    more = run.table("more", full(run, members, parts, heads, sets))
    twice = signed.where("doc_id is not null and digest is not null").groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high").select("doc_id")
    same = signed.join(twice, "doc_id", "left_semi").join(classes, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    over = lambda c: F.coalesce(F.col(c), F.col(c[1:]))
    lifted = more.unionByName(same).join(parts.select(F.col("node").alias("a"), F.col("component").alias("_a")), "a", "left").join(parts.select(F.col("node").alias("b"), F.col("component").alias("_b")), "b", "left")
    joined = components(run, lifted.select(over("_a").alias("a"), over("_b").alias("b")), "joined")
    run.drop("members", "mixed", "tries", "sets", "heads", "more")
    first = classes.join(parts, classes.rep == parts.node, "left").select("digest", F.coalesce("component", "rep").alias("part"))
    named = first.join(joined, first.part == joined.node, "left").select("digest", F.coalesce("component", "part").alias("component_id"))
    found = signed.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def op1_minhash_components(documents: DataFrame) -> DataFrame:
    """The contract's rows, as near_duplicates() gives them."""
    return near_duplicates(documents)


#: All pairs that share a shingle, compared on whole sets, and what each document reaches; for tables of some thousand rows.
ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
u AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
ways AS (SELECT a AS x, b AS y FROM e UNION ALL SELECT b, a FROM e),
r(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, z.y FROM r JOIN ways z ON z.x = r.y)
SELECT x AS doc_id, any_value(n.n) AS n_shingles, min(y) AS component_id, x = min(y) AS kept FROM r JOIN n ON n.doc_id = x GROUP BY x"""
