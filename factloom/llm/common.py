"""Plumbing that the operators share: run tables in the shared folder, code shipping, ranks without global sorts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
#: Rows and bytes in one batch that a Python worker gets, where the session has Spark's defaults: texts are large rows.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16777216b")}


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors once per application, so that Python workers can import it, and bound
    the batches that they get."""
    context = spark.sparkContext
    for name, (default, bounded) in BATCH_LIMITS.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, bounded)
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{top.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent).as_posix())
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. Where that is unset, a local session gets a
    temporary one, as in tests; on a cluster no folder of the driver's would do, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


class Run:
    """Names and writes the tables of one run of an operator, under one folder of its own in the shared folder.

    A written table cuts the lineage: what follows reads files that survive the loss of any executor. Operators drop the
    tables that their result does not read; those that it reads lazily stay until drop(). opened lists the runs not
    dropped yet, so that a caller which has stored a result can drop all that its operators left.
    """

    opened: list[Run] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        ship(spark)
        Run.opened.append(self)

    def table(self, name: str, df: DataFrame, codec: str = "zstd", **options: object) -> DataFrame:
        df.write.mode("overwrite").option("compression", codec).options(**options).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Removes the tables of these names; without names, the run's folder."""
        jvm = self.spark.sparkContext._jvm
        for place in [f"{self.path}/{n}" for n in names] or [self.path]:
            path = jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if not names and self in Run.opened:
            Run.opened.remove(self)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text with null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def unsigned_crc32(column: Column) -> Column:
    return F.crc32(column.cast("binary"))


def id_crc32(column: str = "doc_id") -> Column:
    """crc32 of an id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def batches_out(schema: pa.Schema, rows: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], type=f.type) if not isinstance(rows[f.name], pa.Array) else rows[f.name] for f in schema], schema=schema)


def running_count(values: np.ndarray, seen: dict) -> np.ndarray:
    """Each value's number of earlier occurrences, in this batch and, through seen, in those before it."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(values) else np.empty(0, int)
    sizes = np.diff(np.r_[first, len(values)])
    keys = ordered[first].tolist()
    base = np.array([seen.get(k, 0) for k in keys], dtype=np.int64)
    out = np.empty(len(values), dtype=np.int64)
    out[order] = np.arange(len(values)) - np.repeat(first - base, sizes)
    for k, b, n in zip(keys, base.tolist(), sizes.tolist(), strict=True):
        seen[k] = b + n
    return out


def with_task_ranks(df: DataFrame, key: str) -> DataFrame:
    """Adds part (the task) and nth (long: earlier rows of this task with the same integer key).

    To be written to a table at once: the two columns hold only together with the rows of that very task.
    """

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            nth = running_count(batch.column(key).to_numpy(zero_copy_only=False), seen)
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int32()), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "nth"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(ranks, f"{fields}, part int, nth long")


def global_ranks(written: DataFrame, key: str, rank: str) -> DataFrame:
    """Turns the part and nth of a written table into rank (long, gapless from 0 within each key).

    One row per key and task is counted with partial aggregation, summed up within each key, and joined back; no
    key's rows ever meet in one task, however hot the key is.
    """
    counts = written.groupBy(key, "part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(key, "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    joined = written.join(bases, [key, "part"])
    return joined.withColumn(rank, F.col("_base") + F.col("nth")).drop("_base", "nth", "part")


def map_rows(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
