"""External services behind plain functions: fetching, liveness, layout analysis and language models.

Each is a callable that the caller passes in, run in the tasks with bounded retries. A failure is a row with its
status and error, never a failed job. Tests pass stubs; captured tables stand for live services.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import values
from factloom.functions.expr import blank_to_null
from factloom.operators.facts import valid


class Unfit(ValueError):
    """A reply that does not hold what it should; the record keeps the reply."""

    def __init__(self, reply: str, problem: str):
        super().__init__(problem)
        self.reply = reply


def call(rows: DataFrame, key: str, inputs: list[str], service: Callable[..., str], attempts: int = 3, delay: float = 2.0, workers: int = 1, timeout: float | None = None) -> DataFrame:
    """key, result, status (success or failed), attempts, seconds, error of service(*inputs) for each row.

    An exception is tried again after delay times the number of the attempt, at most attempts times; an Unfit reply is
    the failed row's result. workers calls run at a time in a task; one that takes more than timeout seconds counts as
    failed, and its thread is left to itself.
    """
    kind = rows.schema[key].dataType.simpleString()

    def one(args: tuple) -> tuple:
        began, result, error, n = time.monotonic(), None, None, 0
        while n < attempts:
            n += 1
            try:
                result, error = service(*args), None
                break
            except Exception as e:  # the row records it
                error, result = f"{type(e).__name__}: {e}", getattr(e, "reply", None)
                if n < attempts:
                    time.sleep(delay * n)
        return result, "failed" if error else "success", n, time.monotonic() - began, error

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = ThreadPoolExecutor(workers) if workers > 1 or timeout else None
        for pdf in batches:
            args = [(k, tuple(a)) for k, *a in pdf[[key, *inputs]].itertuples(index=False)]
            if pool is None:
                out = [(k, *one(a)) for k, a in args]
            else:
                out = []
                for k, future in [(k, pool.submit(one, a)) for k, a in args]:
                    try:
                        out.append((k, *future.result(timeout)))
                    except Late:
                        out.append((k, None, "failed", 1, float(timeout or 0), f"TimeoutError: no answer in {timeout} seconds"))
            yield pd.DataFrame(out, columns=[key, "result", "status", "attempts", "seconds", "error"])
        if pool is not None:
            pool.shutdown(wait=False, cancel_futures=True)

    return rows.select(*dict.fromkeys([key, *inputs])).mapInPandas(run, f"`{key}` {kind}, result string, status string, attempts int, seconds double, error string")


def liveness(urls: DataFrame, head: Callable[[str], int], get: Callable[[str], int], workers: int = 20, timeout: float = 8.0) -> DataFrame:
    """url and alive of every distinct URL: whether head(url), a status, is below 400; after 403 or 405, which some servers
    answer to any such request, get(url) decides. An error or no answer in time is not alive."""

    def probe(url: str) -> str:
        status = head(url)
        return str(get(url) if status in (403, 405) else status)

    found = call(urls.select("url").distinct(), "url", ["url"], probe, 1, 0.0, workers, timeout)
    return found.select("url", F.coalesce((F.col("status") == "success") & (F.col("result").cast("int") < 400), F.lit(False)).alias("alive"))


#: Statuses after which a download is tried again.
RETRIED = (429, 500, 502, 503, 504)


def downloaded(urls: DataFrame, get: Callable[[str], tuple[int, bytes, str | None]], attempts: int = 3, delay: float = 1.0, workers: int = 20, timeout: float = 60.0) -> DataFrame:
    """url, result (the page's text), status, attempts, seconds, error of every distinct URL.

    get gives a status, the bytes and the encoding, if it is told. RETRIED statuses and errors are tried again; any other
    status of 400 or more fails at once. Without an encoding the bytes are read as UTF-8, else as Latin-1.
    """

    def page(url: str) -> str:
        for n in range(1, attempts + 1):
            try:
                status, content, encoding = get(url)
            except Exception:
                if n == attempts:
                    raise
            else:
                if status < 400:
                    break
                if status not in RETRIED or n == attempts:
                    raise OSError(f"status {status}")
            time.sleep(delay * n)
        try:
            return content.decode(encoding or "utf-8")
        except (UnicodeDecodeError, LookupError):
            return content.decode("latin-1")

    return call(urls.select("url").distinct(), "url", ["url"], page, 1, 0.0, workers, timeout)


def fetched(urls: DataFrame, fetch: Callable[[str], str], done: DataFrame | None = None) -> DataFrame:
    """url, result and status of all URLs that done, a table of earlier results, does not hold."""
    todo = urls.select("url").distinct()
    return call(todo.join(done.select("url"), "url", "left_anti") if done is not None else todo, "url", ["url"], fetch)


def extracted(chunks: DataFrame, model: Callable[[str], str], attempts: int = 3, delay: float = 0.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts, calls, rejects): the valid facts that a model's replies hold, the record of every call with its whole reply,
    and the entries that are no valid facts, with their problem.

    A reply is the first JSON object in it, with a list facts, or a list; one without, or with an empty list for a chunk
    that is not blank, is a failed attempt. Chunks (chunk_id, content) without content are not asked about: they are failed
    calls with no attempt.
    """

    def checked(content: str) -> str:
        reply = model(content)
        try:
            bare = reply.strip()
            found = json.loads(bare if bare.startswith("[") else values.balanced_object(reply) or reply)
            found = found if isinstance(found, list) else found["facts"]
        except (ValueError, KeyError, TypeError) as e:
            raise Unfit(reply, f"{type(e).__name__}: {e}") from None
        if not isinstance(found, list):
            raise Unfit(reply, "facts is no list")
        if not found:
            raise Unfit(reply, "no facts for a chunk with content")
        return json.dumps({"reply": reply, "facts": [json.dumps(f, ensure_ascii=False) for f in found]}, ensure_ascii=False)

    filled = blank_to_null(F.col("content")).isNotNull()
    asked = call(chunks.where(filled), "chunk_id", ["content"], checked, attempts, delay)
    good = F.col("status") == "success"
    reply = F.when(good, F.get_json_object("result", "$.reply")).otherwise(F.col("result"))
    blank = chunks.where(~filled).select("chunk_id", F.lit(None).cast("string").alias("reply"), F.lit("failed").alias("status"), F.lit(0).alias("attempts"), F.lit(0.0).alias("seconds"), F.lit("chunk without content").alias("error"))
    calls = asked.select("chunk_id", reply.alias("reply"), "status", "attempts", "seconds", "error").unionByName(blank)
    entries = F.from_json(F.get_json_object("result", "$.facts"), "array<string>")
    rows = asked.where(good).select("chunk_id", F.posexplode(entries).alias("pos", "entry"))
    kind = "struct<category: string, field: string, value: string, confidence: double>"
    rows = rows.withColumn("f", F.when(F.col("entry").startswith("{"), F.from_json("entry", kind)))
    category, field = blank_to_null(F.col("f.category")), blank_to_null(F.col("f.field"))
    problem = F.when(~F.col("entry").startswith("{"), "no object").when(category.isNull(), "category").when(field.isNull(), "field").when(F.col("f.value").isNull(), "value")
    rows = rows.withColumn("problem", problem)
    facts = rows.where("problem is null").select("chunk_id", "pos", "f.*")
    return facts.where(valid(F.col("category"), F.col("field"), F.col("value"))), calls, rows.where("problem is not null").select("chunk_id", "pos", "entry", "problem")
