"""The corpus pipeline: stages that filter, dedup, decontaminate and pack the documents table.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the
columns of documents, whatever their names and whichever more there are, and keep or drop whole rows. An empty table
passes all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import decontam, minhash, packing, quality, toxicity
from factloom.llm.common import Run, read_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, learnt from the labels of docs, scores at the threshold or above.

    Null and empty texts are scored as empty ones, a null n_chars as a value of its own. Equal rows go or stay together; a
    score equal to the threshold stays. Without labels, or with one kind only, all score that kind's smoothed share.
    """
    machine = quality.fit(docs, read_table(spark, sf_dir, "labels"), quality.METADATA)
    return quality.score(docs, machine, quality.METADATA, keep=quality.THRESHOLD)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learnt from the labels of docs, scores below the threshold.

    Null and empty texts hold no word of it and score as a text without hits. Equal rows go or stay together; a score
    equal to the threshold goes. Without labels, or with one kind only, all score that kind's smoothed share.
    """
    lexicon = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon, below=toxicity.THRESHOLD)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component; rows with a null id stay.

    Null and blank texts are near nothing and stay. Rows that share an id are one document, so they go or stay together.
    """
    found = minhash.near_duplicates(docs)
    others = found.where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, exact or within its edit budget, as whole words.

    Passages of fewer than decontam.LEAST_CHARS normalised characters are passed over, as null and empty ones are. Null
    and empty texts and null ids stay; equal rows go or stay together; without passages all stay.
    """
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of at most 2048 tokens.

    Null and empty texts hold the end id alone; repeated rows and null ids have pieces of their own; which of equally long
    pieces comes first is left open, the number of sequences is not.
    """
    return packing.op2_vector_best_fit(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

#: Learnt scores, hash minima and token ids have no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last keeps is written to a table and read again. Then the tables that
    the stage worked with, and those of the stage before it, are dropped."""
    tables = Run(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        before = list(Run.opened)
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = tables.table(f"stage-{n}", docs)
            for run in [r for r in Run.opened if r not in before]:
                run.drop()
            if n:
                tables.drop(f"stage-{n - 1}")
    return docs
