"""The queries of this subpackage, by name, over the tables of a folder, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import audio, decontam, licenses, minhash, packing, quality, sharding, tokenbin, toxicity, warc
from factloom.llm.common import read_table


def op1_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.op1_minhash_components(read_table(spark, sf_dir, "documents"))


def op2_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op2_vector_best_fit(read_table(spark, sf_dir, "documents"))


def op3_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.op3_audio_features(read_table(spark, sf_dir, "documents"))


def op4_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op4_rendezvous_sharding(read_table(spark, sf_dir, "documents"))


def op5_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op5_factorisation_machine(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_transaction_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op6_transaction_assembly(read_table(spark, sf_dir, "pages"))


def op7_qgram_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op7_qgram_bands(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_mph_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.op8_mph_token_files(read_table(spark, sf_dir, "documents"))


def op10_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op10_sentence_rules(read_table(spark, sf_dir, "documents"))


def op9_weighted_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op9_weighted_lexicon(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_minhash_components, op2_vector_best_fit, op3_audio_features, op4_rendezvous_sharding, op5_factorisation_machine, op6_transaction_assembly, op7_qgram_bands, op8_mph_token_files, op9_weighted_lexicon, op10_sentence_rules)}

ORACLES: dict[str, str] = {"op1_minhash_components": minhash.ORACLE, "op6_transaction_assembly": warc.ORACLE, "op10_sentence_rules": licenses.oracle()}
