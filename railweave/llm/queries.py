"""Registered queries of the training-data operators, and SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import alignment, byte_bpe, chunk_dedup, fingerprint, hard_negatives, language, lm, minhash, neighbours, packing, sharding, substrings, warc
from ..session import scratch_path
from .common import table


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_documents(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op3_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.dedup_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op9_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_parsing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_rabit_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op13_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_kd_shards, op2_crf_language, op3_warc_chain, op4_bagminhash, op5_suffix_dedup, op6_nnls_packing, op7_byte_bpe, op8_hnsw, op9_deleted_interpolation, op10_parsing_fingerprints,
                                   op11_token_alignment, op12_rabit_negatives, op13_chunk_recipes)}
ORACLES: dict[str, str] = {"op3_warc_chain": warc.ORACLE, "op13_chunk_recipes": chunk_dedup.ORACLE}
