"""The subpackage's queries (opN_<name> and pipeline) and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import align, exact, mixing, mtree, packing, ppm, quality, secrets, sentpiece, simhash, spelling, suffix, tokenbin
from .common import load, spread

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")

ALPHABET = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, over all cores even where it is a single small file."""
    return spread(load(spark, sf_dir, "documents"), "doc_id")


def op1_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.component_ids(documents(spark, sf_dir))


def op2_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(documents(spark, sf_dir))


def op3_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(load(spark, sf_dir, "documents"))


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(documents(spark, sf_dir))


def op5_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(documents(spark, sf_dir), load(spark, sf_dir, "labels"))


def op6_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(load(spark, sf_dir, "embeddings"))


def op7_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.assign(load(spark, sf_dir, "documents"), 40)


def op8_seekable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.round_trip(load(spark, sf_dir, "documents"), WORD_MODEL)


def op9_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentpiece.digests(documents(spark, sf_dir), PIECE_MODEL)


def op11_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.report(documents(spark, sf_dir), load(spark, sf_dir, "benchmark"))


def op12_parity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op13_byte_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignments(documents(spark, sf_dir), BYTE_MODEL, PIECE_MODEL)


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_bktree, op2_crf_secrets, op3_hierarchical_mixing, op4_ppm, op5_factorisation_machine,
        op6_mtree, op7_vector_packing, op8_seekable_tokens, op9_chunk_recipes, op10_sentencepiece,
        op11_suffix_arrays, op12_parity_bands, op13_byte_labels,
    )
}

SQL = {
    "op3_hierarchical_mixing": mixing.sql(),
    "op6_mtree": mtree.SQL,
    "op9_chunk_recipes": f"""
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), {ALPHABET}) AS t FROM documents)
        WINDOW g AS (PARTITION BY t)""",
    "op11_suffix_arrays": suffix.SQL,
    "op12_parity_bands": spelling.SQL,
}
