"""The corpus pipeline: quality classifier, exact dedup, near dedup, mixing, tokenisation.

Every stage works on all rows that the stage before it kept. A stage is given ``docs`` as a table on disk and
returns a DataFrame; all but the last return the columns of documents. ``run`` writes each stage's result
as Parquet in the shared folder (spark.checkpoint.dir) and reads it again as the next one's input, so a
lost executor costs a task, not a stage. ORACLE_SQL is None: the classifier is fitted, and SQL cannot express it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docloom.llm import exact, mixing, quality, sentpiece, simhash
from docloom.llm.common import cut, load

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores at 0.5 or more."""
    return quality.accepted(docs, load(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the row with the largest doc_id."""
    return exact.keep_largest(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8 or more."""
    return simhash.keep_one(docs, shingle=5, similarity=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens that are left, by the tree's weights, each document at most once."""
    return mixing.mix(docs, numerator=9, denominator=10, max_epochs=1)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids, decoded text and spans of every document."""
    return sentpiece.digests(docs, PIECE_MODEL)


STAGES = [("quality classifier", classify), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mixing", mix), ("tokenisation", tokenise)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, name.replace(" ", "-"))
    return docs
