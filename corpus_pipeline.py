"""The corpus pipeline: stages over documents, each written and read again by the next.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import bm25_packing, cross_parsing, feistel_pseudonyms, hyperminhash, suffix_decontamination
from tarmac.llm.queries import PSEUDONYM_KEY, VOCABULARY
from tarmac.llm.tables import staged, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; those without a letter go, and longer ones no language explains.

    With nothing labelled every text that has a letter stays.
    """
    return cross_parsing.keep_recognised(docs, cross_parsing.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id.

    Empty and null texts, and rows without an id, are linked with nothing and
    stay; rows that share an id are told apart by their texts.
    """
    return hyperminhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; all of them where the benchmark is empty."""
    # the executors' memory is full of other stages: smaller shards, the same rows
    return suffix_decontamination.remove_affected(docs, table(spark, sf_dir, "benchmark"), shard_words=300_000)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data pseudonymised; null and empty texts as they are."""
    return feistel_pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens; a null or empty text is its end id alone."""
    # the workers remember other stages, too
    return bm25_packing.pack(docs, public_tokenizers.path(VOCABULARY), end_id=2, remembered_words=250_000)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: Automata, sketches and packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
