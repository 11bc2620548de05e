"""The corpus pipeline: from raw documents to token ids, each stage written and read again.

Quality rules reject documents, exact and near duplicates leave one document of each group, the
sources are mixed to their target weights (a document may then stand several times), and every
text becomes ids, with the digest of what they decode to. What a stage has landed on the way is deleted
when a later one begins, so its result has to be stored by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgeledger.llm import block_names, byte_bpe, decision_list, minhash, poisson_mix
from edgeledger.llm.common import documents, labels, land, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base conditions nor a learned rule rejects."""
    with stage(spark, docs):
        return decision_list.keep_good(docs, labels(spark, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of each group of equal texts."""
    with stage(spark, docs):
        return block_names.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group: shingles of five words, similarity 0.8 or more."""
    with stage(spark, docs):
        return minhash.deduplicate(docs, words=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many documents as before, drawn so that large sources weigh less than by their size."""
    with stage(spark, docs):
        mixture, copy = poisson_mix.mixed(docs)
        return mixture.drop(copy)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every document of the mixture."""
    with stage(spark, docs):
        return byte_bpe.token_rows(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("byte_bpe", token_ids),
]

#: The rules are learned, which SQL cannot express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, apply in STAGES[:-1]:
        result = apply(spark, docs, sf_dir)
        with stage(spark, result):
            docs = land(result, f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
