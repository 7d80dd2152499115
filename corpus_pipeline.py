"""Corpus pipeline: documents through the operators' stages, each written and read again.

Every stage takes all rows its predecessor kept.  Filtering stages keep rows
of unknown standing: a document leaves only if it is found toxic, or if it is
not the first of its near-duplicate group.  A document is an id and its text:
of rows that repeat both one stays, another text under the same id stays
unless it has a near duplicate itself.  Tables may have further columns of any
name; they are passed on.  An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estuary.llm import near_dedup, packing, pii, suffix_dedup, toxicity
from estuary.llm.common import stored, table

#: Shingle similarity of near duplicates, in percent; op4_minhash_dedup's own 85 is that query's.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; trained on the labels outside the held-out fold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, that of the smallest id; documents without words stay."""
    return near_dedup.keep_one(docs, NEAR_PERCENT)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a repeated passage covers; characters cut in part go whole."""
    return suffix_dedup.cut_texts(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data, and terms that disclose it, replaced by their kind."""
    return pii.sanitised(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their token ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
