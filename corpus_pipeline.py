"""The corpus pipeline: documents to packed sequences, in five stages.

A stage takes (spark, docs, sf_dir), works on all documents that its predecessor
kept and returns the kept ones with the columns of `documents`; the last one
returns the pieces of sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import decontam, exactdup, neardup, packing, queries, toxicity
from siltworks.llm.common import read, stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the lexicon, learned from labels outside the held-out fifth, scores 0.5 or more. Null and empty texts score as clean and stay; without labels all stay."""
    return toxicity.drop_toxic(docs, queries.fitted_lexicon(spark, docs, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty) the row with the largest doc_id stays; of rows that repeat id and text, one."""
    return exactdup.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8 of five-word shingles the smallest doc_id stays. Empty texts and rows without id are linked with nothing and stay."""
    return neardup.drop_near_duplicates(docs, percent=80, shingle=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item. Null and empty texts stay; with an empty benchmark all stay."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2,048 tokens; a null or empty text is one end token. An empty table gives no rows."""
    return packing.pack(packing.token_pieces(docs, queries.tokenizer_file()))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: Links of near copies and packing can't be stated in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
