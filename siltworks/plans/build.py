"""The corpus build: records from documents, guarded, deduplicated, split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions import prose
from siltworks.operators import dedup, guard, split


def document_records(docs: DataFrame) -> DataFrame:
    """(seq, group_id, source, text) of documents with text; secrets are redacted."""
    return docs.where(F.trim(F.coalesce("text", F.lit(""))) != "").select(F.col("doc_id").alias("seq"), F.concat_ws(":", F.lit("doc"), "doc_id").alias("group_id"), "source", prose.redact_secrets(F.col("text")).alias("text"))


def corpus(docs: DataFrame, benchmark: DataFrame, seed: int = 42) -> DataFrame:
    """Clean records with their split: guard (by containment), first-wins deduplication, hashed group split."""
    records = document_records(docs)
    blocked = guard.contains_prompt(records, benchmark.withColumnRenamed("text", "prompt_text"), "seq", "text", "prompt_text").select("seq")
    clean = guard.drop_groups(records, blocked, "seq", "group_id")
    unique = dedup.first_wins(clean, [F.sha2("text", 256)], ["seq"])
    return split.hashed_group_split(unique, "group_id", seed)


def summary(built: DataFrame) -> DataFrame:
    """Records and characters per split and source."""
    return built.groupBy("split", "source").agg(F.count("*").alias("records"), F.sum(F.length("text")).cast("long").alias("chars"))
