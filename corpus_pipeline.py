"""Corpus pipeline: drop toxic documents, keep one of each near-duplicate group, drop documents that hold benchmark
passages, mix the sources to their weights and write the token ids. Every stage reads what the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import decontamination, mixing, near_dedup, token_output, toxicity
from lakeloom.llm.common import shared_dir

VOCABULARY, END_ID = "word_bpe_49k.json", 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.7. The model is fitted on the labelled documents of the stage's input."""
    return toxicity.keep_clean(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return near_dedup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontamination.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or parts of them, as often as the mix draws them."""
    return mixing.mixed_documents(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, written in the library's format and read back: doc_id, start, n_tokens, ids_crc32."""
    path = shared_dir(spark, "pipeline-tokens")
    token_output.write_tokens(docs, path, public_tokenizers.path(VOCABULARY), END_ID)
    return token_output.token_digest(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_ids),
]

#: SQL can express neither the trained model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; the last one's rows."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
