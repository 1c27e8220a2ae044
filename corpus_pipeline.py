"""A training-corpus pipeline of five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the
shared folder and read again as the next stage's docs.  All but the last keep the columns of
``documents``.  Rows without a doc_id and repeated rows pass through each stage as its operator
defines; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ingot.llm import decontaminate as decontamination
from ingot.llm import mixing, neardup, tokens, toxicity
from ingot.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (5): documents with a score of 0.3 or more go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (8): of each group the document with the smallest doc_id stays."""
    return neardup.keep_one(docs, percent=85)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (1): documents that hold a benchmark window go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing (4): each row as often as its source's target takes it."""
    return mixing.resampled(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token output (3): a row per document, read back from the shard files."""
    return tokens.token_table(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_output", write_tokens),
]

#: The toxicity model, MinHash and the tokenizer have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
