"""Clean a corpus in five stages: each works on all that its predecessor kept, stored as Parquet.

Quality classifier, line dedup, n-gram Jaccard join, benchmark decontamination, word BPE. All stages but the last
return the columns of `documents`. Null texts count as empty; empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe_codec import encode_documents
from tidemark.llm.common import fresh_name, stored, table
from tidemark.llm.decontaminate import without_items
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.parity_join import one_of_each
from tidemark.llm.quality_gam import learn, without_rejected

#: A document stays unless it is more likely bad than good.
REJECT_BELOW = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    return without_rejected(docs, learn(docs, table(spark, sf_dir, "labels")), REJECT_BELOW)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts; a document that consists of such copies goes whole.

    `n_chars`, where there is one, follows the new text.
    """
    removed, left = fresh_name(docs, "lines_removed"), fresh_name(docs, "lines_left")
    found = dedup_lines(docs, whole=True).filter((F.col(removed) == 0) | (F.col(left) > 0))
    if "n_chars" in docs.columns:
        count = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that shared shingles link, the one of smallest id stays."""
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text of every document left."""
    return encode_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("encode", encode),
]

#: Boosting, similarity joins and merging by rank have no SQL form; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage but the last is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
