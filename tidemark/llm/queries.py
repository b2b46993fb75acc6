"""The registered queries of the operators, with production parameters over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe_codec import encode_documents
from tidemark.llm import collocations as phrases
from tidemark.llm.common import table
from tidemark.llm.decontaminate import contaminated_pairs
from tidemark.llm.license_scan import scan_licenses
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.parity_join import jaccard_components
from tidemark.llm.piece_codec import encode_pieces
from tidemark.llm.quality_gam import score_quality
from tidemark.llm.sentence_dedup import LONGEST, dedup_sentences
from tidemark.llm.sharding import shard_rows
from tidemark.llm.spelling import group_spellings
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.vector_search import nearest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return keep


@query("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_quality_gam")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), 0.7)


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=1024)


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op5_sentence_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_sentences(table(spark, sf_dir, "documents").select("doc_id", "text"), longest=LONGEST)


@query("op6_feistel_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), 24)


@query("op7_bpe_codec")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op8_line_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), whole=True)


@query("op9_vector_search")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query("op10_parity_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op11_spelling_groups")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(table(spark, sf_dir, "documents"))


@query("op12_piece_codec")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op13_collocations", phrases.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
