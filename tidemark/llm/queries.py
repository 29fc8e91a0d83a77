"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.embeddings import near_embeddings
from tidemark.llm.jaccard import similar_texts
from tidemark.llm.language import identify_language
from tidemark.llm.lines import drop_common_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import score_quality
from tidemark.llm.repair import damage_rows, repair_plans, repair_report
from tidemark.llm.rules import quality_rules
from tidemark.llm.spelling import spelling_variants
from tidemark.llm.statements import OP3_SQL, OP11_SQL, OP12_SQL, OP13_SQL
from tidemark.llm.substrings import drop_repeats
from tidemark.llm.tokens import token_report
from tidemark.llm.toxicity import score_toxicity
from tidemark.operators.staging import stage


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix_sources(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeats(_table(spark, folder, "documents")).select("doc_id", "text", "n_sentences", "n_removed")


def op4_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return token_report(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return similar_texts(_table(spark, folder, "documents"))


def op6_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_embeddings(_table(spark, folder, "embeddings"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(_table(spark, folder, "documents"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify_language(_table(spark, folder, "documents"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(_table(spark, folder, "documents"))


def op12_lines(spark: SparkSession, folder: str) -> DataFrame:
    return drop_common_lines(_table(spark, folder, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = damage_rows(_table(spark, folder, "conversations"))
    return repair_report(rows, stage(repair_plans(rows), "plans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_mixing,
        op3_substrings,
        op4_tokens,
        op5_jaccard,
        op6_embeddings,
        op7_toxicity,
        op8_packing,
        op9_rules,
        op10_language,
        op11_spelling,
        op12_lines,
        op13_repair,
    )
}

SQL: dict[str, str] = {"op3_substrings": OP3_SQL, "op11_spelling": OP11_SQL, "op12_lines": OP12_SQL, "op13_repair": OP13_SQL}
