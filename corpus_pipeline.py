"""From raw documents to packed training sequences, one written table per stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.jaccard import similar_texts
from tidemark.llm.mixing import mix_sources
from tidemark.llm.packing import pack_documents
from tidemark.llm.substrings import drop_repeats
from tidemark.llm.toxicity import score_toxicity
from tidemark.operators.staging import remove, staging_path, staging_run

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _version() -> F.Column:
    return F.xxhash64("text").alias("version")


def _matched(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the columns of ``found``, by id and text; NULL matches NULL."""
    right = found.withColumnRenamed("doc_id", "found_id").withColumnRenamed("version", "found_version")
    left = docs.select(*COLUMNS, _version())
    return left.join(
        right, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("version") == F.col("found_version"))
    )


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of ``sf_dir``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, labels, carry=COLUMNS)
    return scored.filter("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts, once; texts without an id stay, once each."""
    rows = docs.select(*COLUMNS, F.md5("text").alias("k"))
    kept = similar_texts(docs, versions=True).filter("kept and doc_id is not null")
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("k").alias("kept_k")).distinct()
    same = (F.col("doc_id") == F.col("kept_id")) & F.col("k").eqNullSafe(F.col("kept_k"))
    some = rows.join(kept, same, "left_semi").union(rows.filter("doc_id is null"))
    return some.groupBy("doc_id", "k").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages that occur in an earlier one. ``n_chars`` follows the text.

    Passages are runs of sentences with 20 words at least, as in the operator's own query.
    """
    return drop_repeats(docs, carry=("lang", "source", "n_chars")).select(
        "doc_id",
        "text",
        "lang",
        "source",
        F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    copies = mix_sources(docs).groupBy("doc_id", "version").agg(F.max("copies").alias("copies"))
    taken = _matched(docs, copies.filter("copies > 0"))
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their token ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("mixing", mixing),
    ("packing", packing),
]

# No SQL states the classifier or the bin packing; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written and read again.

    What a stage staged is deleted once its result is written, and that result once the next one is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES:
        path = staging_path(spark, name)
        with staging_run(spark):
            result = step(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
