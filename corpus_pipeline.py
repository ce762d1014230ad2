"""The corpus pipeline: five stages over the documents table, each reading what the one before it wrote.

Quality rules drop documents; line dedup takes cross-site boilerplate out of texts; SimHash near-dedup keeps one document of
each group; benchmark decontamination drops documents; SentencePiece gives the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import lines, quality, sentencepiece_bpe, simhash, wumanber
from tidemark.shared import dropped, dropped_since, mark, ship, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the fixed limits and the trees fitted on the labelled ones among them."""
    ship(spark)
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without cross-site lines; n_chars follows the text."""
    ship(spark)
    return lines.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked by five-word Jaccard similarities of 0.8 or more."""
    ship(spark)
    return simhash.keep_one_similar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without benchmark contamination."""
    ship(spark)
    return wumanber.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the token ids with an end id, and what they decode to."""
    ship(spark)
    return sentencepiece_bpe.encoded(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup), ("benchmark_decontamination", decontamination), ("sentencepiece", tokens)]
#: SQL can't express the trees, fingerprints and merges; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are written as Parquet and read again, and what it had written on the way is removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, since = docs, mark()
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
            dropped_since(spark, since, docs)
            dropped(before)
    return docs
