"""Stages that turn raw documents into a clean, tokenized corpus; each works on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import byte_bpe, decontaminate, exact_dedup, language_id, ngram_join
from headway.llm._common import table
from headway.llm.queries import tokenizer
from headway.session import run_dir


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification: documents without a recognizable language (no letters, no text) go."""
    machines = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.predict(docs, machines, lang="_found", score="_score")
    return found.where(found["_found"] != language_id.UNKNOWN).select(*docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact copies: of equal texts the document with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies: of the documents that links tie together the one with the smallest doc_id stays."""
    return ngram_join.deduplicate(docs).select(*docs.columns)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each document's token ids and their number."""
    ranks, pattern = tokenizer()
    return byte_bpe.encode(docs, ranks, pattern, ids="ids", packed=False, release=True).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language ID", languages), ("exact dedup", copies), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", benchmarks), ("byte-level BPE", tokens),
]

#: Languages and similarity by shingles are beyond SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(path := run_dir(spark, "pipeline"))
            docs = spark.read.parquet(path)
    return docs
