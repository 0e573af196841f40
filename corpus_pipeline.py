"""A corpus from raw documents to packed token sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. ``run``
writes every stage below the shared folder and reads it again, so that a lost executor costs one
stage's work at most; a stage's table goes when the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termspark.llm import decontaminate, language, packing, similar
from termspark.llm.common import read_once
from termspark.llm.tokens import tokenizer_path
from termspark.session import drop_staged, tune

# Words in each generation of the packer's caches: its workers share an executor with a heap that the stages
# before have filled.
PACKING_WORDS = 50_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters or between languages go."""
    return language.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, Jaccard similarity of at least 0.8."""
    return similar.drop_similar(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_contamination(docs, benchmark, action="documents")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of up to 1024 ids."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), cached=PACKING_WORDS)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("benchmark_decontamination", remove_benchmark),
    ("packing", pack_sequences),
]

# language codes, XXH64 fingerprints and byte-pair ids are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs, read = tune(spark).read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, path = read_once(stage(spark, docs, sf_dir), name)
        if read:
            drop_staged(spark, read)
        read = path
    return STAGES[-1][1](spark, docs, sf_dir)
