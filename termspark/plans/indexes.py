"""Posting tables of the codelist, and the lookups on them.

They take the place of inverted indexes on the vectors, the code lists and the two text columns:
parquet tables clustered by key, so that a lookup skips all files without its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termspark import schemas as S
from termspark.functions import text as X
from termspark.operators import lookup
from termspark.plans.codelist import Codelist
from termspark.sources import tables

TEXTS = ("code", "description")


def trigram_rows(concepts: DataFrame) -> DataFrame:
    """(field, gram, code, n) of code and description, in one scan."""
    fields = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("_text")) for n in TEXTS])
    texts = concepts.select(F.col("code").alias("_code"), F.inline(fields))
    owner = F.struct("field", F.col("_code").alias("code")).alias("owner")
    grams = lookup.trigram_postings(texts.select(owner, "_text"), "owner", "_text")
    return grams.select("owner.field", "gram", "owner.code", "n")


def build_indexes(codelist: Codelist, managed: bool = True) -> None:
    """(Re)build the posting tables: the long vectors and lists themselves, clustered, and trigrams."""
    for name, rows, keys in (
        (S.LEXEME_INDEX, codelist.vectors, ["vector", "lexeme", "code"]),
        (S.CODE_INDEX, codelist.lists.filter(F.col("target").isNotNull()), ["source", "target", "code"]),
        (S.TRIGRAM_INDEX, trigram_rows(codelist.concepts), ["field", "gram", "code"]),
    ):
        tables.replace(lookup.clustered(rows, keys), name, managed)


def stored_codelist(spark: SparkSession) -> Codelist:
    """The codelist as it is stored."""
    return Codelist(spark.table(S.CODELIST_TABLE), spark.table(S.CODE_INDEX), spark.table(S.LEXEME_INDEX))


def search_text(
    spark: SparkSession,
    query: str,
    vector: str = "search",
    every: bool = True,
    weights: str | None = None,
    config: str = X.ENGLISH,
) -> DataFrame:
    """Codes whose vector holds all (or any) words of the query. A query of stop words finds nothing."""
    postings = spark.table(S.LEXEME_INDEX).filter(F.col("vector") == vector)
    lexemes = lookup.query_lexemes(spark, query, config)
    return lookup.match_lexemes(postings, lexemes, "code", every, weights)


def search_targets(spark: SparkSession, source: str, targets: list[str]) -> DataFrame:
    """Codes that map to any of the targets of a coding system."""
    return lookup.owners_of_codes(spark.table(S.CODE_INDEX), source, targets)


def search_similar(
    spark: SparkSession, query: str, field: str = "description", threshold: float = lookup.SIMILARITY_THRESHOLD
) -> DataFrame:
    """(code, sim) of the codes whose text is similar to the query."""
    postings = spark.table(S.TRIGRAM_INDEX).filter(F.col("field") == field)
    return lookup.similar_owners(postings, query, "code", threshold)
