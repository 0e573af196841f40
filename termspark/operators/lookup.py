"""Lookups: text match, code-list match and trigram similarity.

Each works on a posting table clustered by its key, so a lookup reads a few row groups instead of
every row. The same matches are offered as row-wise predicates for tables without postings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termspark.functions import text as X

# --- fixed value: documented default similarity threshold ---
SIMILARITY_THRESHOLD = 0.3


def clustered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows range-clustered by ``keys``, ready to be written as a posting table.

    Name the owner column last in ``keys``: a key held by a third of all rows is then cut into many
    files, each skipped or read by its min and max.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def query_lexemes(spark: SparkSession, query: str, config: str = X.ENGLISH) -> list[str]:
    """The lexemes of one query text; its size is that of the query."""
    lexemes = X.lexize(X.tokenize(F.lit(query)), config)
    row = spark.range(1).select(lexemes.alias("lexemes")).first()
    return sorted({x for x in row["lexemes"] if x is not None})


def match_lexemes(
    postings: DataFrame,
    lexemes: list[str],
    owner: str = "code",
    every: bool = True,
    weights: str | None = None,
) -> DataFrame:
    """Owners that hold all (or any) of the lexemes, optionally only at the given weights.

    A lexeme given twice counts once; no lexemes find nothing.
    """
    lexemes = sorted(set(lexemes))
    hits = postings.filter(F.col("lexeme").isin(*lexemes))
    if weights is not None:
        hits = hits.filter(F.col("weight").isin(*weights))
    if not every:
        return hits.select(owner).distinct()
    found = hits.groupBy(owner).agg(F.countDistinct("lexeme").alias("_n"))
    return found.filter(F.col("_n") == len(lexemes)).select(owner)


def has_lexemes(tokens: Column, lexemes: list[str], every: bool = True) -> Column:
    """Row-wise form of the text match on a token array: no shuffle, tokens made once."""
    wanted = F.array(*[F.lit(x) for x in lexemes])
    if not every:
        return F.arrays_overlap(tokens, wanted)
    return F.size(F.array_except(wanted, tokens)) == 0


def owners_of_codes(ordered: DataFrame, source, targets: list, owner: str = "code") -> DataFrame:
    """Concepts whose list for one coding system holds any of the targets (reverse lookup)."""
    hits = ordered.filter((F.col("source") == source) & F.col("target").isin(*targets))
    return hits.select(owner).distinct()


def list_holds(codes: Column, target: str) -> Column:
    return F.array_contains(codes, target)


def list_overlaps(codes: Column, targets: list[str]) -> Column:
    return F.arrays_overlap(codes, F.array(*[F.lit(x) for x in targets]))


def similar_rows(
    df: DataFrame, text: str, query: str, threshold: float = SIMILARITY_THRESHOLD, out: str = "sim"
) -> DataFrame:
    """Rows whose text is similar to the query: one scan, no shuffle."""
    grams = df.withColumn("_grams", X.trigrams(F.col(text)))
    wanted = X.trigrams(F.lit(query))
    scored = grams.withColumn(out, X.trigram_similarity(F.col("_grams"), wanted))
    return scored.filter(F.col(out) >= threshold).drop("_grams")


def trigram_postings(df: DataFrame, owner: str, text: str) -> DataFrame:
    """(gram, owner, n): one row per distinct trigram, with the owner's trigram count.

    The outer explode and the count that is never NULL keep the optimizer from adding filters that
    would build the trigrams twice.
    """
    grams = df.select(owner, X.trigrams(F.col(text)).alias("_grams"))
    rows = grams.select(F.explode_outer("_grams").alias("gram"), owner, F.coalesce(F.size("_grams"), F.lit(0)).alias("n"))
    return rows.filter(F.col("gram").isNotNull())


def similar_owners(
    postings: DataFrame,
    query: str,
    owner: str = "code",
    threshold: float = SIMILARITY_THRESHOLD,
    out: str = "sim",
) -> DataFrame:
    """The same search on a posting table: reads only the query's trigrams."""
    row = postings.sparkSession.range(1).select(X.trigrams(F.lit(query)).alias("grams")).first()
    wanted = row["grams"]
    hits = postings.filter(F.col("gram").isin(*wanted)).groupBy(owner, "n").agg(F.count("*").alias("_shared"))
    sim = F.col("_shared") / (F.col("n") + len(wanted) - F.col("_shared"))
    return hits.select(owner, sim.alias(out)).filter(F.col(out) >= threshold)
