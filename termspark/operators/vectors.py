"""Weighted text vectors in long form: one row per occurrence of a lexeme.

A vector is the rows ``(keys, lexeme, pos, weight)`` of its owner. Every position of every lexeme is
kept, whatever its number or length, and nothing is ever collected per lexeme or per owner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspark.functions import text as X
from termspark.operators.numbering import running_totals


def set_weight(rows: DataFrame, weight: str) -> DataFrame:
    """Give every position of the vectors one weight."""
    return rows.withColumn("weight", F.lit(weight))


def top_positions(rows: DataFrame, keys: list[str], out: str = "top") -> DataFrame:
    """(keys, out): the highest position of each vector; combined before the shuffle."""
    return rows.groupBy(*keys).agg(F.max("pos").alias(out))


def shift(rows: DataFrame, keys: list[str], offsets: DataFrame, offset: str) -> DataFrame:
    """Vectors with their positions moved by the owner's offset; an owner without one stays in place.

    ``offsets`` is unique by ``keys``. An owner of very many rows is a skewed join key against one row.
    """
    moved = rows.join(offsets.select(*keys, F.col(offset).alias("_offset")), keys, "left")
    return moved.withColumn("pos", F.col("pos") + F.coalesce("_offset", F.lit(0))).drop("_offset")


def concatenate(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Vectors set one after the other: the second goes on from the highest position of the first."""
    return first.unionByName(shift(second, keys, top_positions(first, keys), "top"))


def spread_tokens(df: DataFrame, keys: list[str], lexemes: str, weight: str, offset: str) -> DataFrame:
    """One row per lexeme of each row's token array: (keys, lexeme, pos, weight).

    A dotted code also stands as its pieces. Stop words (NULL) are left out. The outer forms keep the
    optimizer from adding a size filter that would tokenise twice.
    """
    rows = df.select(*keys, weight, offset, F.posexplode_outer(lexemes).alias("_place", "_whole"))
    rows = rows.filter(F.col("_whole").isNotNull())
    return rows.select(
        *keys,
        F.explode_outer(X.pieces(F.col("_whole"))).alias("lexeme"),
        (F.col("_place") + 1 + F.col(offset).cast("bigint")).alias("pos"),
        F.col(weight).alias("weight"),
    )


def text_vectors(
    df: DataFrame, keys: list[str], parts: list[tuple[Column, str]], config: str = X.ENGLISH
) -> DataFrame:
    """Vector of several texts of one row, one after the other: (keys, lexeme, pos, weight).

    ``parts`` are (text, weight); each part's positions go on from the highest one before it. Each row
    is worked on where it is: there is no shuffle.
    """
    names = [f"_part{i}" for i in range(len(parts))]
    lexed = df.select(
        *keys, *[X.lexize(X.tokenize(text), config).alias(n) for n, (text, _) in zip(names, parts)]
    )
    offset: Column = F.lit(0)
    each = []
    for name, (_, weight) in zip(names, parts):
        each.append(
            F.struct(F.col(name).alias("_lexemes"), F.lit(weight).alias("_weight"), offset.alias("_offset"))
        )
        offset = offset + X.last_position(F.col(name))
    placed = lexed.select(*keys, F.inline(F.array(*each)))
    return spread_tokens(placed, keys, "_lexemes", "_weight", "_offset")


def aggregate_texts(
    df: DataFrame, group: str, order: str, text: str, weight: str = "D", config: str = X.ENGLISH
) -> DataFrame:
    """Vector aggregate: the vectors of a group's texts one after the other, in the given order.

    (group, lexeme, pos, weight). ``order`` is unique inside a group.
    """

    def lexed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_lexemes", X.lexize(X.tokenize(F.col(text)), config)).drop(text)
        return rows.withColumn("_top", X.last_position(F.col("_lexemes")))

    rows = df.select(group, order, text)
    placed = running_totals(rows, [group], [order], {"_before": F.col("_top")}, lexed)
    return spread_tokens(placed.withColumn("_weight", F.lit(weight)), [group], "_lexemes", "_weight", "_before")
