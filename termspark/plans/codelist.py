"""The codelist: one row per active concept, its code lists, and its text vectors.

Lists and vectors are long tables of their own, ``(code, source, target, priority, ord)`` and ``(code, vector,
lexeme, pos, weight)``, complete for concepts of any size. Wide pages of the lists are made from them
with ``maps.list_columns``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termspark.constants import CODE_LIST_COLUMNS
from termspark.functions import scalar
from termspark.functions import text as X
from termspark.operators import filters, maps
from termspark.operators.numbering import dense_ids, running_totals

# order of the texts in a codelist vector
CODE_PART, DESCRIPTION_PART, SYNONYM_PART, FIRST_LIST_PART = 0, 1, 2, 3


class Codelist(NamedTuple):
    """The three tables of the codelist."""

    concepts: DataFrame
    lists: DataFrame
    vectors: DataFrame


def named_concepts(concept: DataFrame, description: DataFrame) -> DataFrame:
    """Active concepts with their fully specified name: (code, description, case_sig, active,
    effective_time), unique by code.

    A concept with several such names keeps the latest one, then the lowest description id. That
    choice is an aggregate, combined before the shuffle, and its result is unique by the join key.
    """
    names = filters.active(description).filter(F.col("identifier") == "F")
    latest = F.struct(F.unix_date("effective_time"), -scalar.as_number(F.col("id")))
    name = names.groupBy(F.col("concept_id").alias("code")).agg(
        F.max_by(F.struct("term", "case_significance_id"), latest).alias("_name")
    )
    concepts = filters.active(concept).select(F.col("id").alias("code"), "active", "effective_time")
    return concepts.join(name, "code").select(
        "code",
        F.col("_name.term").alias("description"),
        scalar.case_number(F.col("_name.case_significance_id")).alias("case_sig"),
        "active",
        "effective_time",
    )


def numbered_concepts(concept: DataFrame, description: DataFrame) -> DataFrame:
    """``named_concepts`` with a dense ``id`` in numeric order of the code."""
    named = named_concepts(concept, description)
    return dense_ids(named, [scalar.as_number(F.col("code"))], "id").select("id", *named.columns)


def synonym_texts(description: DataFrame) -> DataFrame:
    """(code, sub, text): active preferred and other synonyms, in order of description id."""
    return filters.active(description).filter(F.col("identifier").isin("P", "S")).select(
        F.col("concept_id").alias("code"),
        scalar.as_number(F.col("id")).alias("sub"),
        F.coalesce("term", F.lit("")).alias("text"),
    )


def vector_parts(concepts: DataFrame, synonyms: DataFrame, lists: DataFrame) -> DataFrame:
    """(code, part, sub, text): every text of a concept's vectors, in vector order.

    ``lists`` is the long form; each entry is a text of its own, in list order.
    """
    columns = ["code", "part", "sub", "text"]
    own = concepts.select(
        "code",
        F.inline(
            F.array(
                F.struct(F.lit(CODE_PART).alias("part"), F.col("code").alias("text")),
                F.struct(F.lit(DESCRIPTION_PART).alias("part"), F.coalesce("description", F.lit("")).alias("text")),
            )
        ),
    ).withColumn("sub", F.lit(0).cast("bigint"))
    known = synonyms.join(concepts.select("code"), "code", "left_semi").withColumn("part", F.lit(SYNONYM_PART))
    place = {source: FIRST_LIST_PART + i for i, source in enumerate(CODE_LIST_COLUMNS.values())}
    listed = lists.filter(F.col("target").isNotNull()).select(
        "code",
        scalar.lookup(F.col("source"), place).cast("int").alias("part"),
        F.col("ord").cast("bigint").alias("sub"),
        F.col("target").alias("text"),
    )
    return own.select(*columns).unionByName(known.select(*columns)).unionByName(listed)


def concept_vectors(parts: DataFrame, config: str = X.ENGLISH, null_safe: bool = False) -> DataFrame:
    """(code, vector, lexeme, pos, weight) of the search, synonyms and relation vectors of concepts.

    Texts are put in order and tokenised once. Where a text begins follows from running totals inside
    its part and from the few parts before it: a synonym goes on from the highest position of the one
    before, the entries of a code list are one text. Without synonyms a concept has no search vector;
    ``null_safe`` gives it one.
    """
    part = F.col("part")
    in_list, in_relation = part >= FIRST_LIST_PART, ~part.isin(DESCRIPTION_PART, SYNONYM_PART)

    def lexed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("lexemes", X.lexize(X.tokenize(F.col("text")), config)).drop("text")
        rows = rows.withColumn("last", X.last_position(F.col("lexemes")))
        return rows.withColumn("taken", F.when(in_list, F.size("lexemes")).otherwise(F.col("last")))

    placed = running_totals(parts, ["code", "part"], ["sub"], {"entry_at": F.col("taken")}, lexed)

    # at most one row per part of a concept
    tops = placed.groupBy("code", "part").agg(
        F.coalesce(F.max(F.when(F.col("last") > 0, F.col("entry_at") + F.col("last"))), F.lit(0)).alias("top")
    )
    before = Window.partitionBy("code").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("code")
    starts = tops.select(
        "code",
        "part",
        F.coalesce(F.sum("top").over(before), F.lit(0)).alias("search_at"),
        F.coalesce(F.sum(F.when(in_relation, F.col("top"))).over(before), F.lit(0)).alias("relation_at"),
        F.max(part == SYNONYM_PART).over(whole).alias("has_synonyms"),
    )
    rows = placed.join(starts, ["code", "part"]).select(
        "code",
        "part",
        "search_at",
        "relation_at",
        "has_synonyms",
        "entry_at",
        F.when(part.isin(CODE_PART, DESCRIPTION_PART), "A").otherwise("B").alias("weight"),
        F.posexplode("lexemes").alias("place", "whole"),
    )
    rows = rows.filter(F.col("whole").isNotNull()).withColumn("lexeme", F.explode(X.pieces(F.col("whole"))))
    at = F.col("place") + 1 + F.col("entry_at")

    def entry(vector: str, pos, weight):
        return F.struct(F.lit(vector).alias("vector"), pos.alias("pos"), weight.alias("weight"))

    found = F.array_compact(
        F.array(
            F.when(F.col("has_synonyms") | F.lit(null_safe), entry("search", at + F.col("search_at"), F.col("weight"))),
            F.when(part == SYNONYM_PART, entry("synonyms", at, F.lit("D"))),
            F.when(in_relation, entry("relation", at + F.col("relation_at"), F.col("weight"))),
        )
    )
    return rows.select("code", "lexeme", F.inline(found)).select("code", "vector", "lexeme", "pos", "weight")


def build_lists(
    concepts: DataFrame, feeds: list[DataFrame], external: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Long code lists (code, source, target, priority, ord) of the given concepts."""
    best = maps.best_priority(*feeds)
    for source, table in (external or {}).items():
        best = best.unionByName(maps.external_lists(table, source))
    # aggregated first: a hot concept joins with one row per distinct target
    return maps.ordered_targets(maps.of_concepts(best, concepts))


def build_codelist(
    concept: DataFrame,
    description: DataFrame,
    refset_map: DataFrame,
    ctv_map: DataFrame,
    mesh: DataFrame | None = None,
    icd9: DataFrame | None = None,
    config: str = X.ENGLISH,
    null_safe: bool = False,
) -> Codelist:
    """The codelist from the raw tables (``description`` classified).

    concepts: id, code, description, case_sig, active, effective_time, unique by code.
    """
    concepts = numbered_concepts(concept, description)
    feeds = [
        maps.refset_feed(filters.active(refset_map)),
        maps.read_feed(filters.active(ctv_map)),
    ]
    external = {
        CODE_LIST_COLUMNS[column]: table
        for column, table in (("mesh_codes", mesh), ("icd9_codes", icd9))
        if table is not None
    }
    lists = build_lists(concepts, feeds, external)
    parts = vector_parts(concepts, synonym_texts(description), lists)
    return Codelist(concepts, lists, concept_vectors(parts, config, null_safe))
