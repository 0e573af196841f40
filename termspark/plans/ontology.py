"""Ontology: tags from the codelist, edges from the is-a relationships."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspark import constants as C
from termspark.functions import scalar
from termspark.functions import text as X
from termspark.operators import filters, vectors
from termspark.operators.numbering import dense_ids
from termspark.plans.codelist import Codelist


def number_tags(codes: DataFrame, root: str = C.ROOT_CONCEPT, code: str = "code") -> DataFrame:
    """Every code but the root, with a dense tag id in order of code. ``codes`` is unique by code."""
    return dense_ids(codes.filter(F.col(code) != root), [F.col(code)], "tag_id")


def tag_vectors(concepts: DataFrame, found: DataFrame, config: str = X.ENGLISH) -> DataFrame:
    """(code, lexeme, pos, weight) of the tags: description A, code A, relation B, synonyms B.

    ``concepts`` is (code, description), unique by code; ``found`` is the codelist's vector table.
    """
    own = vectors.text_vectors(concepts, ["code"], [(F.col("description"), "A"), (F.col("code"), "A")], config)
    own = own.filter(F.col("code").isNotNull())
    none = F.lit(None).cast("bigint")
    related = found.filter(F.col("vector") == "relation").select("code", none.alias("own"), F.col("pos").alias("related"))
    tops = own.select("code", F.col("pos").alias("own"), none.alias("related")).unionByName(related)
    tops = tops.groupBy("code").agg(F.max("own").alias("own"), F.max("related").alias("related"))
    # relation goes on from the tag's own texts, synonyms from both; the vectors move once, to their code
    shifted = F.coalesce("own", F.lit(0)) + F.when(F.col("vector") == "synonyms", F.coalesce("related", F.lit(0))).otherwise(0)
    rest = found.filter(F.col("vector").isin("relation", "synonyms")).join(tops, "code", "left")
    rest = rest.select("code", "lexeme", (F.col("pos") + shifted).alias("pos"), F.lit("B").alias("weight"))
    return own.unionByName(rest.join(concepts.select("code"), "code", "left_semi"))


def build_tags(concepts: DataFrame) -> DataFrame:
    """Tags: id, code, name, type_id, reference_id and properties (JSON), unique by code."""
    tags = number_tags(concepts.select("code", "id", "description"))
    return tags.select(
        F.col("tag_id").alias("id"),
        "code",
        F.col("description").alias("name"),
        F.lit(C.TAG_DISEASE).alias("type_id"),
        F.lit(None).cast("bigint").alias("reference_id"),
        scalar.json_object(
            code=F.col("code"), code_id=F.col("id"), coding_system_id=F.lit(C.CODING_SYSTEM)
        ).alias("properties"),
    )


def build_tag_vectors(codelist: Codelist, config: str = X.ENGLISH) -> DataFrame:
    """(code, vector, lexeme, pos, weight) of all tags: their own search vector, and the codelist's others."""
    concepts = codelist.concepts.filter(F.col("code") != C.ROOT_CONCEPT)
    search = tag_vectors(concepts, codelist.vectors, config).withColumn("vector", F.lit("search"))
    others = codelist.vectors.filter((F.col("vector") != "search") & (F.col("code") != C.ROOT_CONCEPT))
    return search.unionByName(others).select("code", "vector", "lexeme", "pos", "weight")


def resolve_edges(
    links: DataFrame, tags: DataFrame, source: str = "source_id", destination: str = "destination_id"
) -> DataFrame:
    """(child_id, parent_id) of the links whose two ends are tags, each pair once.

    ``tags`` is (code, id), unique by code. Links are made distinct before the joins. A parent with
    very many children is a skewed join key against one tag row, which AQE splits.
    """
    pairs = links.select(F.col(source).alias("_child"), F.col(destination).alias("_parent")).distinct()
    child = tags.select(F.col("code").alias("_child"), F.col("id").alias("child_id"))
    parent = tags.select(F.col("code").alias("_parent"), F.col("id").alias("parent_id"))
    return pairs.join(child, "_child").join(parent, "_parent").select("child_id", "parent_id")


def build_edges(relationship: DataFrame, tags: DataFrame) -> DataFrame:
    """Edges: id, child_id, parent_id."""
    links = filters.is_a_edges(filters.active(relationship))
    edges = resolve_edges(links, tags.select("code", "id"))
    return dense_ids(edges, [F.col("child_id"), F.col("parent_id")], "id").select("id", "child_id", "parent_id")
