"""Full build: a release folder to stored raw tables, codelist, tags and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termspark import schemas as S
from termspark.functions import text as X
from termspark.plans.classify import classify_descriptions
from termspark.plans.codelist import build_codelist
from termspark.operators import lookup
from termspark.plans.indexes import build_indexes, stored_codelist
from termspark.plans.ontology import build_edges, build_tag_vectors, build_tags
from termspark.sources import rf2, tables


def load_release(spark: SparkSession, base: str, release: str, category: int, **options) -> bool:
    """Load the raw tables of one release that are not stored yet; True if any was.

    A table is written whole before it gets its name, so one that failed half way is not taken for done.
    """
    loaded = False
    for name, table in S.RAW_TABLES.items():
        stored = S.RAW_PREFIX + name
        if category & table.category != table.category or tables.exists(spark, stored):
            continue
        tables.replace(rf2.read_table(spark, base, release, table, **options), stored)
        loaded = loaded or not spark.table(stored).isEmpty()
    return loaded


def raw_table(spark: SparkSession, name: str) -> DataFrame:
    """A stored raw table, or an empty one."""
    stored = S.RAW_PREFIX + name
    if tables.exists(spark, stored):
        return spark.table(stored)
    return spark.createDataFrame([], S.RAW_TABLES[name].struct)


def derive(
    spark: SparkSession,
    mesh: DataFrame | None = None,
    icd9: DataFrame | None = None,
    managed: bool = True,
    config: str = X.ENGLISH,
    null_safe: bool = False,
) -> None:
    """Classify descriptions, then build and store the codelist, the tags and the edges.

    ``managed`` recreates the tables and their posting tables; otherwise they are emptied and refilled.
    """
    stored = S.RAW_PREFIX + "description"
    plain = raw_table(spark, "description").select(*S.DESCRIPTION.names)
    tables.replace(classify_descriptions(plain, raw_table(spark, "refset_lang")), stored)
    codelist = build_codelist(
        raw_table(spark, "concept"),
        raw_table(spark, "description"),
        raw_table(spark, "refset_map"),
        raw_table(spark, "ctv_map"),
        mesh,
        icd9,
        config,
        null_safe,
    )
    tables.replace(codelist.concepts, S.CODELIST_TABLE, managed)
    build_indexes(codelist, managed)
    found = stored_codelist(spark)
    tables.replace(build_tags(found.concepts), S.TAG_TABLE, managed)
    rows = build_tag_vectors(found, config)
    tables.replace(lookup.clustered(rows, ["vector", "lexeme", "code"]), S.TAG_VECTORS, managed)
    edges = build_edges(raw_table(spark, "relationship"), spark.table(S.TAG_TABLE))
    tables.replace(edges, S.EDGE_TABLE, managed)


def build_release(
    spark: SparkSession, base: str, releases: list[tuple[str, int]], load_options: dict | None = None, **options
) -> bool:
    """Load every (release, category), then derive if any table was loaded. Returns that."""
    loaded = [load_release(spark, base, name, category, **(load_options or {})) for name, category in releases]
    if any(loaded):
        derive(spark, **options)
    return any(loaded)
