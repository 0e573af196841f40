"""Cross-maps: concept to code lists of other coding systems.

The long form ``(code, source, target, priority, ord)`` is the working table; array columns are
built from it last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspark.functions import scalar
from termspark.operators.numbering import ordinals


def map_feed(df: DataFrame, code: str, source: str, target: str, priority) -> DataFrame:
    """One feed in the common shape; ``priority`` is a column name or expression."""
    rank = F.col(priority) if isinstance(priority, str) else priority
    return df.select(
        F.col(code).alias("code"),
        F.col(source).alias("source"),
        F.col(target).alias("target"),
        rank.cast("int").alias("priority"),
    )


def read_feed(df: DataFrame) -> DataFrame:
    """The Read map in the common shape: assured rows come first."""
    return map_feed(df, "concept_id", "map_origin", "map_target", scalar.assured_priority(F.col("is_assured")))


def refset_feed(df: DataFrame) -> DataFrame:
    return map_feed(df, "referenced_component_id", "map_origin", "map_target", "map_priority")


def of_concepts(feed: DataFrame, concepts: DataFrame, code: str = "code") -> DataFrame:
    """Feed rows whose concept exists (inner join on a unique key)."""
    return feed.join(concepts.select(code), code, "left_semi")


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All feeds together, duplicates removed."""
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed)
    return first.distinct()


def best_priority(*feeds: DataFrame) -> DataFrame:
    """Per (code, source, target) the best priority.

    Equals union, duplicate removal, rank by priority and rank 1, in one aggregation that is
    combined before the shuffle; a much repeated target does not travel.
    """
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed)
    return first.groupBy("code", "source", "target").agg(F.min("priority").alias("priority"))


def ordered_targets(best: DataFrame) -> DataFrame:
    """Adds ``ord``: the place of a target in its (code, source) list, by priority, then target."""
    return ordinals(best, ["code", "source"], ["priority", "target"], "ord")


def external_lists(
    df: DataFrame, source: str, code: str = "snomed_code", codes: str = "codes"
) -> DataFrame:
    """External concept -> codes table in long form; one row with no target for an empty list.

    Lists of a repeated concept are joined and each target kept once, at its first place.
    """
    exploded = df.filter(F.col(codes).isNotNull()).select(F.col(code).alias("code"), F.posexplode_outer(codes).alias("place", "target"))
    return exploded.groupBy("code", "target").agg(F.min("place").alias("priority")).select(
        "code",
        F.lit(source).alias("source"),
        "target",
        F.coalesce("priority", F.lit(-1)).alias("priority"),
    )


def list_columns(ordered: DataFrame, columns: dict[str, str], page_entries: int) -> DataFrame:
    """Rows (code, page) with one array per coding system, NULL where a system has no entry there.

    ``columns`` maps output column to source value. Only the given sources are pivoted, in one
    aggregation. Entry n of any list stands on page (n - 1) / ``page_entries``, so that no row holds
    an unbounded list; the long form needs no pages.
    """
    paged = ordered.filter(F.col("source").isin(*columns.values())).withColumn(
        "page", F.floor((F.col("ord") - 1) / page_entries)
    )
    entry = F.struct("ord", "target")

    def one(source: str):
        here = F.col("source") == source
        listed = F.collect_list(F.when(here & F.col("target").isNotNull(), entry))
        texts = F.transform(F.sort_array(listed), lambda e: e["target"])
        return F.when(F.max(here), texts)

    return paged.groupBy("code", "page").agg(*[one(s).alias(c) for c, s in columns.items()])
