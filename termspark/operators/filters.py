"""Row filters. All are plain predicates, so they run before any shuffle and reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspark import constants as C
from termspark.functions import scalar


def with_id(df: DataFrame, key: str = "id") -> DataFrame:
    """Drop rows whose identifier is empty."""
    return df.filter(F.col(key) != "")


def usable_target(target: Column) -> Column:
    """A map target is usable when present and not a ``#`` placeholder."""
    return (F.length(target) > 0) & ~target.startswith("#")


def mapped_rows(
    df: DataFrame,
    target: str = "map_target",
    refset: str = "refset_id",
    out: str = "map_origin",
    origins: dict[str, str] | None = None,
) -> DataFrame:
    """Map-refset rows with a usable target and a known coding system, which goes to ``out``."""
    origin = scalar.lookup(F.col(refset), origins or C.MAP_ORIGINS)
    return df.filter(usable_target(F.col(target))).withColumn(out, origin).filter(F.col(out).isNotNull())


def read_rows(df: DataFrame, target: str = "map_target", term_type: str = "map_origin") -> DataFrame:
    """Read-map rows with a usable target; the term type becomes the Read version."""
    return df.filter(usable_target(F.col(target))).withColumn(term_type, scalar.read_origin(F.col(term_type)))


def active(df: DataFrame, flag: str = "active") -> DataFrame:
    return df.filter(F.col(flag))


def in_realm(df: DataFrame, refset: str = "refset_id", refsets=C.REALM_LANGUAGE_REFSETS) -> DataFrame:
    """Rows of the given language refsets."""
    return df.filter(F.col(refset).isin(*refsets))


def is_a_edges(
    df: DataFrame,
    source: str = "source_id",
    destination: str = "destination_id",
    kind: str | None = "type_id",
    root: str = C.ROOT_CONCEPT,
) -> DataFrame:
    """Is-a rows that do not touch the root."""
    if kind is not None:
        df = df.filter(F.col(kind) == C.IS_A)
    return df.filter(~F.lit(root).isin(F.col(source), F.col(destination)))
