"""Release manifests: saved JSON answers of the release service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termspark import constants as C
from termspark.functions import scalar
from termspark.operators.upsert import latest_per_key
from termspark.schemas import MANIFEST


def read_manifests(spark: SparkSession, paths: str | list[str], one_per_file: bool = True) -> DataFrame:
    """One row per manifest: its newest (first) release. Raises on another version or no release.

    Manifests are one per file, or one per line.
    """
    raw = spark.read.schema(MANIFEST).option("multiLine", one_per_file).json(paths)
    version = F.col("apiVersion")
    wrong = F.raise_error(F.concat(F.lit("unexpected manifest version: "), F.coalesce(version, F.lit("none"))))
    empty = F.raise_error(F.lit("manifest without releases"))
    first = (
        F.when(~version.eqNullSafe(C.MANIFEST_VERSION), wrong.cast(MANIFEST["releases"].dataType.elementType))
        .when(
            F.coalesce(F.size("releases"), F.lit(0)) < 1, empty.cast(MANIFEST["releases"].dataType.elementType)
        )
        .otherwise(F.get("releases", 0))
    )
    return raw.select(F.col("_metadata.file_path").alias("path"), first.alias("release")).select("path", "release.*")


def latest_release(releases: DataFrame, category: str, order: list[str]) -> DataFrame:
    """The newest release of each category."""
    return latest_per_key(releases, category, order).select(*releases.columns)


def parse_category(text: str) -> int | None:
    """Category name (any case) or small number to its flag; None if neither."""
    named = C.CATEGORY_FLAGS.get(text.upper())
    if named is not None:
        return named
    return int(text) if text.isdecimal() and int(text) < 256 else None


def categories_in(flag: int) -> list[int]:
    """The single categories a flag stands for."""
    return [c for c in sorted(C.CATEGORY_ITEMS) if flag & c == c]


def item_numbers(flag: int) -> list[int]:
    return [C.CATEGORY_ITEMS[c] for c in categories_in(flag)]


def in_category(flag: Column, category: int) -> Column:
    """Rows whose flags hold the whole category."""
    return scalar.has_flag(flag, category)


def item_in_category(item: Column, category: int) -> Column:
    """Rows whose item number belongs to the category: a single one, or both for 'all'."""
    known = item_numbers(category) if category in (*C.CATEGORY_ITEMS, C.CATEGORY_FLAGS["SNOMED_ALL"]) else []
    return item.isin(*known) if known else F.lit(False)
