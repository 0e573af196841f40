"""Upsert by key with the rule: update only from an active and newer row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspark.sources.partitioned import Partitioned


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the last by ``order``; combined before the shuffle, no sort of a group."""
    others = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*others), F.struct(*order))
    return df.groupBy(key).agg(last.alias("_row")).select(key, "_row.*")


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    key: str = "code",
    newer: str = "effective_time",
    active: str = "active",
    kept: tuple[str, ...] = ("id", "effective_time"),
) -> DataFrame:
    """Insert new keys; update a present key only if the incoming row is active and newer.

    The ``kept`` columns of a present key never change. Both sides must be unique by ``key``.
    """
    old, new = current.alias("old"), incoming.alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    absent = F.col(f"old.{key}").isNull()
    newer_row = F.col(f"new.{newer}") > F.col(f"old.{newer}")
    replaces = F.coalesce(F.col(f"new.{active}") & newer_row, F.lit(False))

    def pick(name: str):
        takes = absent if name == key or name in kept else absent | replaces
        return F.when(takes, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    return joined.select(*[pick(c) for c in current.columns])


def upsert_partitions(table: Partitioned, incoming: DataFrame, **rule) -> list[int]:
    """``upsert`` into a stored table in partitions of its key; returns the partitions replaced.

    Only the partitions of the incoming keys are read and written; the others keep their files. Doing it
    again changes nothing.
    """
    numbers = table.numbers(incoming, table.key)
    merged = upsert(table.read(numbers), incoming.select(*table.schema.names), table.key, **rule)
    table.replace_parts(merged, numbers)
    return numbers
