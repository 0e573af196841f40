"""Data-quality checks; each returns the offending rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspark.constants import DESCRIPTION_CLASSES
from termspark.schemas import Table


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys seen more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def orphans(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows whose value has no row in the target table. NULL and empty values are not references."""
    known = target.select(F.col(target_column).alias(column))
    return df.filter(F.col(column).cast("string") != "").join(known, column, "left_anti")


def unreferenced(df: DataFrame, column: str, pointing: DataFrame, pointing_column: str) -> DataFrame:
    """Rows that no row of the pointing table refers to.

    Pointing values are made distinct first (combined before the shuffle): one that points from a
    third of all rows counts once in the join.
    """
    used = pointing.select(F.col(pointing_column).alias(column)).distinct()
    return df.join(used, column, "left_anti")


def declared_orphans(tables: dict[str, DataFrame], declared: Table) -> DataFrame:
    """(column, value, n) for every declared reference of a raw table that finds no target.

    All reference columns are read in one scan and counted in one aggregation, so a value in a third
    of all rows is one row in the join; each target table is joined once.
    """
    references = [c for c in declared.columns if c.refers_to is not None]
    pairs = F.array(*[F.struct(F.lit(c.name).alias("column"), F.col(c.name).cast("string").alias("value")) for c in references])
    values = tables[declared.name].select(F.inline(pairs)).filter(F.col("value") != "")
    values = values.groupBy("column", "value").agg(F.count("*").alias("n"))
    found = None
    for target in sorted({c.refers_to for c in references}):
        table, key = target
        names = [c.name for c in references if c.refers_to == target]
        known = tables[table].select(F.col(key).cast("string").alias("value"))
        lost = values.filter(F.col("column").isin(*names)).join(known, "value", "left_anti")
        lost = lost.select("column", "value", "n")
        found = lost if found is None else found.unionByName(lost)
    return found


def too_long(df: DataFrame, column: str, size: int) -> DataFrame:
    """Rows over a text bound, with the length."""
    return df.withColumn("len", F.length(column)).filter(F.col("len") > size)


def out_of_bounds(df: DataFrame, declared: Table) -> DataFrame:
    """(column, value, len) for every declared text bound that is broken; one scan."""
    sized = [c for c in declared.columns if c.size is not None]
    broken = F.array(
        *[
            F.when(
                F.length(c.name) > c.size,
                F.struct(F.lit(c.name).alias("column"), F.col(c.name).alias("value"), F.length(c.name).alias("len")),
            )
            for c in sized
        ]
    )
    return df.select(F.inline(F.filter(broken, lambda x: x.isNotNull())))


def nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that break a not-null rule."""
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.col(column).isNull()
    return df.filter(missing)


def broken_edges(edges: DataFrame, nodes: DataFrame, ends: list[str], key: str = "id") -> DataFrame:
    """Edges with an end that is no node."""
    found = None
    for end in ends:
        lost = edges.join(nodes.select(F.col(key).alias(end)), end, "left_anti").select(*edges.columns)
        found = lost if found is None else found.unionByName(lost)
    return found.distinct()


def not_in_enum(df: DataFrame, column: str, values=DESCRIPTION_CLASSES) -> DataFrame:
    """Rows with a value outside the enum; NULL is allowed."""
    return df.filter(~F.col(column).isin(*values))
