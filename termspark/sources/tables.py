"""Stored tables: existence, create and append, replace, drop by group."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from termspark import schemas as S


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create(df: DataFrame, name: str, format: str = "parquet", **options: str) -> None:
    """Create a table from ``df``; fails if it exists."""
    df.write.mode("errorifexists").format(format).options(**options).saveAsTable(name)


def append(df: DataFrame, name: str) -> None:
    """Append by column name order of the stored table; create it if absent."""
    spark = df.sparkSession
    if not exists(spark, name):
        create(df, name)
        return
    df.select(*spark.table(name).columns).write.mode("append").insertInto(name)


def replace(df: DataFrame, name: str, managed: bool = True) -> None:
    """New content for a table: recreated (``managed``), or emptied and refilled.

    A recreated table is written whole under another name first and then takes the old one's place,
    so a failed write leaves the old table as it was. ``df`` may read the table itself then. A refill
    keeps the stored columns, needs the table, and ``df`` must not read it.
    """
    spark = df.sparkSession
    if not managed:
        columns = spark.table(name).columns
        df.select(*columns).write.insertInto(name, overwrite=True)
        return
    waiting = f"{name}_new_{uuid.uuid4().hex}"
    try:
        create(df, waiting)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {waiting}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {waiting} RENAME TO {name}")


def drop_groups(spark: SparkSession, items: str | list[str]) -> list[str]:
    """Drop table groups: releases, codelist, ontology or all. Unknown names are ignored.

    Returns the names of the tables in the chosen groups; nothing valid drops nothing.
    """
    names = items.split(",") if isinstance(items, str) else items
    wanted = {n.strip().lower() for n in names}
    groups = S.TABLE_GROUPS if "all" in wanted else {g: t for g, t in S.TABLE_GROUPS.items() if g in wanted}
    tables = [t for group in groups.values() for t in group]
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return tables
