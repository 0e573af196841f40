"""Tables in hash partitions of a key, of which single partitions are read and replaced.

A change of some keys touches the partitions of these keys only: the others are neither read nor written and keep
their files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termspark.session import _file_system, drop_staged, staging_path

PART, BATCH = "part", "batch"


@dataclass(frozen=True)
class Partitioned:
    """A parquet table below ``path`` with the columns of ``schema``, in ``parts`` hash partitions of ``key``."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    parts: int = 256

    def part_of(self, key: Column) -> Column:
        """The partition of a key; NULL keys share one."""
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.parts)).cast("int")

    def numbers(self, keys: DataFrame, column: str) -> list[int]:
        """The partitions that hold any of the given keys: at most ``parts`` numbers reach the driver."""
        return sorted(r[0] for r in keys.select(self.part_of(F.col(column))).distinct().collect())

    def read(self, numbers: list[int] | None = None) -> DataFrame:
        """The rows, or those of the given partitions; an absent table is empty."""
        files, where = _file_system(self.spark, self.path)
        full = T.StructType([*self.schema.fields, T.StructField(PART, T.IntegerType())])
        if not files.exists(where):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(full).parquet(self.path)
        rows = rows if numbers is None else rows.filter(F.col(PART).isin(numbers))
        return rows.select(*self.schema.names)

    def replace_parts(self, df: DataFrame, numbers: list[int]) -> None:
        """New content for the given partitions, to which all rows of ``df`` belong; ``df`` may read the table.

        The rows are written aside first. A failure while they move in is mended by running the same change again.
        """
        if not numbers:
            return
        waiting = staging_path(self.spark, "parts")
        # large partitions are split over tasks and files
        placed = self._placed(df)
        placed.hint("rebalance", PART).write.parquet(waiting)
        full = T.StructType([*self.schema.fields, T.StructField(PART, T.IntegerType())])
        rows = self.spark.read.schema(full).parquet(waiting)
        self._overwrite(rows.hint("rebalance", PART), [PART])
        filled = {r[0] for r in rows.select(PART).distinct().collect()}
        for number in numbers:
            if number not in filled:
                files, where = _file_system(self.spark, f"{self.path}/{PART}={number}")
                files.delete(where, True)
        drop_staged(self.spark, waiting)

    def replace_keys(self, keys: DataFrame, df: DataFrame) -> list[int]:
        """The rows of all given ``keys`` (a column named as the key) become those of ``df``; returns the partitions."""
        numbers = self.numbers(keys, self.key)
        stay = self.read(numbers).join(keys.select(self.key).distinct(), self.key, "left_anti")
        self.replace_parts(stay.unionByName(df.select(*self.schema.names)), numbers)
        return numbers

    def _placed(self, df: DataFrame) -> DataFrame:
        """The table's columns in their types, and the partition."""
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        return df.select(*typed).withColumn(PART, self.part_of(F.col(self.key)))

    def _overwrite(self, df: DataFrame, columns: list[str]) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*columns).parquet(self.path)


@dataclass(frozen=True)
class PartitionedLog(Partitioned):
    """Rows that only grow, batch by batch, in hash partitions of their key."""

    def append(self, df: DataFrame, batch: str) -> None:
        """Add a batch; adding it again replaces it, so a repeated batch counts once."""
        placed = self._placed(df)
        self._overwrite(placed.withColumn(BATCH, F.lit(batch)).hint("rebalance", PART), [PART, BATCH])
