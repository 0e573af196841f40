"""Incremental loads: each release file enters a table once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_files(spark: SparkSession, folder: str, schema: T.StructType, format: str = "parquet", **options) -> DataFrame:
    """Streaming view of a drop folder."""
    return spark.readStream.schema(schema).format(format).options(**options).load(folder)


def ingest_new_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append the rows of files not seen before to ``target`` and stop.

    The checkpoint remembers the files, so a rerun adds only new ones, each exactly once.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_lines(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """Streaming view of release text files: ``value`` lines as in the batch scan, and their file."""
    raw = spark.readStream.format("text").option("lineSep", "\n").option("pathGlobFilter", pattern).load(folder)
    text = F.when(F.col("value").endswith("\r"), F.expr("substring(value, 1, length(value) - 1)"))
    lines = raw.select(F.coalesce(text, F.col("value")).alias("value"), F.col("_metadata.file_path").alias("path"))
    return lines.filter(F.col("value") != "")
