"""Typed streaming load: release files in a drop folder become rows of the raw tables, each file once.

Every file goes the way of the batch scan: columns by its own header, decoding, load filter. A micro-batch is
written under its own number, so one that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termspark.schemas import RAW_TABLES, Table
from termspark.session import _file_system
from termspark.sources import rf2

DROP = "drop"


def _landed_path(landing: str, name: str) -> str:
    return f"{landing.rstrip('/')}/{name}"


def land_batch(lines: DataFrame, landing: str, name: str, drop: str, **options) -> None:
    """Write the rows of one micro-batch of file lines to a raw table, as partition ``drop`` of it."""
    table = RAW_TABLES[name]
    placed = lines.withColumn("_at", F.monotonically_increasing_id())
    rows = rf2.keep_rows(rf2.parse_lines(placed, table, **options), table).select(*table.names)
    writer = rows.withColumn(DROP, F.lit(drop)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DROP).parquet(_landed_path(landing, name))


def land_table(
    spark: SparkSession,
    base: str,
    landing: str,
    checkpoint: str,
    name: str,
    files_a_batch: int | None = None,
    **options,
) -> None:
    """Load what is new for one raw table below ``base`` (release folders) and stop.

    The checkpoint remembers the files. ``files_a_batch`` bounds a micro-batch. ``options`` are those of the
    batch scan's parser.
    """
    table: Table = RAW_TABLES[name]
    for number, pattern in enumerate(table.files):
        reader = spark.readStream.format("text").option("lineSep", "\n")
        if files_a_batch:
            reader = reader.option("maxFilesPerTrigger", files_a_batch)
        raw = reader.load(f"{base.rstrip('/')}/*/{table.folder}/{pattern}")
        lines = rf2.plain_lines(
            raw.select("value", F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start") == 0).alias("_head"))
        )

        def land(batch: DataFrame, batch_id: int, number: int = number) -> None:
            land_batch(batch, landing, name, f"{number}-{batch_id}", **options)

        query = (
            lines.writeStream.foreachBatch(land)
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}-{number}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def land_drops(spark: SparkSession, base: str, landing: str, checkpoint: str, category: int, **options) -> None:
    """Load what is new for every raw table of a category."""
    for name, table in RAW_TABLES.items():
        if category & table.category == table.category:
            land_table(spark, base, landing, checkpoint, name, **options)


def landed(spark: SparkSession, landing: str, name: str, drops: list[str] | None = None) -> DataFrame:
    """The landed rows of a raw table, or those of some drops; none landed: no rows."""
    table, path = RAW_TABLES[name], _landed_path(landing, name)
    files, where = _file_system(spark, path)
    if not files.exists(where):
        return spark.createDataFrame([], table.struct)
    rows = spark.read.schema(T.StructType([*table.struct.fields, T.StructField(DROP, T.StringType())])).parquet(path)
    return (rows if drops is None else rows.filter(F.col(DROP).isin(drops))).select(*table.names)


def drops_of(spark: SparkSession, landing: str, name: str) -> list[str]:
    """The micro-batches landed for a raw table, by the names of their folders."""
    files, where = _file_system(spark, _landed_path(landing, name))
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return sorted(n[len(DROP) + 1 :] for n in names if n.startswith(f"{DROP}="))
