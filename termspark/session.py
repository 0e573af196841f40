"""Session settings and the shared staging folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Run-time SQL settings the jobs rely on. Skewed join keys are split by AQE, also where that
# costs another shuffle afterwards. Joins on (code, chunk) may reuse a partitioning by code. Arrow
# batches are bounded by size too, as texts may be long. Shuffle partitions, which are
# compressed, are put together up to 4 MB only, as a task may sort both sides of a join and rows for a window.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4MB",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4MB",
}

# shared folders named by hand for sessions without ``spark.checkpoint.dir``, by application
_named_folders: dict[str, str] = {}
# staging folders already made, by application
_made_folders: set[str] = set()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a running session and return it."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def name_staging_folder(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of a session that runs without ``spark.checkpoint.dir``."""
    _named_folders[spark.sparkContext.applicationId] = folder


def has_staging_folder(spark: SparkSession) -> bool:
    """Whether the session knows a shared folder."""
    named = spark.sparkContext.applicationId in _named_folders
    return named or bool(spark.conf.get("spark.checkpoint.dir", None))


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``, or the one named by hand."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or _named_folders.get(spark.sparkContext.applicationId)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or name one")
    return folder.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the application's staging folder, which goes when the application ends."""
    run = spark.sparkContext.applicationId
    folder = f"{staging_root(spark)}/termspark/{run}"
    if folder not in _made_folders:
        files, where = _file_system(spark, folder)
        files.mkdirs(where)
        files.deleteOnExit(where)
        _made_folders.add(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete a staged table whose readers are done."""
    run = spark.sparkContext.applicationId
    if not path.startswith(f"{staging_root(spark)}/termspark/{run}/"):
        raise ValueError(f"not a staged table: {path}")
    files, where = _file_system(spark, path)
    files.delete(where, True)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, so that a lost executor re-reads files instead of recomputing, and lets
    several readers share one computation.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
