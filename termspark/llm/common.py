"""Helpers shared by the operators: safe column names, batch functions, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from termspark.session import drop_staged, staging_path

# Bytes of text handled at once inside a task. Arrow batches are cut by this size as well as by rows,
# so that a batch of very long texts does not grow with its row count.
BATCH_BYTES = 8 << 20


def with_batch_bounds(df: DataFrame) -> DataFrame:
    """``df`` of a session whose Arrow batches are bounded in rows and bytes."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


# the C library's own way to give free memory back; not every one has it
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives memory that is no longer used back to the system.

    A worker process outlives its task and its stage: without this it keeps the most that any of them needed.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def map_rows(
    df: DataFrame,
    columns: dict[str, str],
    out: T.StructType,
    start: Callable[[], Callable[[pa.RecordBatch], dict[str, list | pa.Array]]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Run a batch function over the named columns of ``df``; other columns are not read.

    ``columns`` maps the names the function sees to their SQL types. ``start`` is called once per
    task and returns the function, which maps a batch to the columns of ``out``. The columns of
    ``df`` named in ``keep`` come along in ``_row``, a struct, so that their names cannot clash.
    """
    kept = T.StructType([df.schema[c] for c in keep])
    full = T.StructType([*out.fields, T.StructField("_row", kept)] if keep else out.fields)
    fields = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            if batch.num_rows:
                made = work(batch)
                if keep:
                    made["_row"] = batch["_row"]
                arrays = [
                    made[f.name].cast(f.type) if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], f.type)
                    for f in fields
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=fields)
                del made, arrays
                release()

    wanted = [F.col(f"`{c}`").cast(kind).alias(c) for c, kind in columns.items()]
    if keep:
        wanted.append(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"))
    return with_batch_bounds(df.select(*wanted)).mapInArrow(run, full)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a binary column, NULL as empty."""
    return [t or b"" for t in column.to_pylist()]


# --- fixed value: ASCII letters in lower case and digits stay, as do all bytes of other characters ---
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of ASCII letters and digits and other characters, A-Z lower-cased."""
    return text.translate(WORD_BYTES).split()


def struct(spec: str) -> T.StructType:
    """A schema from DDL."""
    return T.StructType.fromDDL(spec)


# shuffle files of a write can go when it is done; nothing runs the same plan again
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_once(df: DataFrame, label: str, **options) -> tuple[DataFrame, str]:
    """``df`` written below the shared folder and read back, with its path for ``drop_staged``.

    The shuffle files of the write go with its end. ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(path), path


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest node it can reach.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): in the first every node
    hands the larger of its neighbours to its smallest one, in the second the smaller. Each step is
    an aggregation to one minimum per node and a join back, so no neighbourhood is ever collected;
    skewed nodes are split by the join. Every round is written to the shared folder, which also ends
    the lineage. The rounds end when one changes no edge.

    No edges: no rows. Loops and repeated edges do not matter; NULL ends are ignored.
    """
    spark = edges.sparkSession

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        """Pairs (node, other) with node > other, from one star step."""
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else pairs
        low = both.groupBy("a").agg(F.min("b").alias("_low"))
        low = low.select(F.col("a").alias("_a"), F.least("a", "_low").alias("_low"))
        joined = both.join(low, F.col("a") == F.col("_a"))
        if larger:
            made = joined.filter("b > a").select(F.col("b").alias("a"), F.col("_low").alias("b"))
        else:
            links = joined.filter("b <> _low").select(F.col("b").alias("a"), F.col("_low").alias("b"))
            made = links.unionByName(low.select(F.col("_a").alias("a"), F.col("_low").alias("b")))
        return made.filter("a <> b").distinct()

    def digest(pairs: DataFrame) -> tuple:
        row = pairs.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")
        ).first()
        return row["n"], row["h"]

    down = edges.filter("a is not null and b is not null and a <> b")
    down = down.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, path = read_once(down, label)
    before = digest(pairs)
    while before[0]:
        made, new_path = read_once(star(star(pairs, True), False), label)
        after = digest(made)
        drop_staged(spark, path)
        pairs, path = made, new_path
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
