"""Records of quoted text whose fields may hold line ends, from files that are read in many splits.

A line end stands inside a field where the number of quotes before it in its file is odd. So the quotes
are counted block by block first (a block is what one split reads), and a running sum over the blocks
of a file, one small row each, tells every block whether it begins inside a field. Each task then
cuts its blocks into records by itself, without a shuffle. A record over the limit of a block is left in
two or more parts, at most two of them to a block; these parts alone are grouped and put together.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termspark.session import stage

# workers get these functions with the job, so the package need not be installed on them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = ["file", "start", "length"]
PART = "file string, start bigint, goes_on boolean, open boolean, head boolean, text binary"


def file_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines as they are, with the block that each stands in; ``at`` ascends within a task."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def block_states(lines: DataFrame) -> DataFrame:
    """For each block: ``inside``, whether it begins inside a field, and ``first``, whether the file's text begins in it."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    filled = F.count_if(~F.col("value").isin("", "\r"))
    counted = lines.groupBy(*BLOCK).agg(F.sum(quotes).alias("quotes"), filled.alias("filled"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        *BLOCK,
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"),
        ((F.coalesce(F.sum("filled").over(before), F.lit(0)) == 0) & (F.col("filled") > 0)).alias("first"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that lie in one block each."""
    files, starts = batch["file"].dictionary_encode().indices.to_numpy(), batch["start"].to_numpy()
    cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(starts) != 0)) + 1
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(begin, end - begin)


class Cutter:
    """Cuts the lines of one block, which come in slices, into records."""

    def __init__(self, inside: bool, first: bool):
        # the first record goes on from an earlier block; the file's first record is still to come
        self.goes_on, self.first = inside, first
        self.odd = int(inside)
        self.held: list[pa.Array] = []

    def cut(self, values: pa.Array) -> tuple[pa.Array, pa.Array, bool]:
        """Whole records that end in this slice, which of them is the file's first, and whether the first goes on."""
        odd = (self.odd + np.cumsum(pc.count_substring(values, '"').to_numpy())) & 1
        self.odd = int(odd[-1])
        ends = np.flatnonzero(odd == 0) + 1
        if not len(ends):
            self.held.append(values)
            return values[:0], pa.array([], pa.bool_()), False
        before = sum(map(len, self.held))
        lines = pa.concat_arrays([*self.held, values[: ends[-1]]])
        offsets = np.concatenate(([0], ends + before)).astype(np.int32)
        self.held = [values[ends[-1] :]] if ends[-1] < len(values) else []
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), b"\n")
        head = np.zeros(len(texts), bool)
        if self.first:
            filled = pc.invert(pc.is_in(texts, pa.array([b"", b"\r"], texts.type))).to_numpy(zero_copy_only=False)
            head[np.flatnonzero(filled)[:1]] = True
            self.first = not filled.any()
        goes_on, self.goes_on = self.goes_on, False
        return texts, pa.array(head), goes_on

    def rest(self) -> bytes | None:
        """The text of a record that goes on in the next block."""
        return b"\n".join(v for part in self.held for v in part.to_pylist()) if self.held else None


def _cut(batches: Iterator[pa.RecordBatch], parts: bool) -> Iterator[pa.RecordBatch]:
    """Either the parts of records over block limits, or all other records."""
    schema = pa.schema(
        [("file", pa.string()), ("start", pa.int64()), ("goes_on", pa.bool_()), ("open", pa.bool_()),
         ("head", pa.bool_()), ("text", pa.binary())]
    )
    key, cutter = None, None

    def part(goes_on: bool, is_open: bool, head: bool, text: bytes) -> pa.RecordBatch:
        row = [*key, goes_on, is_open, head, text]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    def last() -> Iterator[pa.RecordBatch]:
        if parts and cutter is not None and cutter.held:
            yield part(cutter.goes_on, True, cutter.first, cutter.rest())

    for batch in batches:
        for run in _runs(batch) if batch.num_rows else ():
            block = (run["file"][0].as_py(), run["start"][0].as_py())
            if block != key:
                yield from last()
                key, cutter = block, Cutter(run["inside"][0].as_py(), run["first"][0].as_py())
            texts, head, goes_on = cutter.cut(run["value"])
            if parts:
                if goes_on:
                    yield part(True, False, False, texts[0].as_py())
            elif len(texts):
                made = pa.RecordBatch.from_arrays([head, texts.cast(pa.binary())], names=["head", "text"])
                yield made[1:] if goes_on else made
    yield from last()


def read_records(spark: SparkSession, paths: str | list[str], header: bool) -> DataFrame:
    """``text`` of every record of the files, blank lines between records left out.

    Lines end with ``\\n`` or ``\\r\\n``. With ``header`` the first record of each file is left out. A quote
    that is never closed fails the job, and so does a change of the splits between counting and cutting.
    No files, or empty ones, give no rows.
    """
    lines = file_lines(spark, paths)
    # one row per block; Spark's own size check decides how it is joined
    states = stage(block_states(lines), "blocks")
    changed = F.raise_error(F.lit("files were split in another way than when their quotes were counted"))
    known = lines.join(states, BLOCK, "left").select(
        "file",
        "start",
        F.when(F.col("inside").isNull(), changed).otherwise(F.col("inside")).alias("inside"),
        "first",
        "at",
        F.col("value").cast("binary").alias("value"),
    )
    # in order already unless the join had to move the lines
    known = known.sortWithinPartitions("file", "start", "at").drop("at")
    whole = known.mapInArrow(lambda batches: _cut(batches, False), "head boolean, text binary")
    parts = known.mapInArrow(lambda batches: _cut(batches, True), PART)
    order = Window.partitionBy("file").orderBy("start", F.desc("goes_on"))
    # a record's parts follow each other: the one that opens it, and those that go on from there
    numbered = parts.withColumn("n", F.sum((~F.col("goes_on")).cast("int")).over(order))
    listed = F.sort_array(F.collect_list(F.struct("start", "text", "head", "open")))
    joined = numbered.groupBy("file", "n").agg(listed.alias("p"))
    unclosed = F.raise_error(F.concat(F.lit("unclosed quote in "), F.col("file")))
    text = F.array_join(F.transform("p", lambda p: p["text"].cast("string")), "\n").cast("binary")
    joined = joined.select(
        F.element_at("p", 1)["head"].alias("head"),
        F.when(F.element_at("p", -1)["open"], unclosed).otherwise(text).alias("text"),
    )
    records = whole.unionByName(joined)
    if header:
        records = records.filter(~F.col("head"))
    text = F.col("text").cast("string")
    text = F.when(text.endswith("\r"), F.left(text, F.length(text) - 1)).otherwise(text)
    return records.select(text.alias("text")).filter(F.col("text") != "")
