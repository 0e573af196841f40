"""Token ids in Arrow stream files of fixed-size lists, and reading them back at random.

Documents are put in ascending order by a range partitioning and encoded; the ids of a partition's
documents stand one after another in sequences of equal length. A file is one Arrow stream of record
batches with two fixed-size lists per row: the ids, of 16 bits if the vocabulary allows, and a mask of
bits that is false where the last sequence is padded. All full batches have the same size in bytes, so batch n starts at a place that is computed,
not searched; on a local or mounted file system it is mapped into memory and used without a copy.

An index table (doc_id, file, file_no, start, n_tokens) stands beside the files. A task writes its file under a
name of its own and then moves it into place, so a repeated task leaves the same file. Only one row
per file is gathered for the places of the files in the whole order.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from termspark.llm.common import map_rows, struct, with_batch_bounds
from termspark.llm.tokens import encoder

SEQUENCE_LENGTH = 1024
# sequences per record batch
BATCH_SEQUENCES = 64
END_ID = 1

INDEX = "doc_id bigint, file string, file_no int, start bigint, n_tokens bigint"


def _open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder given as path or URI."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder)


class StreamWriter:
    """Writes ids into one file, a batch of sequences at a time."""

    def __init__(self, sink, vocabulary: int, length: int = SEQUENCE_LENGTH, rows: int = BATCH_SEQUENCES):
        self.length, self.rows = length, rows
        self.kind = np.uint16 if vocabulary <= 1 << 16 else np.uint32
        self.schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(self.kind), length)), ("mask", pa.list_(pa.bool_(), length))],
            metadata={"sequence_length": str(length), "batch_sequences": str(rows)},
        )
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.size = self.written = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.kind))
        self.size += len(ids)
        if self.size >= self.length * self.rows:
            self._write(self.size // (self.length * self.rows) * self.rows)

    def close(self) -> None:
        if self.size:
            self._write(-(-self.size // self.length))
        self.writer.close()

    def _write(self, sequences: int) -> None:
        ids = np.concatenate(self.waiting)
        cut = min(sequences * self.length, len(ids))
        room = np.zeros(sequences * self.length, self.kind)
        room[:cut] = ids[:cut]
        mask = np.arange(len(room)) < cut
        for at in range(0, sequences, self.rows):
            part = slice(at * self.length, (at + self.rows) * self.length)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x[part]), self.length) for x in (room, mask)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.waiting, self.size = [ids[cut:]], len(ids) - cut


class StreamReader:
    """Random access to the sequences of one file."""

    def __init__(self, files: pyarrow.fs.FileSystem, path: str):
        local = isinstance(files, pyarrow.fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else files.open_input_file(path)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.source))
        self.length = int(self.schema.metadata[b"sequence_length"])
        self.rows = int(self.schema.metadata[b"batch_sequences"])
        self.first = self.source.tell()
        self.step = None
        self.at, self.held = -1, None

    def batch(self, number: int) -> pa.RecordBatch:
        """Record batch ``number``, by its computed place."""
        if number != self.at:
            if number and self.step is None:
                self.batch(0)
            self.source.seek(self.first + number * (self.step or 0))
            self.held = pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)
            if number == 0:
                self.step = self.source.tell() - self.first
            self.at = number
        return self.held

    def sequence(self, number: int) -> tuple[pa.Array, pa.Array]:
        """Ids and mask of one sequence, as views of the file where it is mapped."""
        batch, row = divmod(number, self.rows)
        return tuple(c.values.slice(row * self.length, self.length) for c in self.batch(batch).columns)

    def ids(self, start: int, count: int) -> Iterator[np.ndarray]:
        """``count`` ids from place ``start`` on, batch by batch."""
        per_batch = self.length * self.rows
        while count > 0:
            number, at = divmod(start, per_batch)
            held = self.batch(number).column(0).values.to_numpy()[at : at + count]
            if not len(held):
                raise EOFError(f"the file ends before id {start}")
            yield held
            start, count = start + len(held), count - len(held)


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = END_ID,
    length: int = SEQUENCE_LENGTH,
) -> DataFrame:
    """Write the ids of ``docs(doc_id, text)`` below ``folder`` and return the index, read back.

    ``folder`` is new and shared by all executors. Documents are in ascending doc_id order, NULL
    first; rows of one doc_id follow a hash of their text, so that many of them can be split over
    files. A NULL or empty text is one end id. Repeated rows are written each on their own. Other
    columns are not read. No rows: an empty index.
    """
    spark, out = docs.sparkSession, struct(INDEX)
    fields = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, known = TaskContext.get(), encoder(tokenizer)
        files, root = _open_folder(folder)
        files.create_dir(f"{root}/ids", recursive=True)
        number = context.partitionId()
        name = f"{root}/ids/part-{number:06d}.arrows"
        own = f"{root}/ids/_{number:06d}-{context.taskAttemptId()}"
        vocabulary = max(known.tokenizer.get_vocab_size(), end_id + 1)
        start, writer, sink = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                sink = files.open_output_stream(own)
                writer = StreamWriter(sink, vocabulary, length)
            texts = [t or "" for t in batch["text"].to_pylist()]
            starts, counts = [], []
            for ids in known.encode(texts):
                starts.append(start)
                counts.append(len(ids) + 1)
                writer.add(ids)
                writer.add(np.array([end_id], np.uint32))
                start += counts[-1]
            columns = [batch["doc_id"].to_pylist(), [name] * len(texts), [number] * len(texts), starts, counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields
            )
        if writer is not None:
            writer.close()
            sink.close()
            files.move(own, name)

    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = wanted.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text")
    )
    with_batch_bounds(ordered).mapInArrow(run, out).write.parquet(f"{folder}/index")
    return spark.read.schema(out).parquet(f"{folder}/index")


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files.

    Ids are read from the files and checked against the file's end; ``ids_crc32`` is of the ids as
    little-endian unsigned 32-bit integers. No rows: no rows.
    """

    def start():
        files, _ = _open_folder(folder)
        readers: dict[str, StreamReader] = {}

        def work(batch: pa.RecordBatch) -> dict:
            checks = []
            for name, at, count in zip(*(batch[c].to_pylist() for c in ("file", "start", "n_tokens"))):
                if name not in readers:
                    readers.clear()
                    readers[name] = StreamReader(files, name)
                check = 0
                for ids in readers[name].ids(at, count):
                    check = zlib.crc32(np.ascontiguousarray(ids, "<u4"), check)
                checks.append(check)
            return {c: batch[c] for c in batch.schema.names if c != "file"} | {"ids_crc32": checks}

        return work

    columns = {"doc_id": "bigint", "file": "string", "file_no": "int", "start": "bigint", "n_tokens": "bigint"}
    out = struct("doc_id bigint, file_no int, start bigint, n_tokens bigint, ids_crc32 bigint")
    read = map_rows(index, columns, out, start)
    # one row per file, bounded by the number of tasks
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = index.groupBy("file_no").agg(F.sum("n_tokens").alias("_n"))
    files = files.select("file_no", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return read.join(F.broadcast(files), "file_no").select(
        "doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32"
    )
