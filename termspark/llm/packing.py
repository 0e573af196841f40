"""Hierarchical multi-length packing of token sequences.

Every document is encoded whole and ended by an id. Whole windows of the longest context size are cut
from it first. What is left is routed to the smallest context size that holds it; then each tier is
packed from the longest to the shortest: a window is opened with the tier's longest piece, its gap is
filled with the longest piece of the same or a shorter tier that fits, and when none fits, the
shortest longer one is cut to close it. So every window is full, whatever its tier. Pieces that fill
no window wait for the next documents of the task; at its end they are cut into powers of two.

A task reads its documents one group at a time and needs no shuffle: what it holds is one group's ids
and less than one window per tier of waiting pieces. Its ids start with its own number, so a lost task
gives the same rows again when it is repeated on the same input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from termspark.llm.common import release, struct, with_batch_bounds
from termspark.llm.tokens import encoder

CONTEXT_SIZES = (1024, 512, 256, 128)
END_ID = 0
# sequences of one tier that make one training step
STEP_SEQUENCES = 32
# tokens encoded before a group is packed; bounds a task's memory, but for one document
GROUP_TOKENS = 1 << 20
# the task's number stands above this bit of a sequence's or step's number
TASK_BIT = 33

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, step_group bigint"
)


class _Piece:
    """Ids of one document from ``start`` on."""

    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc, ids: np.ndarray, start: int, total: int):
        self.doc, self.ids, self.start, self.total = doc, ids, start, total

    def cut(self, length: int) -> tuple[_Piece, _Piece]:
        return (
            _Piece(self.doc, self.ids[:length], self.start, self.total),
            _Piece(self.doc, self.ids[length:], self.start + length, self.total),
        )


class _Pool:
    """Waiting pieces by length; bit n of ``lengths`` says whether there is one of n ids."""

    def __init__(self):
        self.by_length: dict[int, list[_Piece]] = {}
        self.lengths = 0
        self.tokens = 0

    def add(self, piece: _Piece) -> None:
        n = len(piece.ids)
        self.by_length.setdefault(n, []).append(piece)
        self.lengths |= 1 << n
        self.tokens += n

    def take(self, length: int) -> _Piece:
        same = self.by_length[length]
        piece = same.pop()
        if not same:
            self.lengths &= ~(1 << length)
        self.tokens -= length
        return piece

    def longest(self, limit: int) -> int:
        """The largest length up to ``limit``; 0 if there is none."""
        found = self.lengths & ((1 << (limit + 1)) - 1)
        return found.bit_length() - 1 if found else 0

    def shortest_above(self, limit: int) -> int:
        found = self.lengths >> (limit + 1)
        return limit + 1 + (found & -found).bit_length() - 1 if found else 0


class Packer:
    """Packs groups of documents; ``sequences`` gathers (tier, pieces)."""

    def __init__(self, sizes: tuple[int, ...]):
        self.sizes = tuple(sorted(sizes, reverse=True))
        self.pool = _Pool()
        self.sequences: list[tuple[int, list[_Piece]]] = []

    def add(self, doc, ids: np.ndarray) -> None:
        """Cut whole windows of the longest size off a document; the rest waits."""
        rest, top = _Piece(doc, ids, 0, len(ids)), self.sizes[0]
        while len(rest.ids) >= top:
            window, rest = rest.cut(top)
            self.sequences.append((top, [window]))
        if len(rest.ids):
            self.pool.add(rest)

    def pack(self) -> None:
        """Fill windows of every tier, as long as the waiting pieces can fill one."""
        for size, shorter in zip(self.sizes, (*self.sizes[1:], 0), strict=True):
            while self.pool.tokens >= size and (length := self.pool.longest(size)) > shorter:
                self.sequences.append((size, self._fill(size, length)))

    def _fill(self, size: int, length: int) -> list[_Piece]:
        pieces = [self.pool.take(length)]
        gap = size - length
        while gap:
            if length := self.pool.longest(gap):
                pieces.append(self.pool.take(length))
                gap -= length
            else:
                piece, rest = self.pool.take(self.pool.shortest_above(gap)).cut(gap)
                pieces.append(piece)
                self.pool.add(rest)
                gap = 0
        return pieces

    def finish(self) -> None:
        """Cut what is left into windows of powers of two."""
        self.pack()
        while self.pool.tokens:
            size = min(1 << (self.pool.tokens.bit_length() - 1), self.sizes[0])
            length = self.pool.longest(size) or self.pool.shortest_above(size)
            if length > size:
                piece, rest = self.pool.take(length).cut(size)
                self.pool.add(rest)
                self.sequences.append((size, [piece]))
            else:
                self.sequences.append((size, self._fill(size, length)))


def step_numbers(sequences: list[tuple[int, list[_Piece]]], per_step: int) -> list[int]:
    """A step for each sequence: equal counts per tier, and near-equal sums of squared piece lengths.

    Sequences of a tier are dealt to its steps from the costliest on, back and forth.
    """
    steps = [0] * len(sequences)
    first = 0
    tiers: dict[int, list[int]] = {}
    for n, (tier, _) in enumerate(sequences):
        tiers.setdefault(tier, []).append(n)
    for _, members in sorted(tiers.items(), reverse=True):
        count = -(-len(members) // per_step)
        members.sort(key=lambda n: (-sum(len(p.ids) ** 2 for p in sequences[n][1]), n))
        for place, n in enumerate(members):
            turn, at = divmod(place, count)
            steps[n] = first + (at if turn % 2 == 0 else count - 1 - at)
        first += count
    return steps


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    sizes: tuple[int, ...] = CONTEXT_SIZES,
    end_id: int = END_ID,
    with_ids: bool = False,
    cached: int | None = None,
) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``; ``tokenizer`` is the path of a tokenizers file.

    A worker's encoder keeps up to about four times ``cached`` words (as a rule ``tokens.CACHED_WORDS``).

    Columns: doc_id, start (ids of the document before the piece), length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), doc_tokens (with the end id), sequence_id, offset (place
    in the sequence), tier (the sequence's context size), step_group, and ids with ``with_ids``.

    A NULL or empty text is one end id. A NULL doc_id stays NULL. Repeated rows are packed each on
    their own. Very long texts become many windows. Other columns are not read. No rows: no rows.
    """
    if any(s < 1 or s & (s - 1) for s in sizes):
        raise ValueError("context sizes are powers of two")
    out = struct(PIECES + (", ids array<bigint>" if with_ids else ""))
    fields = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(tokenizer, cached).encode, TaskContext.get().partitionId() << TASK_BIT
        packer, done, steps = Packer(sizes), 0, 0

        def rows() -> pa.RecordBatch:
            nonlocal done, steps
            packed, packer.sequences = packer.sequences, []
            columns: dict[str, list] = {name: [] for name in fields.names}
            numbers = step_numbers(packed, STEP_SEQUENCES)
            for (tier, pieces), step in zip(packed, numbers, strict=True):
                offset = 0
                for p in pieces:
                    made = (p.doc, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.total,
                            task + done, offset, tier, task + steps + step, p.ids)
                    for name, value in zip(fields.names, made):
                        columns[name].append(value)
                    offset += len(p.ids)
                done += 1
            steps += max(numbers, default=-1) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in fields], schema=fields
            )

        waiting = 0
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for doc, ids in zip(batch["doc_id"].to_pylist(), encode(texts), strict=True):
                packer.add(doc, np.append(ids, np.uint32(end_id)).astype("<u4"))
                waiting += len(ids) + 1
                if waiting > GROUP_TOKENS:
                    packer.pack()
                    yield rows()
                    waiting = 0
            release()
        packer.finish()
        yield rows()

    wanted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_batch_bounds(wanted).mapInArrow(run, out)
