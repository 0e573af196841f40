"""Benchmark decontamination by windows of words.

Every benchmark item is cut into windows of ``n`` consecutive words. The distinct windows are gathered
as a set of hashes, with the words themselves behind each hash, and sent to every task, which looks
for them in the word windows of each training text, verifies the words of every hit, and marks the
words that stand inside one. Documents, or only the marked spans, can then be removed.

The set is bounded: a benchmark of more than ``BLOCK_WORDS`` words is dealt by a hash of its windows
into blocks of that size, the texts are scanned once per block, and the finds are merged.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspark.llm.common import WORD_BYTES, map_rows, read_once, struct, texts_of, words_of

WINDOW_WORDS = 10
# words of all windows in one broadcast set; about 50 bytes each in a task
BLOCK_WORDS = 4_000_000

FOUND = "n_words bigint, positions array<int>, items array<string>"


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """``(window, items)``: every distinct window with the sorted ids, as text, of the items that have it.

    An item of fewer than ``n`` words is one window; one without words, or with a NULL text, has none.
    A NULL item_id is not listed, but its windows count.
    """

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            windows = []
            for text in texts_of(batch["text"]):
                words = words_of(text)
                places = range(max(1, len(words) - n + 1)) if words else ()
                windows.append([b" ".join(words[i : i + n]).decode() for i in places])
            return {"item": batch["item"], "windows": windows}

        return work

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    rows = map_rows(items, {"item": "string", "text": "binary"}, struct("item string, windows array<string>"), start)
    exploded = rows.select("item", F.explode("windows").alias("window")).distinct()
    return exploded.groupBy("window").agg(F.sort_array(F.collect_list("item")).alias("items"))


class WindowSet:
    """Finds windows in word lists: by hash first, then by the words."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        self.words: dict[bytes, int] = {}
        self.items: dict[bytes, list[str]] = {}
        by_length: dict[int, list[np.ndarray]] = {}
        for window, items in windows:
            words = [self.words.setdefault(w, len(self.words)) for w in window.encode().split(b" ")]
            ids = np.array(words, np.int32)
            self.items[ids.tobytes()] = items
            by_length.setdefault(len(ids), []).append(ids)
        self.hashes = {n: np.unique(self._hash(np.array(ids))) for n, ids in by_length.items()}

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        """A 64-bit polynomial hash of each row of word numbers."""
        made = np.zeros(len(rows), np.uint64)
        for column in rows.T:
            made = (made + column.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return made

    def find(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Places of the words inside any window, and the items whose windows occur."""
        ids = np.fromiter(map(self.words.get, words, repeat(-1)), np.int32, len(words))
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        hit, items = np.zeros(len(words), bool), set()
        for n, hashes in self.hashes.items():
            # only windows whose every word is in some benchmark item
            places = np.flatnonzero(known[n:] - known[:-n] == n) if len(words) >= n else ()
            if len(places):
                rows = ids[places[:, None] + np.arange(n)]
                likely = np.isin(self._hash(rows), hashes)
                for place, row in zip(places[likely].tolist(), rows[likely]):
                    if (owners := self.items.get(row.tobytes())) is not None:
                        hit[place : place + n] = True
                        items.update(owners)
        return np.flatnonzero(hit), sorted(items)


def _scan(docs: DataFrame, windows: list[tuple[str, list[str]]], keep: list[str]) -> DataFrame:
    """FOUND, and ``_row`` of the kept columns, for every row of ``docs``, for one set of windows."""
    sent = docs.sparkSession.sparkContext.broadcast(windows)

    def start():
        known = WindowSet(sent.value)

        def work(batch: pa.RecordBatch) -> dict:
            counts, positions, items = [], [], []
            for text in texts_of(batch["text"]):
                words = words_of(text)
                places, owners = known.find(words)
                counts.append(len(words))
                positions.append(places.tolist())
                items.append(owners)
            return {"n_words": counts, "positions": positions, "items": items}

        return work

    return map_rows(docs, {"text": "binary"}, struct(FOUND), start, keep)


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], n: int = WINDOW_WORDS) -> DataFrame:
    """``n_words``, ``positions``, ``items`` and ``_row`` (the columns in ``keep``) for every row of ``docs``.

    ``positions`` are the word numbers inside any occurrence of a window, ``items`` the item ids, as
    text, whose windows occur. A NULL text has no words. Repeated rows stay; no benchmark, no finds.
    """
    windows, _ = read_once(benchmark_windows(benchmark, n), "windows")
    words = windows.agg(F.sum(F.size(F.split("window", " ")) + F.size("items"))).first()[0] or 0
    blocks = -(-words // BLOCK_WORDS)
    if blocks <= 1:
        return _scan(docs, [tuple(r) for r in windows.collect()], keep)
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_given")
    numbered, _ = read_once(
        docs.select(F.monotonically_increasing_id().alias("_at"), F.col("`text`").alias("text"), row), "numbered"
    )
    scans = []
    for block in range(blocks):
        own = windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        found = _scan(numbered, [tuple(r) for r in own.collect()], ["_at"])
        scans.append(found.select("_row._at", "n_words", "positions", "items"))
    every = scans[0]
    for scan in scans[1:]:
        every = every.unionByName(scan)
    merged = every.groupBy("_at").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("positions"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.join(numbered, "_at").select("n_words", "positions", "items", F.col("_given").alias("_row"))


def contamination_report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, one row per row of ``docs``.

    ``items_sha256`` is of the item ids, sorted as text and joined by commas (of the empty text if
    there are none).
    """
    found = find_contamination(docs, benchmark, ["doc_id"], n)
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_words",
        F.size("positions").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("positions") > 0).alias("contaminated"),
    )


_WORD = re.compile(rb"[^ ]+")


def cut_words(text: bytes, positions: list[int]) -> bytes:
    """``text`` without the spans of the given words, from the first to the last byte of each run."""
    spans = [m.span() for m in _WORD.finditer(text.translate(WORD_BYTES))]
    parts, at, wanted = [], 0, set(positions)
    for n, (begin, end) in enumerate(spans):
        if n in wanted:
            # what stands between two marked words goes with them
            parts.append(text[at:begin] if n - 1 not in wanted else b"")
            at = end
    return b"".join([*parts, text[at:]])


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, action: str = "documents", n: int = WINDOW_WORDS
) -> DataFrame:
    """``docs`` without contaminated documents, or, with ``action="spans"``, without the marked spans.

    Columns are those of ``docs``, whatever their names. Documents without a hit stay as they are.
    """
    if action not in ("documents", "spans"):
        raise ValueError(f"unknown action {action!r}")
    found = find_contamination(docs, benchmark, docs.columns, n)
    if action == "documents":
        return found.filter(F.size("positions") == 0).select("_row.*")

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            pairs = zip(batch["text"].to_pylist(), batch["positions"].to_pylist())
            return {"cut": [cut_words(t, p).decode() if t and p else None for t, p in pairs]}

        return work

    texts = found.select(F.col("_row.text").alias("text"), "positions", "_row")
    cut = map_rows(texts, {"text": "binary", "positions": "array<int>"}, struct("cut string"), start, texts.columns)
    # an unmarked text keeps its own value
    changed = F.when(F.size("_row.positions") > 0, F.col("cut")).otherwise(F.col("_row._row.text"))
    return cut.select(
        *[changed.alias(c) if c == "text" else F.col(f"_row._row.`{c}`").alias(c) for c in docs.columns]
    )
