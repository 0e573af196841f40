"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers' tokens of a text are rows of a token-byte incidence matrix in compressed sparse rows (CSR).
The row products A.B^T of Gustavson's algorithm give the overlap links: every pair of tokens that share bytes,
with their number. Byte offsets where tokens of both end cut the text into groups; the products of the
group-incidence matrices give the shared-group links.

Texts are handled in groups of bounded size, which stand side by side in one pair of matrices. Words repeat, so
a worker tokenizes a word once and keeps its ids; a text is parted only where its tokenizer certainly cuts.

How often a pair of ids is linked in all texts is counted by Spark and comes back to the texts in blocks of
sorted arrays of bounded size, one pass each; the sums over a text's links are added up over blocks.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspark.llm.common import map_rows, read_once, struct
from termspark.llm.tokens import Encoder, _byte_letters

# pairs of ids whose counts are sent to the tasks at once: 17 bytes each
BLOCK_PAIRS = 4_000_000
# Words kept in each of the two generations of each of a worker's caches; this bounds the memory, as does the
# length of a word worth keeping. Words that come once fill most of a larger cache.
CACHED_WORDS = 30_000
LONGEST_CACHED = 64
# characters of text tokenized, and aligned, at once
GROUP_CHARS = 1 << 20
ALIGNED_CHARS = 1 << 16

# a space that is not the first of its run, or of the text
_LATER_SPACE = re.compile(r"(?<=[^ ]) ")



class Csr:
    """A sparse matrix of counts in compressed rows."""

    __slots__ = ("starts", "columns", "values", "width")

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.starts, self.columns, self.values, self.width = starts, columns, values, width

    @classmethod
    def of_runs(cls, starts: np.ndarray, width: int) -> Csr:
        """Row i has ones in the columns from ``starts[i]`` to ``starts[i + 1] - 1``."""
        return cls(starts, np.arange(starts[0], starts[-1]), np.ones(starts[-1] - starts[0], np.int64), width)

    def transposed(self) -> Csr:
        """Rows and columns exchanged, by counting the entries of each column."""
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate(([0], np.cumsum(np.bincount(self.columns, minlength=self.width))))
        return Csr(starts, rows[order], self.values[order], len(self.starts) - 1)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of ``other``'s rows k, scaled by the entries (i, k) of this one.

        All rows at once: the scaled rows of ``other`` are laid out in the order of this matrix's
        entries, then equal columns of a row are added up.
        """
        taken = np.diff(other.starts)[self.columns]
        ends = np.cumsum(taken)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(other.starts[self.columns] - (ends - taken), taken)
        rows = np.repeat(np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)), taken)
        cells = rows * other.width + other.columns[at]
        values = np.repeat(self.values, taken) * other.values[at]
        if len(cells) and (np.diff(cells) < 0).any():
            order = np.argsort(cells, kind="stable")
            cells, values = cells[order], values[order]
        first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1]))) if total else np.zeros(0, np.int64)
        kept = cells[first] if total else cells
        sums = np.add.reduceat(values, first) if total else values
        starts = np.searchsorted(kept // max(other.width, 1), np.arange(len(self.starts)))
        return Csr(starts, kept % max(other.width, 1), sums, other.width)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and value of every entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)), self.columns, self.values


def _edges(lengths: np.ndarray) -> np.ndarray:
    """Where each of consecutive runs begins, and the end."""
    return np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)


def align(a_lengths: np.ndarray, b_lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Links of two tokenizations of the same bytes, given the tokens' byte lengths (all over 0).

    ``a, b, shared`` are the overlap links and the bytes they share; ``ended`` tells the links whose tokens
    end together. ``a_group, b_group`` are the tokens' groups; ``group_a, group_b`` the shared-group links.
    """
    a_edges, b_edges = _edges(a_lengths), _edges(b_lengths)
    size = int(a_edges[-1])
    a_bytes, b_bytes = Csr.of_runs(a_edges, size), Csr.of_runs(b_edges, size)
    a, b, shared = a_bytes.times(b_bytes.transposed()).entries()
    ended = a_edges[a + 1] == b_edges[b + 1]
    # a group ends where such a link does
    a_ends, b_ends = a[ended], b[ended]
    a_groups = Csr.of_runs(np.concatenate(([0], a_ends + 1)), len(a_lengths))
    b_groups = Csr.of_runs(np.concatenate(([0], b_ends + 1)), len(b_lengths))
    group_a, group_b, _ = a_groups.transposed().times(b_groups).entries()
    return {
        "a": a,
        "b": b,
        "shared": shared,
        "ended": ended,
        "a_group": np.repeat(np.arange(len(a_ends)), np.diff(a_groups.starts)),
        "b_group": np.repeat(np.arange(len(b_ends)), np.diff(b_groups.starts)),
        "group_a": group_a,
        "group_b": group_b,
    }


class PieceEncoder:
    """Ids of whole texts by a piece vocabulary, with a cache of words.

    No piece has a space but at its start, so no piece reaches over the beginning of a run of spaces: a text is
    parted there. A vocabulary with other pieces, and a text with the space's own sign, are not parted.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.width = self.model.get_piece_size()
        names = [self.model.id_to_piece(n) for n in range(self.width)]
        self.tokens = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(n) else name.replace("▁", " ").encode()
            for n, name in enumerate(names)
        ]
        self.parted = not any("▁" in name.lstrip("▁") for name in names)
        # a text that ends in a single space ends in the piece of that space
        self.young: dict[str, bytes] = {"": array("i", [self.model.piece_to_id("▁")]).tobytes()}
        self.old: dict[str, bytes] = {}

    def _ids(self, words: list[str]) -> list[bytes]:
        """The 32-bit ids of distinct words."""
        known = list(map(self.young.get, words))
        missing = [n for n, ids in enumerate(known) if ids is None]
        for n in missing:
            known[n] = self.old.get(words[n])
        new = [n for n in missing if known[n] is None]
        for first in range(0, len(new), CACHED_WORDS):
            part = new[first : first + CACHED_WORDS]
            for n, ids in zip(part, self.model.encode([words[n] for n in part], num_threads=1)):
                known[n] = array("i", ids).tobytes()
        for n in missing:
            if len(words[n]) <= LONGEST_CACHED:
                if len(self.young) >= CACHED_WORDS:
                    self.old, self.young = self.young, {"": self.young[""]}
                self.young[words[n]] = known[n]
        return known

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, which must not be empty."""
        marked = []
        for text in texts:
            if not self.parted or "\0" in text or "▁" in text:
                marked.append(None)
            elif "  " in text or text[0] == " ":
                marked.append(_LATER_SPACE.sub("\0", text))
            else:
                marked.append(text.replace(" ", "\0"))
        split = pc.split_pattern(pa.array(marked, pa.large_string()), "\0")
        words = split.flatten().dictionary_encode()
        made = self._ids(words.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(made), "<i4")
        lengths = np.fromiter(map(len, made), np.int64, len(made)) // 4
        codes = words.indices.to_numpy()
        dealt = flat[_dealt(_edges(lengths), codes)]
        cuts = _edges(lengths[codes])
        counts = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
        ends = cuts[np.cumsum(counts)]
        out, begin = [], 0
        for text, given, end in zip(texts, marked, ends.tolist()):
            out.append(np.array(self.model.encode(text), "<i4") if given is None else dealt[begin:end])
            begin = end
        return out


def _dealt(edges: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of the entries of the runs named by ``codes``, one run after the other."""
    counts = np.diff(edges)[codes]
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(edges[codes] - (ends - counts), counts)


class Aligner:
    """Tokenizes texts by a byte-level file (A) and a piece file (B), and aligns the tokens."""

    def __init__(self, byte_level: str, pieces: str):
        self.a, self.b = Encoder(byte_level, CACHED_WORDS), PieceEncoder(pieces)
        # strings of special tokens inside texts are plain text
        self.a.tokenizer.encode_special_tokens = True
        letters = {chr(c): bytes([b]) for b, c in _byte_letters().items()}
        a_tokens: list[bytes] = [b""] * self.a.tokenizer.get_vocab_size()
        for token, n in self.a.tokenizer.get_vocab().items():
            a_tokens[n] = b"".join(letters.get(c, c.encode()) for c in token)
        self.tokens = (a_tokens, self.b.tokens)
        self.edges = [_edges(np.array([len(t) for t in tokens])) for tokens in self.tokens]
        self.bytes = [np.frombuffer(b"".join(tokens), np.uint8) for tokens in self.tokens]
        # ids with the sign that may follow them in a text of groups
        names = [str(n).encode() for n in range(max(map(len, self.tokens)))]
        self.names = np.array([n + sign for sign in (b",", b"|", b";") for n in names], object)
        self.signs = len(names)

    def lengths(self, side: int, ids: np.ndarray) -> np.ndarray:
        return np.diff(self.edges[side])[ids]

    def _spelt(self, side: int, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of tokens."""
        return self.bytes[side][_dealt(self.edges[side], ids)]

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Both tokenizers' ids of each text with a space before it; None if the bytes of one differ from it."""
        given = [f" {t}".encode() for t in texts]
        ours, theirs = self.a.encode([f" {t}" for t in texts]), self.b.encode(texts)
        whole = np.frombuffer(b"".join(given), np.uint8)
        sizes = np.array([len(g) for g in given])
        good = np.ones(len(texts), bool)
        for side, found in enumerate((ours, theirs)):
            flat = np.concatenate(found).astype(np.int64)
            spelt = self._spelt(side, flat)
            places = _edges(self.lengths(side, flat))[_edges(np.array([len(f) for f in found]))]
            good &= np.diff(places) == sizes
            if len(spelt) == len(whole) and good.all():
                good &= np.add.reduceat(spelt != whole, places[:-1]) == 0
            else:
                at = _edges(sizes)
                good &= [
                    same and np.array_equal(spelt[places[n] : places[n + 1]], whole[at[n] : at[n + 1]])
                    for n, same in enumerate(good.tolist())
                ]
        return [(a, b) if same else None for a, b, same in zip(ours, theirs, good.tolist())]

    def digests(self, texts: list[str]) -> list[tuple[int, int, np.ndarray, str]]:
        """(n_a, n_b, codes of the links that end together, digest of the groups) of each text."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > GROUP_CHARS:
                out += self._digests(group)
                group, size = [], 0
        return out + self._digests(group) if group else out

    def _digests(self, texts: list[str]) -> list[tuple[int, int, np.ndarray, str]]:
        shown = [n for n, t in enumerate(texts) if t]
        out = [(0, 0, np.zeros(0, np.int64), "")] * len(texts)
        found = [(n, f) for n, f in zip(shown, self.ids([texts[n] for n in shown]) if shown else []) if f is not None]
        part, size = [], 0
        for n, ids in found:
            part.append((n, ids))
            size += len(texts[n])
            if size > ALIGNED_CHARS:
                self._aligned(part, out)
                part, size = [], 0
        if part:
            self._aligned(part, out)
        return out

    def _aligned(self, found: list[tuple[int, tuple[np.ndarray, np.ndarray]]], out: list) -> None:
        """The digests of texts by both tokenizers' ids, put at their places of ``out``."""
        a_ids, b_ids = (np.concatenate([f[side] for _, f in found]).astype(np.int64) for side in (0, 1))
        a_edges, b_edges = (_edges(np.array([len(f[side]) for _, f in found])) for side in (0, 1))
        links = align(self.lengths(0, a_ids), self.lengths(1, b_ids))
        last_a, last_b = links["a"][links["ended"]], links["b"][links["ended"]]
        codes = a_ids[last_a] * self.b.width + b_ids[last_b]
        # the groups of a text end with it, as its bytes are the same for both
        cuts = np.searchsorted(last_a, a_edges)
        # tokens in the order of the groups, A before B, each with the sign after it
        signs_a, signs_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        signs_a[last_a], signs_b[last_b] = self.signs, 2 * self.signs
        named = np.empty(len(a_ids) + len(b_ids), np.int64)
        before_b = np.concatenate(([0], last_b + 1))[:-1]
        named[np.arange(len(a_ids)) + before_b[links["a_group"]]] = a_ids + signs_a
        named[np.arange(len(b_ids)) + (last_a + 1)[links["b_group"]]] = b_ids + signs_b
        shown_names = self.names[named].tolist()
        ends = (a_edges + b_edges).tolist()
        for i, (n, (a, b)) in enumerate(found):
            digest = hashlib.sha256(b"".join(shown_names[ends[i] : ends[i + 1]])[:-1]).hexdigest()
            out[n] = (len(a), len(b), codes[cuts[i] : cuts[i + 1]], digest)


@cache
def aligner(byte_level: str, pieces: str) -> Aligner:
    """One aligner for each worker process, as its cache is worth keeping between tasks."""
    return Aligner(byte_level, pieces)


DETAILS = (
    "a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>, "
    "overlaps array<struct<a: int, b: int, bytes: int>>, together array<struct<a: int, b: int>>, "
    "shared_groups array<struct<a: int, b: int>>"
)


def align_tokens(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Both tokenizations of every text with all links: ``doc_id``, ids, groups, and links by token places.

    ``overlaps`` are pairs of tokens with the number of bytes they share, ``together`` those that end
    together, ``shared_groups`` all pairs of one group. A NULL or empty text, and one that a
    tokenizer does not give back byte by byte, has no tokens and no links. Rows are kept one by one,
    repeated and NULL doc_ids too; other columns are not read; an empty table gives no rows.
    """

    def start():
        tool = aligner(byte_level, pieces)

        def work(batch: pa.RecordBatch) -> dict:
            made: dict[str, list] = {f.name: [] for f in out}
            for text in batch["text"].to_pylist():
                found = tool.ids([text])[0] if text else None
                links = align(*(tool.lengths(side, ids) for side, ids in enumerate(found))) if found else None
                rows: dict[str, list] = {name: [] for name in made}
                if links is not None:
                    pairs = list(zip(links["a"].tolist(), links["b"].tolist()))
                    rows = {
                        "a_ids": found[0],
                        "b_ids": found[1],
                        "a_group": links["a_group"],
                        "b_group": links["b_group"],
                        "overlaps": [(i, k, n) for (i, k), n in zip(pairs, links["shared"].tolist())],
                        "together": [p for p, e in zip(pairs, links["ended"].tolist()) if e],
                        "shared_groups": list(zip(links["group_a"].tolist(), links["group_b"].tolist())),
                    }
                for name, values in made.items():
                    values.append(rows[name])
            structs = {"overlaps": ("a", "b", "bytes"), "together": ("a", "b"), "shared_groups": ("a", "b")}
            for name, keys in structs.items():
                made[name] = [[dict(zip(keys, r)) for r in row] for row in made[name]]
            return made

        return work

    out = struct(DETAILS)
    made = map_rows(docs, {"text": "string"}, out, start, ["doc_id"])
    return made.select("_row.doc_id", *[f.name for f in out])


def _linked(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """``doc_id, n_a, n_b, groups_sha256`` and ``links``, the codes a * width + b of links that end together."""

    def start():
        tool = aligner(byte_level, pieces)

        def work(batch: pa.RecordBatch) -> dict:
            found = tool.digests([t or "" for t in batch["text"].to_pylist()])
            codes = np.concatenate([f[2] for f in found])
            offsets = _edges(np.array([len(f[2]) for f in found])).astype(np.int32)
            values = pa.array(codes.astype(np.int32 if small else np.int64))
            return {
                "n_a": [f[0] for f in found],
                "n_b": [f[1] for f in found],
                "groups_sha256": [f[3] for f in found],
                "links": pa.ListArray.from_arrays(pa.array(offsets), values),
            }

        return work

    tool = aligner(byte_level, pieces)
    small = len(tool.tokens[0]) * tool.b.width < 1 << 31
    kind = "int" if small else "bigint"
    out = struct(f"n_a bigint, n_b bigint, groups_sha256 string, links array<{kind}>")
    made = map_rows(docs, {"text": "string"}, out, start, ["doc_id"])
    return made.select("_row.doc_id", *[f.name for f in out])


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: how many links hold a pair of ids, and whether that is the most of its B id."""
    counts = linked.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = counts.select(F.col("pair").cast("bigint").alias("pair"), "n")
    counts, _ = read_once(counts.withColumn("b", F.col("pair") % width), "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(linked: DataFrame, table: pa.Table) -> DataFrame:
    """``linked`` rows with ``n_best`` and ``count_sum`` over their links in a block of pairs."""
    pairs, counts = table["pair"].to_numpy(), table["n"].to_numpy()
    best = table["best"].to_numpy(zero_copy_only=False)
    # in one array each, sorted, as closures reach the tasks by broadcast if they are large
    held = linked.sparkSession.sparkContext.broadcast((pairs, counts, best))

    def start():
        known, sums, tops = held.value

        def work(batch: pa.RecordBatch) -> dict:
            lists = batch["links"]
            flat = lists.flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
            here = known[at] == flat
            edges = _edges(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            totals = [np.concatenate(([0], np.cumsum(np.where(here, v[at], 0)))) for v in (tops.astype(np.int64), sums)]
            n_best, count_sum = (np.diff(t[edges]) for t in totals)
            return {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}

        return work

    out = struct("n_best bigint, count_sum bigint")
    columns = {"links": linked.schema["links"].dataType.simpleString()}
    return map_rows(linked, columns, out, start, [c for c in linked.columns if c != "links"])


def alignment_report(docs: DataFrame, byte_level: str, pieces: str, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: tokens, groups, links that end together, and their counts.

    ``n_best`` counts the links whose pair of ids is linked as often as any of its B id in all texts;
    ``count_sum`` adds up how often the pairs of a text's links are linked. Texts without tokens (see
    ``align_tokens``) have zeros and an empty ``groups_sha256``. Rows are kept one by one; other columns
    are not read; an empty table gives no rows.
    """
    width = aligner(byte_level, pieces).b.width
    found = _linked(docs, byte_level, pieces)
    linked, _ = read_once(found.withColumn("at", F.monotonically_increasing_id()), "links")
    counts, _ = read_once(pair_counts(linked, width), "pair-counts")
    total = counts.count()
    keys = ["doc_id", "n_a", "n_b", "groups_sha256", "n_links", "at"]
    linked = linked.withColumn("n_links", F.size("links").cast("bigint"))
    if total <= block_pairs:
        made = _sums(linked, counts.orderBy("pair").toArrow()) if total else None
    else:
        made = _in_blocks(linked, counts, -(-total // block_pairs))
    if made is None:
        zero = F.lit(0).cast("bigint")
        found = linked.select(*keys, zero.alias("n_best"), zero.alias("count_sum"))
    else:
        found = made.select(*[F.col(f"_row.{k}").alias(k) for k in keys], "n_best", "count_sum")
    # no token is empty, so exactly one link ends each group
    return found.select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256"
    )


def _in_blocks(linked: DataFrame, counts: DataFrame, blocks: int) -> DataFrame:
    """The sums of ``_sums`` where the pairs need several blocks: one pass for each, added up by row."""
    block = F.pmod(F.xxhash64("pair"), F.lit(blocks))
    parts = None
    for n in range(blocks):
        table = counts.filter(block == n).orderBy("pair").toArrow()
        if table.num_rows:
            made = _sums(linked, table)
            parts = made if parts is None else parts.unionByName(made)
    sums = parts.groupBy("_row.at").agg(
        F.first("_row").alias("_row"), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return sums

