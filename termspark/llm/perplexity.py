"""Quality rules: counts over whole texts, and perplexity bands of a modified Kneser-Ney model of each language.

The model is one of characters, of order 5, for each value of the language column; it is counted over all
texts. A text's characters are those of its words, A-Z lower-cased and digits as 0, with single spaces between and
a start sign before. Tasks count the five-character sequences of their texts, Spark adds them up; the
continuation counts of the lower orders, the discounts of each order (Chen and Goodman's D1, D2 and D3+ from
how many sequences occur once to four times) and the interpolated probabilities follow from these tables by
joins. The model grows with the corpus and is not cut anywhere.

For scoring, its sequences become sorted arrays of 64-bit hashes with log-probabilities and back-off weights.
They are sent to the tasks in blocks of bounded size. What is needed for a character depends on the two before it,
so each block has all sequences for some of these pairs; if there are several blocks, each goes over all texts
and the sums are added up.

A text is kept if its perplexity lies in its language's band: between quartiles widened by a multiple of their
distances from the median.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspark.llm.common import map_rows, read_once, struct, texts_of
from termspark.session import drop_staged

ORDER = 5
# --- fixed values of the base rules ---
MIN_WORDS = 50
WINDOW_WORDS = 3
SYMBOLS = b"#*$%&|<>"
# --- end of fixed values ---

# the band reaches so many times as far from the median as the quartile does, and at least so far in logarithms
BAND_WIDTH = 8.0
LEAST_WIDTH = 0.1
# sequences of a block: 16 bytes each
BLOCK_ENTRIES = 4_000_000
# different sequences that a counting task holds before it hands them on
HELD_SEQUENCES = 1_000_000
# bytes of text whose characters are handled at once
GROUP_BYTES = 1 << 20
START = "\n"

# --- fixed value: ASCII letters in lower case, digits as 0, white space as spaces ---
FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 32 if b in b"\t\n\x0b\x0c\r" else b for b in range(256)
)


def base_counts(text: bytes) -> dict[str, int]:
    """Words, their characters, symbols, repeated lines, and words in repeated windows of a UTF-8 text."""
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(*(words[i:] for i in range(WINDOW_WORDS))))
    found = 0
    if len(set(windows)) < len(windows):
        uses, covered = Counter(windows), 0
        for at, window in enumerate(windows):
            if uses[window] > 1:
                found += at + WINDOW_WORDS - max(at, covered)
                covered = at + WINDOW_WORDS
    return {
        "n_words": len(words),
        # bytes that begin a character
        "word_chars": len(joined) - len(joined.translate(None, bytes(range(0x00, 0x80)) + bytes(range(0xC0, 0x100)))),
        "n_symbols": len(joined) - len(joined.translate(None, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": found,
    }


def codes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of folded texts one after the other, each behind ORDER - 1 start signs, and the texts' edges."""
    head = (START * (ORDER - 1)).encode()
    folded = [head + b" ".join(t.translate(FOLDED).split()) for t in texts]
    sizes = np.array([len(f) for f in folded], np.int64)
    raw = np.frombuffer(b"".join(folded), np.uint8)
    # characters begin at all bytes but those of the form 10xxxxxx
    begins = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    edges = begins[np.concatenate(([0], np.cumsum(sizes)))]
    codes = np.frombuffer(b"".join(folded).decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    return codes.astype(np.uint64), edges


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads all of them."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def hashes_of(codes: np.ndarray, order: int, seed: int) -> np.ndarray:
    """Hashes of the ``order`` codes that end at each place (the first places wrap around and mean nothing)."""
    found = np.full(len(codes), seed * 8 + order, np.uint64)
    for back in range(order - 1, -1, -1):
        found = mixed(found * _FACTOR + (np.roll(codes, back) if back else codes))
    return found


def sequence_hashes(sequences: list[str], order: int, seeds: np.ndarray) -> np.ndarray:
    """The same hashes of given sequences of one order."""
    codes = np.frombuffer("".join(sequences).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(-1, order)
    found = seeds.astype(np.uint64) * np.uint64(8) + np.uint64(order)
    for column in range(order):
        found = mixed(found * _FACTOR + codes[:, column])
    return found


# --- counting ---


def count_sequences(docs: DataFrame) -> DataFrame:
    """``lang, seq, n`` of all five-character sequences of ``docs(lang, text)`` that end in a character of a text.

    A task adds its texts' sequences up before it hands them on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (keys, sums, codes) in held.items():
                texts = np.ascontiguousarray(codes).astype("<u4").tobytes().decode("utf-32-le")
                seqs = [texts[i : i + ORDER] for i in range(0, len(texts), ORDER)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(seqs), pa.string()), pa.array(seqs, pa.string()), pa.array(sums)],
                    names=["lang", "seq", "n"],
                )
            held.clear()

        for batch in batches:
            by_lang: dict = {}
            for lang, text in zip(batch["lang"].to_pylist(), texts_of(batch["text"])):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for group in in_groups(texts):
                    merge(held, lang, *counted(group))
            if sum(len(h[0]) for h in held.values()) > HELD_SEQUENCES:
                yield from flush()
        yield from flush()

    asked = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text"))
    partial = asked.mapInArrow(run, "lang string, seq string, n bigint")
    return partial.groupBy("lang", "seq").agg(F.sum("n").alias("n"))


def in_groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts in groups of bounded size; a longer text is a group of its own."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size > GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of the sequences of texts, how often each occurs, and its five codes."""
    codes, edges = codes_of(texts)
    scored = np.ones(len(codes), bool)
    for back in range(ORDER - 1):
        scored[edges[:-1] + back] = False
    places = np.flatnonzero(scored)
    keys, first, sums = np.unique(hashes_of(codes, ORDER, 0)[places], return_index=True, return_counts=True)
    at = places[first]
    return keys, sums, np.stack([codes[at - back] for back in range(ORDER - 1, -1, -1)], 1)


def merge(held: dict, lang: str | None, keys: np.ndarray, sums: np.ndarray, codes: np.ndarray) -> None:
    """Add counted sequences to those held for a language."""
    if lang in held:
        old_keys, old_sums, old_codes = held[lang]
        keys, sums = np.concatenate((old_keys, keys)), np.concatenate((old_sums, sums))
        codes = np.concatenate((old_codes, codes))
        keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, back, sums)
        sums, codes = total, codes[first]
    held[lang] = (keys, sums.astype(np.int64), codes.astype(np.uint32))


# --- the model ---


def _discounts(counts: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3`` of one order, with Chen and Goodman's estimates; 0.5 where there are too few sequences."""
    of = [F.sum((F.col("n") == i).cast("bigint")).alias(f"t{i}") for i in (1, 2, 3, 4)]
    y = F.col("t1") / (F.col("t1") + 2 * F.col("t2"))
    made = []
    for i in (1, 2, 3):
        known = (F.col("t1") > 0) & (F.col(f"t{i}") > 0)
        value = i - (i + 1) * y * F.col(f"t{i + 1}") / F.nullif(F.col(f"t{i}"), F.lit(0))
        made.append(F.when(known, F.greatest(F.lit(0.1), F.least(value, F.lit(float(i))))).otherwise(0.5).alias(f"d{i}"))
    return counts.groupBy("lang").agg(*of).select("lang", *made)


def _with_lang(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by language, NULL as a value like any other, and further keys."""
    named = other.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in other.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(named, same, how).drop(*[f"_{k}" for k in keys])


def kneser_ney(counts: DataFrame) -> DataFrame:
    """The interpolated model: ``lang, ord, seq, logp, backoff`` from ``counts(lang, seq, n)`` of the highest order.

    ``logp`` is the logarithm of the probability of a sequence's last character after the others; ``backoff`` that
    of the weight of the next lower order after this sequence as a context (0 where it never is one). Order 0, with
    an empty sequence, is a character that no text has.
    """
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        # continuation counts: how many different characters stand before a sequence
        shorter = F.substring("seq", 2, order)
        lower, _ = read_once(tables[order + 1].groupBy("lang", shorter.alias("seq")).agg(F.count("*").alias("n")), "grams")
        tables[order] = lower
    # below the lowest order all characters of a language, and one unknown, are alike
    alphabet = tables[1].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("p"))
    lower = alphabet.select("lang", F.lit("").alias("seq"), "p")
    parts = [lower.select("lang", F.lit(0).alias("ord"), "seq", F.log("p").alias("logp"))]
    weights = None
    for order in range(1, ORDER + 1):
        context = F.substring("seq", 1, order - 1)
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        grams = _with_lang(tables[order], _discounts(tables[order]), ["lang"]).withColumn("cut", F.least(cut, F.col("n")))
        grams = grams.select("lang", "seq", "n", "cut", context.alias("ctx"), F.substring("seq", 2, order - 1).alias("suffix"))
        totals = grams.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), F.sum("cut").alias("left"))
        joined = _with_lang(grams, totals, ["lang", "ctx"])
        below = lower.select("lang", F.col("seq").alias("suffix"), F.col("p").alias("q"))
        joined = _with_lang(joined, below, ["lang", "suffix"])
        value = (F.col("n") - F.col("cut") + F.col("left") * F.col("q")) / F.col("total")
        lower, _ = read_once(joined.select("lang", "seq", value.alias("p")), "probabilities")
        parts.append(lower.select("lang", F.lit(order).alias("ord"), "seq", F.log("p").alias("logp")))
        gamma = totals.select("lang", F.lit(order - 1).alias("ord"), F.col("ctx").alias("seq"), F.log(F.col("left") / F.col("total")).alias("backoff"))
        weights = gamma if weights is None else weights.unionByName(gamma)
    model = parts[0]
    for part in parts[1:]:
        model = model.unionByName(part)
    # contexts of start signs alone are no sequences with a probability
    known = model.withColumn("backoff", F.lit(None).cast("double"))
    known = known.unionByName(weights.select("lang", "ord", "seq", F.lit(None).cast("double").alias("logp"), "backoff"))
    return known.groupBy("lang", "ord", "seq").agg(F.max("logp").alias("logp"), F.max("backoff").alias("backoff"))


class HashModel:
    """A block of the model: sorted hashes of sequences with their log-probabilities and back-off weights."""

    def __init__(self, keys: np.ndarray, logp: np.ndarray, backoff: np.ndarray, unknown: dict):
        ranked = np.argsort(keys)
        keys, self.logp, self.backoff = keys[ranked], logp[ranked], backoff[ranked]
        # of each language, the logarithm of the probability of a character that no text has
        self.keys, self.unknown = keys, unknown
        self.seeds = {lang: n for n, lang in enumerate(unknown)}
        # where the hashes of each value of the highest bits begin
        self.bits = max(len(keys).bit_length(), 1)
        tops = keys >> np.uint64(64 - self.bits)
        self.starts = np.searchsorted(tops, np.arange((1 << self.bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The places of hashes, -1 where there are none."""
        tops = wanted >> np.uint64(64 - self.bits)
        at, end = self.starts[tops], self.starts[tops + np.uint64(1)]
        found = np.full(len(wanted), -1, np.int64)
        left = np.flatnonzero(at < end)
        while len(left):
            same = self.keys[at[left]] == wanted[left]
            found[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < end[left]]
        return found

    def log_probabilities(self, codes: np.ndarray, places: np.ndarray, lang) -> np.ndarray:
        """Of the character at each place after the ones before it: the longest known sequence, and the weights of
        the longer contexts passed on the way down."""
        seed = self.seeds[lang]
        total = np.zeros(len(places))
        open_ = np.arange(len(places))
        for order in range(ORDER, 0, -1):
            at = self.find(hashes_of(codes, order, seed)[places[open_]])
            logp = np.where(at >= 0, self.logp[at], np.nan)
            known = ~np.isnan(logp)
            total[open_[known]] += logp[known]
            open_ = open_[~known]
            if not len(open_):
                return total
            if order > 1:
                # the context: the characters before the place
                at = self.find(hashes_of(codes, order - 1, seed)[places[open_] - 1])
                weight = np.where(at >= 0, self.backoff[at], np.nan)
                total[open_] += np.where(np.isnan(weight), 0.0, weight)
        total[open_] += self.unknown[lang]
        return total


# --- texts ---


def block_numbers(first: np.ndarray, second: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each pair of characters."""
    return (first.astype(np.int64) * 40_503 + second.astype(np.int64) * 2_654_435) % blocks


def _block_of(pair: Column, blocks: int) -> Column:
    """The block of a pair of characters, by their code points."""
    first, second = F.ascii(pair).cast("bigint"), F.ascii(F.substring(pair, 2, F.lit(1))).cast("bigint")
    return (first * 40_503 + second * 2_654_435) % blocks


def score_texts(
    model: HashModel, texts: list[bytes], langs: list, block: int = 0, blocks: int = 1
) -> tuple[list[float], list[int]]:
    """The sum of log-probabilities of each text's characters, and their number, as far as the block covers them.

    Characters go to blocks by the two before them.
    """
    sums, sizes = [0.0] * len(texts), [0] * len(texts)
    by_lang: dict = {}
    for n, lang in enumerate(langs):
        if lang in model.unknown:
            by_lang.setdefault(lang, []).append(n)
    for lang, rows in by_lang.items():
        done = 0
        for group in in_groups([texts[n] for n in rows]):
            codes, edges = codes_of(group)
            scored = np.ones(len(codes), bool)
            for back in range(ORDER - 1):
                scored[edges[:-1] + back] = False
            if blocks > 1:
                scored &= block_numbers(np.roll(codes, 2), np.roll(codes, 1), blocks) == block
            places = np.flatnonzero(scored)
            found = np.concatenate(([0.0], np.cumsum(model.log_probabilities(codes, places, lang))))
            cuts = np.searchsorted(places, edges)
            for n, total, size in zip(rows[done : done + len(group)], np.diff(found[cuts]), np.diff(cuts)):
                sums[n], sizes[n] = float(total), int(size)
            done += len(group)
    return sums, sizes


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _blocks_of(model: DataFrame, block_entries: int) -> int:
    """Into how many blocks the model is cut, so that none holds more than ``block_entries`` sequences.

    Sequences of one or two characters are in every block. A single pair's sequences stay together.
    """
    blocks, most = 1, model.count()
    while most > block_entries:
        blocks *= 2
        rows = _block_rows(model, blocks, F.explode(F.array_distinct(F.array("gram", "context"))).alias("block"))
        largest = rows.groupBy("block").count().agg(F.max("count")).first()[0]
        if 4 * largest > 3 * most:
            # what is left is a single pair's, or in every block
            break
        most = largest
    return blocks


def _block_rows(model: DataFrame, blocks: int, *columns: Column) -> DataFrame:
    """``model`` with the blocks of a sequence as a gram (by the pair before its last character) and as a context."""
    every = F.lit(-1).cast("bigint")
    gram = F.when(F.col("ord") < 3, every).otherwise(_block_of(F.expr("substring(seq, ord - 2, 2)"), blocks))
    context = F.when(F.col("ord") < 2, every).otherwise(_block_of(F.expr("substring(seq, ord - 1, 2)"), blocks))
    return model.select("*", gram.alias("gram"), context.alias("context")).select("*", *columns)


def _hash_model(model: DataFrame, block: int, blocks: int, unknown: dict) -> HashModel:
    """One block as sorted arrays; only hashes and numbers reach the driver."""
    if blocks > 1:
        here = [F.col(c).isin(-1, block) for c in ("gram", "context")]
        model = _block_rows(model, blocks).select(
            "lang", "ord", "seq", F.when(here[0], F.col("logp")).alias("logp"), F.when(here[1], F.col("backoff")).alias("backoff")
        )
        model = model.filter("logp is not null or backoff is not null")
    numbers = {lang: n for n, lang in enumerate(unknown)}

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            seqs, orders = batch["seq"].to_pylist(), batch["ord"].to_numpy()
            seeds = np.array([numbers[lang] for lang in batch["lang"].to_pylist()], np.uint64)
            keys = np.zeros(len(seqs), np.uint64)
            for order in range(1, ORDER + 1):
                at = np.flatnonzero(orders == order)
                keys[at] = sequence_hashes([seqs[i] for i in at.tolist()], order, seeds[at])
            return {"key": pa.array(keys.view(np.int64))}

        return work

    asked = model.filter("ord > 0").select("lang", "ord", "seq", F.col("logp").cast("float"), F.col("backoff").cast("float"))
    keyed = map_rows(asked, {"lang": "string", "ord": "int", "seq": "string"}, struct("key bigint"), start, ["logp", "backoff"])
    table = keyed.select("key", "_row.logp", "_row.backoff").toArrow()
    values = [table[c].cast(pa.float32()).fill_null(float("nan")).to_numpy() for c in ("logp", "backoff")]
    return HashModel(table["key"].to_numpy().view(np.uint64), *values, unknown)


def measured(docs: DataFrame, model: DataFrame, keep: list[str], block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Base counts, ``logs`` (log-probabilities of a text's characters, added up), ``chars``, and the columns ``keep``.

    ``docs`` has ``lang, text``. A model of more than ``block_entries`` sequences goes over a staged copy of
    ``docs`` block by block.
    """
    blocks = _blocks_of(model, block_entries)
    ends = model.filter("ord = 0").select("lang", (F.col("logp") + F.coalesce("backoff", F.lit(0.0))).alias("p"))
    unknown = {r["lang"]: r["p"] for r in ends.orderBy("lang").collect()}
    rows = docs.select("lang", "text", F.struct(*keep).alias("kept"))
    if blocks == 1:
        made = _measured(rows, _hash_model(model, 0, 1, unknown), 0, 1)
        return made.select("_row.kept.*", *BASE, "logs", "chars")
    rows, _ = read_once(rows.withColumn("at", F.monotonically_increasing_id()), "numbered-texts")
    parts = None
    for block in range(blocks):
        part = _measured(rows, _hash_model(model, block, blocks, unknown), block, blocks)
        parts = part if parts is None else parts.unionByName(part)
    sums = [F.sum(c).alias(c) for c in (*BASE, "logs", "chars")]
    added = parts.groupBy("_row.at").agg(F.any_value("_row.kept").alias("kept"), *sums)
    return added.select("kept.*", *BASE, "logs", "chars")


def _measured(rows: DataFrame, model: HashModel, block: int, blocks: int) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(model)

    def start():
        own = held.value

        def work(batch: pa.RecordBatch) -> dict:
            texts = texts_of(batch["text"])
            # the base counts come with the first block
            found = [base_counts(t) if block == 0 else dict.fromkeys(BASE, 0) for t in texts]
            made: dict[str, list] = {name: [f[name] for f in found] for name in BASE}
            made["logs"], made["chars"] = score_texts(own, texts, batch["lang"].to_pylist(), block, blocks)
            return made

        return work

    out = struct(", ".join(f"{n} bigint" for n in BASE) + ", logs double, chars bigint")
    kept = [c for c in rows.columns if c in ("kept", "at")]
    return map_rows(rows, {"text": "binary", "lang": "string"}, out, start, kept)


def bands(found: DataFrame) -> DataFrame:
    """``lang, lower, upper``: the perplexities (as logarithms a character) of each language's accepted texts."""
    quartiles = F.percentile_approx("loss", [0.25, 0.5, 0.75], 10_000).alias("q")
    made = found.groupBy("lang").agg(quartiles)
    reach = [F.greatest(BAND_WIDTH * F.abs(F.col("q")[1] - F.col("q")[i]), F.lit(LEAST_WIDTH)) for i in (0, 2)]
    return made.select("lang", (F.col("q")[1] - reach[0]).alias("lower"), (F.col("q")[1] + reach[1]).alias("upper"))


def quality_report(docs: DataFrame, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``: base counts, perplexity, its band, and the verdict.

    ``base_failed`` texts have fewer than 50 words, or over half of their words in windows of three that occur
    again in the text. ``kept`` texts passed these rules and have a perplexity inside the band of
    their language; the bands come from the texts that passed the rules. A NULL text has no words. A NULL
    language is one of its own. Rows are kept one by one, repeated ones too; other columns are not read; an
    empty table gives no rows.
    """
    asked = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    counts, counts_path = read_once(count_sequences(asked), "sequences")
    model, model_path = read_once(kneser_ney(counts), "model")
    drop_staged(docs.sparkSession, counts_path)
    found = measured(asked.withColumn("language", F.col("lang")), model, ["doc_id", "language"], block_entries)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    loss = F.when(F.col("chars") > 0, -F.col("logs") / F.col("chars"))
    rated, _ = read_once(found.select("*", failed.alias("base_failed"), loss.alias("loss")), "rated")
    drop_staged(docs.sparkSession, model_path)
    passed = rated.filter("not base_failed").select(F.col("language").alias("lang"), "loss")
    joined = _with_lang(rated.withColumnRenamed("language", "lang"), bands(passed), ["lang"], "left")
    inside = F.col("loss").between(F.col("lower"), F.col("upper"))
    return joined.select(
        "doc_id", *BASE, "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        F.exp("loss").alias("perplexity"), F.exp("lower").alias("lower"), F.exp("upper").alias("upper"),
    )


def keep_fluent(docs: DataFrame, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """The rows of ``docs`` that ``quality_report`` keeps, in their own columns; NULLs and ties as there."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = docs.select(F.monotonically_increasing_id().alias("doc_id"), "text", "lang", row.alias("given"))
    numbered, _ = read_once(numbered, "numbered")
    kept = quality_report(numbered, block_entries).filter("kept").select("doc_id")
    return numbered.join(kept, "doc_id").select("given.*")
