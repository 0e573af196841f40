"""Language identification by error-correcting output codes.

Every language gets a codeword; each bit of the codewords is predicted by a binary classifier over
hashed byte n-grams of the lower-cased text. A text's language is the one whose codeword has the least
loss, summed over the bits with weights that follow how well each bit is predicted on a part of the
sample that its classifier has not seen. Where the second-best codeword comes close, the answer is
flagged as ambiguous.

The classifiers are fitted on the driver, on a sample of about ``SAMPLE_PER_LANGUAGE`` different texts
of each language, chosen by a hash of the text; what reaches the driver is one vector of
``DIMENSIONS`` numbers for each. Everything else, counts and predictions, covers all rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspark.llm.common import map_rows, release, struct

DIMENSIONS = 4096
SAMPLE_PER_LANGUAGE = 400
UNKNOWN = "und"
# an answer below this score is ambiguous
MIN_SCORE = 0.5
# bytes whose n-grams are counted at once
COUNTED = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
# ASCII but letters becomes a blank, so that n-grams see letters and word edges only
_BLANKED = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    # number signs such as a superscript two are word characters, but no letters
    return bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text))


def features(text: str) -> np.ndarray:
    """Square roots of the counts of hashed byte pairs and triples, at length one."""
    half = DIMENSIONS // 2
    shift = np.uint32(32 - (half.bit_length() - 1))
    data = np.frombuffer(b" " + text.lower().encode().translate(_BLANKED) + b" ", np.uint8)
    counts = np.zeros(DIMENSIONS)
    for at in range(0, max(len(data) - 1, 1), COUNTED):
        # triples reach two bytes into the next part
        part = data[at : at + COUNTED + 2].astype(np.uint32)
        pairs = (part[:-1] << np.uint32(8)) | part[1:]
        triples = (pairs[:-1] << np.uint32(8)) | part[2:]
        for n, grams in enumerate((pairs[:COUNTED], triples[:COUNTED])):
            hashed = (grams * np.uint32(2654435761)) >> shift
            counts[n * half : (n + 1) * half] += np.bincount(hashed, minlength=half)
    made = np.sqrt(counts)
    length = np.linalg.norm(made)
    return (made / length if length else made).astype(np.float32)


def codewords(count: int) -> np.ndarray:
    """A codeword of +1 and -1 for each of ``count`` languages.

    Up to six languages have the exhaustive code, every split of the languages once. More have the
    best of some seeded random codes, by the least distance between two codewords.
    """
    if count <= 6:
        splits = [s for size in range(1, count) for s in combinations(range(count), size) if 0 in s]
        code = -np.ones((count, len(splits)), int)
        for n, split in enumerate(splits):
            code[list(split), n] = 1
        return code
    length, random = 16 * count.bit_length(), np.random.default_rng(0)

    def least_distance(code: np.ndarray) -> int:
        far = (length - code @ code.T) // 2
        np.fill_diagonal(far, length)
        return int(far.min())

    return max((random.choice((-1, 1), (count, length)) for _ in range(50)), key=least_distance)


@dataclass
class Model:
    """Languages, their codewords, and a linear classifier with a weight for every bit."""

    languages: list[str]
    code: np.ndarray
    slopes: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray

    def decode(self, rows: np.ndarray) -> list[tuple[str, float]]:
        """Language and score (its share among all codewords) of each feature row."""
        margins = rows @ self.slopes + self.offsets
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]) @ self.weights
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        return [(self.languages[b], float(s[b])) for b, s in zip(best, share)]


def _fit_bits(rows: np.ndarray, targets: np.ndarray, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression of every bit at once, by gradient steps with momentum."""
    slopes = np.zeros((rows.shape[1], targets.shape[1]), np.float32)
    offsets = np.zeros(targets.shape[1], np.float32)
    moved, moved_offsets = np.zeros_like(slopes), np.zeros_like(offsets)
    for _ in range(rounds):
        pull = -targets / (1 + np.exp(np.clip(targets * (rows @ slopes + offsets), -60, 60))) / len(rows)
        moved = 0.9 * moved - 20.0 * (rows.T @ pull + 1e-6 * slopes)
        moved_offsets = 0.9 * moved_offsets - 2.0 * pull.sum(axis=0)
        slopes, offsets = slopes + moved, offsets + moved_offsets
    return slopes, offsets


def fit(languages: list[str], rows: np.ndarray) -> Model | None:
    """A model from the language and features of each sampled text; None without any."""
    names = sorted(set(languages))
    if not names:
        return None
    code = codewords(len(names))
    targets = code[[names.index(x) for x in languages]].astype(np.float32)
    # every fifth row weighs the bits, if each language has rows on both sides
    seen = np.arange(len(rows)) % 5 > 0
    weights = np.ones(code.shape[1])
    both = [{x for x, s in zip(languages, seen) if s == side} for side in (True, False)]
    if both[0] == both[1] == set(names) and code.shape[1]:
        slopes, offsets = _fit_bits(rows[seen], targets[seen])
        right = (((rows[~seen] @ slopes + offsets) * targets[~seen]) > 0).mean(axis=0)
        odds = np.log(np.clip(right, 0.5, 0.999) / (1 - np.clip(right, 0.5, 0.999))) + 1e-3
        weights = odds / odds.mean()
    slopes, offsets = _fit_bits(rows, targets)
    return Model(names, code, slopes, offsets, weights)


def _is_held_out() -> Column:
    """Documents that are never learned from: a third, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fit on a sample of ``docs(doc_id, text, lang)`` that are not held out and have a language.

    Rows with a NULL doc_id, text or language, or without a letter, are not learned from. A text with
    two languages counts for both.
    """
    known = docs.filter("doc_id is not null and lang is not null").filter(~_is_held_out())
    known = known.filter(F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("h")
    )
    counts = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    if not counts:
        return None
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], per_language / max(row["n"], 1)).otherwise(share)
    place = F.pmod(F.xxhash64("h", F.lit(7)), F.lit(1_000_000)) / 1_000_000
    # copies of a text are one row of the sample; combined before the shuffle
    sample = known.filter(place < share).groupBy("lang", "h").agg(F.first("text").alias("text"))

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            vectors = [features(t).tobytes() for t in batch["text"].to_pylist()]
            return {"lang": batch["lang"], "h": batch["h"], "vector": vectors}

        return work

    columns = {"lang": "string", "h": "bigint", "text": "string"}
    rows = map_rows(sample, columns, struct("lang string, h bigint, vector binary"), start).collect()
    rows.sort(key=lambda r: (r["h"], r["lang"]))
    vectors = np.array([np.frombuffer(r["vector"], np.float32) for r in rows])
    model = fit([r["lang"] for r in rows], vectors)
    # the driver goes on without the sample
    del rows, vectors
    release()
    return model


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """lang_pred, score, ambiguous and ``_row`` (the columns in ``keep``) for every row of ``docs(text)``.

    A NULL text, one without a letter, or any text if there was nothing to learn from, is ``und``
    with score 0. Only the text is read for an answer.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        known = sent.value

        def work(batch: pa.RecordBatch) -> dict:
            texts = batch["text"].to_pylist()
            answers = [(UNKNOWN, 0.0)] * len(texts)
            places = [n for n, t in enumerate(texts) if known and has_letter(t)]
            for at in range(0, len(places), 256):
                part = places[at : at + 256]
                rows = np.array([features(texts[n]) for n in part])
                for n, answer in zip(part, known.decode(rows)):
                    answers[n] = answer
            names, scores = [a[0] for a in answers], [a[1] for a in answers]
            return {"lang_pred": names, "score": scores, "ambiguous": [s < MIN_SCORE for s in scores]}

        return work

    out = struct("lang_pred string, score double, ambiguous boolean")
    return map_rows(docs, {"text": "string"}, out, start, keep)


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous, one row per row of ``docs(doc_id, text, lang)``.

    The model learns from documents that are not held out. Repeated rows stay. No rows: no rows.
    """
    found = predict(docs, train(docs), ["doc_id"])
    held_out = F.coalesce(F.crc32(F.col("_row.doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` whose language is known: neither ``und`` nor ambiguous. Columns stay as they are."""
    found = predict(docs, train(docs), docs.columns)
    return found.filter((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")).select("_row.*")
