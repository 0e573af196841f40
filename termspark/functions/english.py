"""English lexemes: stop words, then the published Porter2 stemmer, behind one Arrow UDF."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa

from termspark.constants import ENGLISH_STOP_WORDS

# --- fixed values: the published algorithm's letters, endings and exceptions ---
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_BEFORE = "cdeghkmnrt"
WHOLE_WORDS = {
    "skis": "ski",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "idly": "idl",
    "gently": "gentl",
    "ugly": "ugli",
    "early": "earli",
    "only": "onli",
    "singly": "singl",
    "sky": "sky",
    "news": "news",
    "howe": "howe",
    "atlas": "atlas",
    "cosmos": "cosmos",
    "bias": "bias",
    "andes": "andes",
}
AFTER_PLURAL = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
LONG_HEADS = ("gener", "commun", "arsen")
STEP_2 = {
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "abli": "able",
    "entli": "ent",
    "izer": "ize",
    "ization": "ize",
    "ational": "ate",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "aliti": "al",
    "alli": "al",
    "fulness": "ful",
    "ousli": "ous",
    "ousness": "ous",
    "iveness": "ive",
    "iviti": "ive",
    "biliti": "ble",
    "bli": "ble",
    "ogi": "og",
    "fulli": "ful",
    "lessli": "less",
    "li": "",
}
STEP_3 = {
    "tional": "tion",
    "ational": "ate",
    "alize": "al",
    "icate": "ic",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
    "ative": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()
)

_REGION = re.compile(r"[aeiouy][^aeiouy](.*)", re.S)
_SHORT_END = re.compile(r"(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")


def _region_start(word: str, start: int) -> int:
    found = _REGION.search(word, start)
    return found.start(1) if found else len(word)


def _longest(word: str, endings) -> str | None:
    fitting = [e for e in endings if word.endswith(e)]
    return max(fitting, key=len) if fitting else None


def _has_vowel(part: str) -> bool:
    return any(c in VOWELS for c in part)


def _plural(word: str) -> str:
    ending = _longest(word, ("sses", "ied", "ies", "us", "ss", "s"))
    if ending == "sses":
        return word[:-2]
    if ending in ("ied", "ies"):
        return word[:-2] if len(word) > 4 else word[:-1]
    if ending == "s" and _has_vowel(word[:-2]):
        return word[:-1]
    return word


def _past(word: str, r1: int) -> str:
    ending = _longest(word, ("eedly", "eed", "edly", "ed", "ingly", "ing"))
    if ending is None:
        return word
    base = word[: -len(ending)]
    if ending in ("eed", "eedly"):
        return base + "ee" if len(base) >= r1 else word
    if not _has_vowel(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(DOUBLES):
        return base[:-1]
    if r1 >= len(base) and _SHORT_END.search(base):
        return base + "e"
    return base


def _step_2(word: str, r1: int) -> str:
    ending = _longest(word, STEP_2)
    if ending is None:
        return word
    base = word[: -len(ending)]
    if len(base) < r1:
        return word
    if ending == "ogi" and not base.endswith("l"):
        return word
    if ending == "li" and base[-1:] not in tuple(LI_BEFORE):
        return word
    return base + STEP_2[ending]


def _step_3(word: str, r1: int, r2: int) -> str:
    ending = _longest(word, STEP_3)
    if ending is None:
        return word
    base = word[: -len(ending)]
    if len(base) < r1 or (ending == "ative" and len(base) < r2):
        return word
    return base + STEP_3[ending]


def _step_4(word: str, r2: int) -> str:
    ending = _longest(word, STEP_4)
    if ending is None:
        return word
    base = word[: -len(ending)]
    if len(base) < r2 or (ending == "ion" and base[-1:] not in ("s", "t")):
        return word
    return base


def _step_5(word: str, r1: int, r2: int) -> str:
    base = word[:-1]
    if word.endswith("e") and (len(base) >= r2 or (len(base) >= r1 and not _SHORT_END.search(base))):
        return base
    if word.endswith("ll") and len(base) >= r2:
        return base
    return word


def stem(word: str) -> str:
    """The English stem of a lower-case word."""
    if len(word) <= 2:
        return word
    if word in WHOLE_WORDS:
        return WHOLE_WORDS[word]
    # y that starts a word or follows a vowel is a consonant
    word = re.sub(r"^y|(?<=[aeiouy])y", "Y", word)
    head = next((h for h in LONG_HEADS if word.startswith(h)), None)
    r1 = len(head) if head else _region_start(word, 0)
    r2 = _region_start(word, r1)
    word = _plural(word)
    if word in AFTER_PLURAL:
        return word
    word = _past(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    word = _step_2(word, r1)
    word = _step_3(word, r1, r2)
    word = _step_4(word, r2)
    return _step_5(word, r1, r2).lower()


def english_lexemes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Token lists to lexeme lists of the same lengths; stop words become NULL.

    Each distinct token of a batch is handled once.
    """
    stops = frozenset(ENGLISH_STOP_WORDS)
    cached = lru_cache(maxsize=100_000)(stem)

    def lexeme(word: str) -> str | None:
        if word in stops:
            return None
        return cached(word) if word.isascii() and word.isalpha() else word

    for tokens in batches:
        coded = tokens.flatten().dictionary_encode()
        lexemes = pa.array([lexeme(w) for w in coded.dictionary.to_pylist()], pa.string())
        lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = pa.array([0, *lengths.cumsum().tolist()], pa.int32())
        yield pa.ListArray.from_arrays(ends, lexemes.take(coded.indices))
