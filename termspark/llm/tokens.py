"""Token ids of whole texts, through the public tokenizer files, with a cache of word pieces.

A byte-pair tokenizer first cuts a text by a pattern and then encodes each piece on its own. Words
repeat, so each worker encodes a word once with the ``tokenizers`` library's model and keeps its ids.
Texts are parted before single spaces, line feeds, full stops and commas, where both patterns always
cut; a text with other combinations is parted less or not at all, and one with any character outside
the alphabet for which the cut is certain goes to the library whole.
"""

from __future__ import annotations

import re
import struct
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# --- fixed values: the cutting patterns of the two tokenizer files, spelled out for the alphabet below ---
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBERS = "0-9²³¹¼-¾"
_BYTE_LEVEL = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+"
)
_WORD_END = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+"
# --- end of fixed values ---

# stops and commas that stand next to another sign are one piece with it; looked for from the stop or comma on
_SIGN = r"[^\sA-Za-z0-9ªµºÀ-ÖØ-öø-ſ²³¹¼-¾]"
_TOUCHING = re.compile(rf"[.,](?:{_SIGN}|(?<={_SIGN}[.,]))")
# Outside this alphabet (line feed, printable ASCII, Latin letters but for the dotted capital I), or
# with the brackets of a special token, a text is encoded whole.
_OUTSIDE = re.compile(r"[^\n\x20-\x7e¡-įı-ſ]")
# Words kept in each of the two generations of a worker's cache: when the new one is full it becomes
# the old one, and words still in use move over. This bounds the memory.
CACHED_WORDS = 200_000
# characters; a longer word is not worth keeping
LONGEST_CACHED = 64
# characters of text whose words are dealt out at once
GROUP_CHARS = 2 << 20


def _uncertain(text: str) -> bool:
    return "<|" in text or _OUTSIDE.search(text) is not None


def _listed(words: pa.Array) -> list[str]:
    """Words without NUL as Python strings, through one string of all."""
    if not len(words) or words.nbytes > 1 << 30:
        return words.to_pylist()
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string()))
    return pc.binary_join(whole, "\0")[0].as_py().split("\0")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself, if it is printable."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + n for n, b in enumerate(others)}


class _Words(dict):
    """Little-endian unsigned 32-bit ids of each word, made on first use."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.old = encode, most, {}

    def __missing__(self, word: str) -> bytes:
        made = self.old.get(word) or self.encode(word)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[word] = made
        return made


class Encoder:
    """``encode(texts)``: the ids of whole texts, by one tokenizer file, with caches of up to twice ``cached`` words."""

    def __init__(self, path: str, cached: int | None = None):
        cached = cached or CACHED_WORDS
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.lower = self.tokenizer.normalizer is not None
        self.cut = re.compile(_WORD_END if self.lower else _BYTE_LEVEL).findall
        self.letters = _byte_letters()
        self.space = chr(self.letters[ord(" ")])
        self.pieces = _Words(self.piece, cached)
        self.words = _Words(self.word, cached)

    def whole(self, text: str) -> bytes:
        """All steps by the library."""
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def piece(self, piece: str) -> bytes:
        """One piece by the library's model."""
        if piece.isascii() and piece.isprintable():
            # the letter of a byte is then the byte itself, but for the space
            letters = piece.replace(" ", self.space)
        else:
            letters = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def cut_up(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.cut(text)))

    def word(self, word: str) -> bytes:
        """The ids of what stands between two certain cuts."""
        letters = word[1:] if word[0] == " " else word
        return self.piece(word) if letters.isalpha() else self.cut_up(word)

    def part(self, text: str) -> str:
        """The text with NUL at places where both patterns cut, for a text in the certain alphabet."""
        if not _TOUCHING.search(text) and (self.lower or not (" ," in text or " ." in text)):
            text = text.replace(",", "\0,").replace(".", "\0.")
        if self.lower:
            # white space is never part of a piece
            return text.lower().replace("\n", "\0").replace(" ", "\0")
        # next to other white space, a space or line feed may be one piece with it
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return text
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > GROUP_CHARS:
                out.extend(self._encode_group(group))
                group, size = [], 0
        return out + self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> list[np.ndarray]:
        """Looks every different word of the texts up once and deals its ids out to its places."""
        heads = [self.whole(t) if _uncertain(t) else None for t in texts]
        rests = [self.part(t) if h is None else None for t, h in zip(texts, heads)]
        split = pc.split_pattern(pa.array(rests, pa.large_string()), "\0")
        words = split.flatten().dictionary_encode()
        made = [self.words[w] if w else b"" for w in _listed(words.dictionary)]
        ids = np.frombuffer(b"".join(made), "<u4")
        lengths = np.array([len(m) // 4 for m in made], np.int64)
        starts = np.cumsum(lengths) - lengths
        codes = words.indices.to_numpy()
        counts = lengths[codes]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        dealt = ids[np.arange(total) + np.repeat(starts[codes] - (ends - counts), counts)] if total else ids[:0]
        per_text = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
        cuts = np.concatenate(([0], ends))[np.cumsum(per_text)]
        out, begin = [], 0
        for head, end in zip(heads, cuts):
            out.append(dealt[begin:end] if head is None else np.frombuffer(head, "<u4"))
            begin = end
        return out


@cache
def encoder(path: str, cached: int | None = None) -> Encoder:
    """One encoder for each worker process, as its cache is worth keeping between tasks."""
    return Encoder(path, cached)


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)
