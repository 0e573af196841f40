"""Text search on positions, and pattern search on trigrams.

A search tree of words, prefixes, phrases, and, or, not is answered from vectors in long form, ``(code, vector,
lexeme, pos, weight)``: every leaf is one equi-join or range filter on the lexeme, every inner node an
aggregation by owner (and by position for phrases), so no task holds a lexeme's or an owner's whole list.

A pattern (LIKE, or a regular expression) is answered from trigrams: those that every match must contain
are taken from the pattern, owners that have all of them are found by one aggregation, and only their texts are
tested. Patterns without such a trigram are tested on all texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Node:
    """A search tree; combine with ``&``, ``|`` and ``~``."""

    def __and__(self, other: Node) -> Node:
        return And(self, other)

    def __or__(self, other: Node) -> Node:
        return Or(self, other)

    def __invert__(self) -> Node:
        return Not(self)


@dataclass(frozen=True)
class Word(Node):
    """A lexeme, or with ``prefix`` all that begin so; ``weights`` limits the places (for instance ``"AB"``)."""

    lexeme: str
    prefix: bool = False
    weights: str = ""


@dataclass(frozen=True)
class Phrase(Node):
    """``first`` with ``second`` exactly ``distance`` positions later; both are words or phrases."""

    first: Node
    second: Node
    distance: int = 1


@dataclass(frozen=True)
class And(Node):
    left: Node
    right: Node


@dataclass(frozen=True)
class Or(Node):
    left: Node
    right: Node


@dataclass(frozen=True)
class Not(Node):
    node: Node


def phrase(*words: str) -> Node:
    """Words directly after one another."""
    made: Node = Word(words[0])
    for word in words[1:]:
        made = Phrase(made, Word(word))
    return made


def _places(node: Node, rows: DataFrame) -> DataFrame:
    """``(code, pos)`` where a word stands or a phrase ends."""
    if isinstance(node, Word):
        lexeme = F.col("lexeme")
        found = rows.filter(lexeme.startswith(node.lexeme) if node.prefix else lexeme == node.lexeme)
        if node.weights:
            found = found.filter(F.col("weight").isin(*node.weights))
        return found.select("code", "pos")
    if isinstance(node, Phrase):
        first = _places(node.first, rows).select("code", (F.col("pos") + node.distance).alias("pos"))
        return first.join(_places(node.second, rows), ["code", "pos"], "left_semi")
    if isinstance(node, Or):
        return _places(node.left, rows).unionByName(_places(node.right, rows))
    raise ValueError("a phrase has words, phrases and alternatives of them only")


def _leaves(node: Node) -> list[Node]:
    """The words and phrases of a tree, each once."""
    if isinstance(node, (Word, Phrase)):
        return [node]
    parts = [node.node] if isinstance(node, Not) else [node.left, node.right]
    return list(dict.fromkeys(leaf for part in parts for leaf in _leaves(part)))


def _holds(node: Node, leaves: list[Node]) -> Column:
    if isinstance(node, And):
        return _holds(node.left, leaves) & _holds(node.right, leaves)
    if isinstance(node, Or):
        return _holds(node.left, leaves) | _holds(node.right, leaves)
    if isinstance(node, Not):
        return ~_holds(node.node, leaves)
    return F.array_contains("leaves", leaves.index(node))


def _needs_something(node: Node) -> bool:
    """Whether no owner without any leaf can match."""
    if isinstance(node, And):
        return _needs_something(node.left) or _needs_something(node.right)
    if isinstance(node, Or):
        return _needs_something(node.left) and _needs_something(node.right)
    return not isinstance(node, Not)


def match_tree(rows: DataFrame, node: Node, owners: DataFrame | None = None) -> DataFrame:
    """``code`` of the owners whose vector matches the tree, each once.

    ``rows`` is ``(code, lexeme, pos, weight)`` of one vector. A tree that owners without any of its words may
    match (such as a bare ``~Word("x")``) needs ``owners(code)``, all there are.
    """
    leaves = _leaves(node)
    parts = None
    for number, leaf in enumerate(leaves):
        part = _places(leaf, rows).select("code", F.lit(number).alias("leaf"))
        parts = part if parts is None else parts.unionByName(part)
    if not _needs_something(node):
        if owners is None:
            raise ValueError("this tree also matches owners without any of its words: name all owners")
        parts = parts.unionByName(owners.select("code", F.lit(-1).alias("leaf")))
    # at most one entry per leaf of the tree
    found = parts.groupBy("code").agg(F.collect_set("leaf").alias("leaves"))
    return found.filter(_holds(node, leaves)).select("code")


# ---------------------------------------------------------------- patterns


def like_pieces(pattern: str, escape: str = "\\") -> list[str]:
    """The literal runs of a LIKE pattern."""
    pieces, run, at = [], "", 0
    while at < len(pattern):
        sign = pattern[at]
        if sign == escape and at + 1 < len(pattern):
            at += 1
            run += pattern[at]
        elif sign in "%_":
            pieces.append(run)
            run = ""
        else:
            run += sign
        at += 1
    return [p for p in [*pieces, run] if p]


def regex_pieces(pattern: str) -> list[str]:
    """Literal runs that every match of a regular expression contains.

    Only what is certain: plain signs at the top level that no quantifier makes optional. Alternatives at the top
    level, flags and anything not understood give nothing, which is always safe.
    """
    if pattern.startswith("(?"):
        return []
    pieces, run, at, depth = [], "", 0, 0
    while at < len(pattern):
        sign = pattern[at]
        literal = None
        if sign == "\\":
            if at + 1 >= len(pattern) or pattern[at + 1] == "Q":
                return []
            at += 1
            literal = pattern[at] if not pattern[at].isalnum() else None
            if literal is None and pattern[at] in "pPxukcN0123456789":
                return []
        elif sign == "[":
            at += 1
            if pattern[at : at + 1] == "^":
                at += 1
            if pattern[at : at + 1] == "]":
                at += 1
            while at < len(pattern) and pattern[at] != "]":
                if pattern[at] == "[":
                    return []
                at += 2 if pattern[at] == "\\" else 1
        elif sign == "(":
            depth += 1
        elif sign == ")":
            depth -= 1
        elif sign == "|" and depth == 0:
            return []
        elif sign not in ".^$*+?{}|":
            literal = sign
        follow = re.match(r"[*?+]|\{[0-9,]*\}", pattern[at + 1 :])
        if depth == 0 and literal is not None:
            if follow:
                # a repeated sign ends the run: it may stand there no or many times
                pieces += [run + literal] if follow[0] == "+" else [run]
                run = ""
            else:
                run += literal
        elif literal is None or depth:
            pieces.append(run)
            run = ""
        at += 1 + (len(follow[0]) if follow else 0)
        # lazy and possessive quantifiers
        if follow and pattern[at : at + 1] in ("?", "+"):
            at += 1
    return [p for p in [*pieces, run] if p]


def needed_trigrams(pieces: list[str]) -> list[str]:
    """Trigrams inside literal runs, lower-cased as the index has them.

    The index pads each word with blanks and breaks at everything but letters and digits, so only trigrams
    wholly of such signs are certain.
    """
    found = []
    for piece in pieces:
        for word in re.findall(r"[^\W_]+", piece.lower()):
            found += [word[i : i + 3] for i in range(len(word) - 2)]
    return list(dict.fromkeys(found))


def match_pattern(
    texts: DataFrame, trigrams: DataFrame, pattern: str, kind: str = "like", key: str = "code", text: str = "text"
) -> DataFrame:
    """The rows of ``texts`` whose text matches, found through ``trigrams(code, trigram)``; pairs may repeat.

    ``kind`` is ``like``, ``ilike`` or ``rlike``. Exact: candidates are tested on their text; NULL texts
    match nothing. Only the postings of the pattern's trigrams are read.
    """
    tests = {"like": F.col(text).like(pattern), "ilike": F.col(text).ilike(pattern), "rlike": F.col(text).rlike(pattern)}
    if kind not in tests:
        raise ValueError(f"unknown kind of pattern {kind!r}")
    wanted = needed_trigrams(regex_pieces(pattern) if kind == "rlike" else like_pieces(pattern))
    found = texts.filter(tests[kind])
    if not wanted:
        return found
    held = trigrams.filter(F.col("trigram").isin(wanted)).groupBy("code").agg(F.count_distinct("trigram").alias("n"))
    candidates = held.filter(F.col("n") == len(wanted)).select(F.col("code").alias(key))
    return found.join(candidates, key, "left_semi")


def word_trigrams(texts: DataFrame, key: str = "code", text: str = "text") -> DataFrame:
    """``(code, trigram)``, each pair once for a row: the trigrams inside the words of each text, for ``match_pattern``.

    Each row is worked on where it is: there is no shuffle. Rows with the same key may repeat a pair. The outer form
    keeps the optimizer from adding a size filter that would build the trigrams twice.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"[\p{L}\p{N}]+"), 0))
    grams = F.transform(
        F.filter(words, lambda w: F.length(w) > 2),
        lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))),
    )
    pairs = texts.select(F.col(key).alias("code"), F.explode_outer(F.array_distinct(F.flatten(grams))).alias("trigram"))
    return pairs.filter(F.col("trigram").isNotNull())
