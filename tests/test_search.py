"""Search trees and pattern search against plain scans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from termspark.operators import search
from termspark.operators.search import And, Not, Or, Phrase, Word

WORDS = ["red", "reed", "blue", "bluer", "green", "of", "the"]


def places(tree, tokens):
    """Positions where a word stands or a phrase ends."""
    if isinstance(tree, Word):
        return {n for n, t in enumerate(tokens, 1) if (t.startswith(tree.lexeme) if tree.prefix else t == tree.lexeme)}
    if isinstance(tree, Or):
        return places(tree.left, tokens) | places(tree.right, tokens)
    return {p + tree.distance for p in places(tree.first, tokens)} & places(tree.second, tokens)


def holds(tree, tokens):
    if isinstance(tree, And):
        return holds(tree.left, tokens) and holds(tree.right, tokens)
    if isinstance(tree, Or):
        return holds(tree.left, tokens) or holds(tree.right, tokens)
    if isinstance(tree, Not):
        return not holds(tree.node, tokens)
    return bool(places(tree, tokens))


def random_tree(rng, depth):
    kind = rng.randrange(6) if depth else 0
    if kind < 2:
        return Word(rng.choice(WORDS), rng.random() < 0.3)
    if kind == 2:
        first = Phrase(Word(rng.choice(WORDS)), Word(rng.choice(WORDS), True), rng.randrange(1, 4))
        return Phrase(first, Or(Word(rng.choice(WORDS)), Word("blu", True)), rng.randrange(1, 3)) if rng.random() < 0.3 else first
    left, right = random_tree(rng, depth - 1), random_tree(rng, depth - 1)
    return [left & right, left | right, ~left][kind - 3]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(6)
    rows = [(n, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 12)))) for n in range(150)]
    rows += [(1000, " ".join(["of the"] * 3000)), (1001, ""), (1002, None)]
    return rows


def test_trees(spark, texts):
    rng = random.Random(12)
    rows = [(d, t, n, "D") for d, text in texts for n, t in enumerate((text or "").split(), 1)]
    df = spark.createDataFrame(rows, "code bigint, lexeme string, pos int, weight string").repartition(5).cache()
    owners = spark.createDataFrame([(d,) for d, _ in texts], "code bigint")
    for _ in range(12):
        tree = random_tree(rng, 3)
        got = sorted(r["code"] for r in search.match_tree(df, tree, owners).collect())
        assert got == sorted(d for d, text in texts if holds(tree, (text or "").split())), tree


def test_weights_and_owners(spark):
    df = spark.createDataFrame([("1", "a", 1, "A"), ("2", "a", 1, "B")], "code string, lexeme string, pos int, weight string")
    assert [r["code"] for r in search.match_tree(df, Word("a", weights="B")).collect()] == ["2"]
    with pytest.raises(ValueError):
        search.match_tree(df, ~Word("a"))
    with pytest.raises(ValueError):
        search.match_tree(df, Phrase(Word("a"), And(Word("a"), Word("b"))))
    assert search.match_tree(df.limit(0), Word("a")).count() == 0


PATTERNS = [
    ("like", "%reed%"), ("like", "%blue_ gr%"), ("like", "re%"), ("like", "%"), ("like", "%e%"), ("ilike", "%REED%blue%"),
    ("rlike", "reed|blue"), ("rlike", "(reed|blue)+ green"), ("rlike", "gree?n of"), ("rlike", "blu.r"), ("rlike", "bluers*"),
    ("rlike", "^the\\b.*green$"), ("rlike", "[^a]reed{1}"), ("rlike", "(?i)REED"), ("rlike", "gre{2}n"), ("rlike", "x*reed"),
    ("rlike", "gree+n"), ("rlike", "gree{0,2}n? ?of"), ("rlike", "\\w+uer\\s+green"),
]


@pytest.mark.parametrize("kind, pattern", PATTERNS)
def test_patterns(spark, texts, kind, pattern):
    df = spark.createDataFrame(texts, "code bigint, text string")
    grams = search.word_trigrams(df)
    got = sorted(r["code"] for r in search.match_pattern(df, grams, pattern, kind).collect())
    test = getattr(F.col("text"), kind)(pattern)
    assert got == sorted(r["code"] for r in df.filter(test).collect())


def test_regex_pieces_are_in_every_match():
    """Whatever a random expression matches contains its pieces."""
    rng = random.Random(3)
    signs = ["a", "b", "c", "ab", "abc", ".", "[ab]", "(ab|c)", "(abc)?", "\\.", "a?", "b+", "c*", "a{2}", "b{0,1}", "bc+?", "^", "$"]
    found = 0
    for _ in range(3000):
        pattern = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 6)))
        pieces = search.regex_pieces(pattern)
        for _ in range(8):
            text = "".join(rng.choice("abc.") for _ in range(rng.randrange(1, 14)))
            if re.search(pattern, text):
                found += 1
                assert all(p in text for p in pieces), (pattern, text, pieces)
    assert found > 1000


def test_reads_its_keys_only(spark, texts, tmp_path):
    """The wanted trigrams reach the scan of the postings."""
    df = spark.createDataFrame(texts, "code bigint, text string")
    search.word_trigrams(df).write.parquet(f"{tmp_path}/grams")
    found = search.match_pattern(df, spark.read.parquet(f"{tmp_path}/grams"), "%reed%green%")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(trigram" in plan
    assert search.needed_trigrams(search.like_pieces("%reed\\%x%gr_een%")) == ["ree", "eed", "een"]


def test_trigrams_without_a_shuffle(spark):
    """Pairs are made where the rows are; rows of one key count together."""
    df = spark.createDataFrame([(1, "green green"), (1, "blue"), (2, "blue"), (3, None), (4, "a bc")], "code bigint, text string")
    grams = search.word_trigrams(df)
    assert "Exchange" not in grams._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, grams.collect())) == [
        (1, "blu"), (1, "een"), (1, "gre"), (1, "lue"), (1, "ree"), (2, "blu"), (2, "lue")
    ]
    assert sorted(map(tuple, search.match_pattern(df, grams.unionByName(grams), "%blue%").collect())) == [(1, "blue"), (2, "blue")]
