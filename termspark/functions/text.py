"""Text to tokens, lexemes and positions.

Tokens are runs of letters and digits, lower-cased; a dotted code such as ``a01.1`` is one token
that also counts as its pieces, all at one position. Positions count every token, stop words too.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from termspark.functions import english

# workers get these functions with the job, so the package need not be installed on them
cloudpickle.register_pickle_by_value(english)

# --- fixed values: token patterns ---
TOKEN = r"\p{L}\p{N}+(?:\.\p{N}+)+|[\p{L}\p{N}]+"

ENGLISH, SIMPLE = "english", "simple"


def tokenize(text: Column) -> Column:
    """Lower-case tokens in order; NULL text gives no tokens."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), 0)


def lexize(tokens: Column, config: str = ENGLISH) -> Column:
    """Token array to lexeme array of the same length; stop words become NULL.

    ``simple`` keeps tokens as they are.
    """
    if config == SIMPLE:
        return tokens
    if config == ENGLISH:
        return F.arrow_udf(english.english_lexemes, "array<string>")(tokens)
    raise ValueError(f"unknown text configuration {config!r}")


def last_position(lexemes: Column) -> Column:
    """Highest position that holds a lexeme; 0 for none."""
    kept = F.transform(lexemes, lambda x, i: F.when(x.isNotNull(), i + 1))
    return F.coalesce(F.array_max(kept), F.lit(0))


def pieces(lexeme: Column) -> Column:
    """The lexeme, and for a dotted code also its pieces."""
    whole = F.array(lexeme)
    return F.when(lexeme.contains("."), F.array_union(whole, F.split(lexeme, r"\."))).otherwise(whole)


def trigrams(text: Column) -> Column:
    """Distinct trigrams of the words, each padded with two blanks before and one after."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)
    grams = F.transform(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) + 1),
            lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)),
        ),
    )
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(left: Column, right: Column) -> Column:
    """Shared over all distinct trigrams of two trigram arrays; 0 when both are empty."""
    shared = F.size(F.array_intersect(left, right))
    total = F.size(left) + F.size(right) - shared
    return F.when(total > 0, shared / total).otherwise(F.lit(0.0))
