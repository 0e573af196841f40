"""Scalar projections: classes, numbers, names, JSON, arrays and clamps."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from termspark import constants as C


def lookup(key: Column, values: dict) -> Column:
    """Constant map as an expression: NULL for unknown keys, no join."""
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(values.items())])[key]


def case_number(case_id: Column, numbers: dict | None = None, default: int = C.CASE_DEFAULT) -> Column:
    """Case significance id to its stored number; unknown ids get the default."""
    return F.coalesce(lookup(case_id, numbers or C.CASE_NUMBERS), F.lit(default))


def assured_priority(is_assured: Column) -> Column:
    return F.when(is_assured, 1).otherwise(2)


def read_origin(term_type: Column) -> Column:
    """Read-code version of a map row: version 2 has no term type."""
    return F.when(F.length(term_type) < 1, C.READ_V2).otherwise(C.READ_V3)


def json_object(**fields: Column) -> Column:
    """JSON text with the fields in the given order."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def json_text(document: Column, name: str) -> Column:
    """One field of a JSON object as text."""
    return F.get_json_object(document, f"$.{name}")


def safe_name(name: Column) -> Column:
    """Snake case: capitalised words joined by ``_``; digits and other characters are lost."""
    return F.lower(F.array_join(F.regexp_extract_all(name, F.lit("[A-Z][a-z]*"), 0), "_"))


def smallest(first: Column, *others: Column) -> Column:
    return F.least(first, *others) if others else first


def largest(first: Column, *others: Column) -> Column:
    return F.greatest(first, *others) if others else first


def clamp(value: Column, low: Column, high: Column) -> Column:
    """``value`` kept within the two bounds, given in either order."""
    return F.least(F.greatest(value, F.least(low, high)), F.greatest(low, high))


def as_number(code: Column) -> Column:
    """Identifier text to a 64-bit number, for ordering."""
    return code.cast("bigint")


def or_today(day: Column) -> Column:
    return F.coalesce(day, F.current_date())


def or_empty(codes: Column) -> Column:
    return F.coalesce(codes, F.array().cast("array<string>"))


def codes_text(codes: Column) -> Column:
    """Code list as one text, blank-separated; NULL counts as empty."""
    return F.array_join(or_empty(codes), " ")


def array_text(text: Column) -> Column:
    """``{a,"b, c",NULL}`` text to an array; ``{}`` is the empty array, NULL stays NULL.

    A quoted element may hold commas, braces, and quotes and backslashes behind a backslash; blanks
    around elements do not count; an unquoted ``NULL`` of any case is one.
    """
    inner = F.regexp_replace(F.trim(text), r"(?s)^\{(.*)\}$", "$1")
    # the comma in front of each element makes empty matches impossible
    listed = F.regexp_extract_all(F.concat(F.lit(","), inner), F.lit(r'(?s),\s*("(?:[^"\\]|\\.)*"|(?:[^,"\\]|\\.)*)'), 1)

    def plain(x: Column) -> Column:
        trimmed = F.trim(x)
        quoted = trimmed.startswith('"')
        value = F.when(quoted, F.regexp_replace(trimmed, r'(?s)^"(.*)"$', "$1")).otherwise(trimmed)
        value = F.regexp_replace(value, r"(?s)\\(.)", "$1")
        return F.when(quoted | (F.upper(trimmed) != "NULL"), value)

    return F.when(F.trim(inner) == "", F.array().cast("array<string>")).otherwise(F.transform(listed, plain))


def has_flag(value: Column, flag: int) -> Column:
    """All bits of ``flag`` are set."""
    return value.bitwiseAND(F.lit(flag)) == flag

