"""Field decoding: source text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: date format, accepted uuid spellings ---
DATE_FORMAT = "yyyyMMdd"
UUID_SPELLINGS = (
    r"^(?:urn:uuid:)?[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    r"|^\{[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\}$"
    r"|^[0-9a-f]{32}$"
)


def decode_date(text: Column, strict: bool = True) -> Column:
    """``yyyyMMdd`` text to a date. Bad text raises, or is NULL when not strict."""
    dashed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    day = F.when(text.rlike(r"^\d{8}$"), dashed.try_cast("date"))
    if not strict:
        return day
    problem = F.raise_error(F.concat(F.lit("bad date: "), text)).cast("date")
    return F.coalesce(day, F.when(text.isNotNull(), problem))


def encode_date(day: Column) -> Column:
    return F.date_format(day, DATE_FORMAT)


def decode_uuid(text: Column) -> Column:
    """Canonical lower-case uuid; anything that is not one becomes NULL."""
    low = F.lower(text)
    hexes = F.regexp_replace(low, r"urn:uuid:|[{}-]", "")
    parts = [F.substring(hexes, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(low.rlike(UUID_SPELLINGS), F.concat_ws("-", *parts))


def decode_flag(text: Column, strict: bool = True) -> Column:
    """Boolean text; missing or empty is false. Unknown text raises, or is false when not strict."""
    flag = F.trim(text).try_cast("boolean")
    if not strict:
        return F.coalesce(flag, F.lit(False))
    problem = F.raise_error(F.concat(F.lit("bad flag: "), text)).cast("boolean")
    return F.coalesce(flag, F.when(text.isNull() | (F.trim(text) == ""), F.lit(False)), problem)


def decode_int(text: Column, default: int = 0, strict: bool = True) -> Column:
    """Integer text; missing or empty gives the default."""
    number = F.trim(text).try_cast("int")
    if not strict:
        return F.coalesce(number, F.lit(default))
    problem = F.raise_error(F.concat(F.lit("bad number: "), text)).cast("int")
    return F.coalesce(number, F.when(text.isNull() | (F.trim(text) == ""), F.lit(default)), problem)


def decode(kind: str, text: Column, default: str | None = None, strict: bool = True) -> Column:
    """Decode one field by its declared kind."""
    if kind == "date":
        return decode_date(text, strict)
    if kind == "uuid":
        return decode_uuid(text)
    if kind == "flag":
        return decode_flag(text, strict)
    if kind == "int":
        return decode_int(text, int(default or 0), strict)
    return F.coalesce(text, F.lit(default or ""))
