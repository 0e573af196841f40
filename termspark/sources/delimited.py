"""Generic delimited files: load by position, export with minimal quoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termspark.functions import scalar
from termspark.sources import quoted as quoted_text


def load_delimited(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    separator: str = ",",
    header: bool = True,
    line_ends: bool = True,
) -> DataFrame:
    """Standard quoted text, columns by position, header line skipped; unquoted empty is NULL.

    ``line_ends`` allows them inside quoted fields; without it a line end in a field fails the job. Large
    files are split in either case. Quotes come in pairs in a file; a field with one is quoted.
    """
    options = {"sep": separator, "quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "FAILFAST"}
    if line_ends:
        records = quoted_text.read_records(spark, paths, header)
        parsed = F.from_csv("text", schema.simpleString(), {**options, "multiLine": "true"})
        return records.select(parsed.alias("r")).select("r.*")
    return spark.read.schema(schema).options(header=header, enforceSchema=True, **options).csv(paths)


def load_code_lists(spark: SparkSession, paths: str | list[str], separator: str = ",") -> DataFrame:
    """External concept -> codes file (codes as ``{a,b}``): (snomed_code, codes array)."""
    schema = T.StructType([T.StructField("snomed_code", T.StringType()), T.StructField("codes", T.StringType())])
    raw = load_delimited(spark, paths, schema, separator)
    return raw.select("snomed_code", scalar.array_text(F.col("codes")).alias("codes"))


def quoted(text: Column, separator: str = ",", crlf: bool = False) -> Column:
    """One field as written: quoted only where needed, inner quotes doubled, NULL as nothing.

    Needed means: holds the separator, a quote or a line end, starts with white space, or is ``\\.``.
    """
    value = F.coalesce(text, F.lit(""))
    needs = (
        value.contains(separator)
        | value.contains('"')
        | value.contains("\n")
        | value.contains("\r")
        | value.rlike(r"^(?U)\s")
        | (value == "\\.")
    )
    inner = F.replace(value, F.lit('"'), F.lit('""'))
    if crlf:
        inner = F.replace(F.replace(inner, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit("\r\n"))
    return F.when(needs, F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(value)


def export_delimited(
    df: DataFrame, path: str, separator: str = ",", crlf: bool = False, mode: str = "errorifexists"
) -> None:
    """Write all columns as delimited text without a header, one file per partition."""
    fields = [quoted(F.col(c).cast("string"), separator, crlf) for c in df.columns]
    lines = df.select(F.concat_ws(separator, *fields).alias("value"))
    lines.write.mode(mode).option("lineSep", "\r\n" if crlf else "\n").text(path)
