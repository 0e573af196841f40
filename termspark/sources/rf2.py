"""Release files: tab-separated text where quotes and backslashes are plain characters."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termspark.functions import decode as D
from termspark.operators import filters
from termspark.schemas import CTV_MAP, RAW_TABLES, REFSET_MAP, Table

TAB = "\t"

# --- fixed values: the white space dropped before a field ---
WHITE_SPACE = (
    "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def read_lines(
    spark: SparkSession, paths: str | list[str], comment: str | None = None, places: bool = False
) -> DataFrame:
    """Non-empty lines (column ``value``), ``\\r\\n`` read as ``\\n``; comment lines left out.

    Only ``\\n`` ends a line: a lone ``\\r`` is data. ``places`` adds the file of each line as ``_file``,
    whether it stands in its first block as ``_head``, and a number that rises inside a block as ``_at``.
    """
    lines = spark.read.option("lineSep", "\n").text(paths)
    where = []
    if places:
        where.append(F.col("_metadata.file_path").alias("_file"))
        where.append((F.col("_metadata.file_block_start") == 0).alias("_head"))
        where.append(F.monotonically_increasing_id().alias("_at"))
    lines = plain_lines(lines.select("value", *where))
    return lines if comment is None else lines.filter(~F.col("value").startswith(comment))


def plain_lines(lines: DataFrame) -> DataFrame:
    """Non-empty lines of a text scan (column ``value``); one trailing ``\\r`` belongs to the line end."""
    text = F.when(F.col("value").endswith("\r"), F.expr("substring(value, 1, length(value) - 1)"))
    return lines.withColumn("value", F.coalesce(text, F.col("value"))).filter(F.col("value") != "")


def trim_left(text: Column) -> Column:
    return F.ltrim(text, F.lit(WHITE_SPACE))


def split_fields(line: Column, separator: str = TAB, shift_empty: bool = False) -> Column:
    """Fields of a line, any number of them.

    ``shift_empty`` splits the way a trimming parser does that takes the separator itself for white
    space: an empty cell vanishes and later ones move left.
    """
    special = len(separator) != 1 or separator in ".$|()[{^?*+\\"
    pattern = f"\\Q{separator}\\E" if special else separator
    if shift_empty:
        return F.split(trim_left(line), f"{pattern}[{WHITE_SPACE}]*", -1)
    return F.split(line, pattern, -1)


def checked_fields(fields: Column, line: Column, width: Column | None, strict_quotes: bool) -> Column:
    """Raise on a wrong field count or, with ``strict_quotes``, on any quote."""
    checked = fields
    if width is not None:
        problem = F.raise_error(F.concat(F.lit("wrong number of fields: "), line))
        checked = F.when(F.size(fields) == width, checked).otherwise(problem.cast("array<string>"))
    if strict_quotes:
        problem = F.raise_error(F.concat(F.lit("bare quote: "), line))
        checked = F.when(~line.contains('"'), checked).otherwise(problem.cast("array<string>"))
    return checked


def read_layout(
    spark: SparkSession,
    paths: str | list[str],
    table: Table,
    separator: str = TAB,
    strict: bool = True,
    comment: str | None = None,
    exact_width: bool = False,
    strict_quotes: bool = False,
    shift_empty: bool = False,
) -> DataFrame:
    """Files into the columns of ``table``, each by its own header line.

    Columns are found by header name (several spellings per column); absent ones get their default.
    A file's header is its first line. One row per file comes to the driver; files of one layout are
    read by one expression.
    """
    lines = read_lines(spark, paths, comment, places=True)
    return parse_lines(lines, table, separator, strict, exact_width, strict_quotes, shift_empty)


def header_lines(lines: DataFrame) -> DataFrame:
    """``(_file, _header)``: the first line of each file.

    Its place is found first: with the text in the aggregate all lines of the first blocks would be sorted.
    """
    head = lines.filter("_head")
    first = head.groupBy("_file").agg(F.min("_at").alias("_at"))
    return head.join(F.broadcast(first), ["_file", "_at"]).select("_file", F.col("value").alias("_header"))


def parse_lines(
    lines: DataFrame,
    table: Table,
    separator: str = TAB,
    strict: bool = True,
    exact_width: bool = False,
    strict_quotes: bool = False,
    shift_empty: bool = False,
) -> DataFrame:
    """Lines of whole files, with their places, as rows of ``table``; see ``read_layout``."""
    spark = lines.sparkSession
    headers = header_lines(lines).collect()
    if not headers:
        return spark.createDataFrame([], table.struct)
    layouts = sorted({r["_header"] for r in headers})
    files = spark.createDataFrame([(r["_file"], r["_header"], layouts.index(r["_header"])) for r in headers], "_file string, _header string, _layout int")
    line = F.col("value")
    body = lines.join(F.broadcast(files), "_file").filter(line != F.col("_header"))
    fields = split_fields(line, separator, table.trim and shift_empty)
    names = [[n.strip() for n in header.split(separator)] for header in layouts]

    def by_layout(choices: list[Column]) -> Column:
        """One of several columns, by the file's layout."""
        if all(str(c) == str(choices[0]) for c in choices):
            return choices[0]
        found = choices[-1]
        for n, choice in enumerate(choices[:-1]):
            found = F.when(F.col("_layout") == n, choice).otherwise(found)
        return found

    width = by_layout([F.lit(len(n)) for n in names]) if exact_width else None
    # header lines have no fields: checks and decoding may run before they are filtered out
    fields = F.when(line != F.col("_header"), checked_fields(fields, line, width, strict_quotes))
    body = body.select(fields.alias("_fields"), "_layout")

    def text(headers: tuple[str, ...]) -> Column:
        places = [next((n.index(h) for h in headers if h in n), None) for n in names]
        return by_layout([F.lit(None).cast("string") if p is None else F.get("_fields", p) for p in places])

    texts = [text(c.headers) for c in table.columns]
    texts = [(trim_left(t) if table.trim else t).alias(c.name) for t, c in zip(texts, table.columns)]
    decoded = [D.decode(c.kind, F.col(c.name), c.default, strict).alias(c.name) for c in table.columns]
    return body.select(*texts).select(*decoded)


def keep_rows(df: DataFrame, table: Table) -> DataFrame:
    """The load filter of each table."""
    if table is REFSET_MAP:
        return filters.mapped_rows(df)
    if table is CTV_MAP:
        return filters.read_rows(df)
    return filters.with_id(df) if table.checks_id else df


def read_table(
    spark: SparkSession, base: str, release: str, table: Table, strict: bool = True, **options
) -> DataFrame:
    """One raw table of a release: every file pattern of the table, appended, filtered.

    Patterns that match no file add nothing.
    """
    whole = spark.createDataFrame([], table.struct)
    for pattern in table.files:
        try:
            part = read_layout(spark, f"{base}/{release}/{table.folder}/{pattern}", table, strict=strict, **options)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        whole = whole.unionByName(part)
    return keep_rows(whole, table).select(*table.names)


def read_release(spark: SparkSession, base: str, release: str, category: int, **options) -> dict[str, DataFrame]:
    """All raw tables of a release's category."""
    return {
        name: read_table(spark, base, release, table, **options)
        for name, table in RAW_TABLES.items()
        if category & table.category == table.category
    }
