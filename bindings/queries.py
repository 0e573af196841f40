"""Every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termspark import constants as C
from termspark import schemas as S
from termspark.functions import decode as D
from termspark.functions import scalar
from termspark.functions import text as X
from termspark.operators import checks, filters, lookup, maps, search, upsert, vectors
from termspark.operators.numbering import dense_ids
from termspark.plans import build, increment, indexes
from termspark.plans.classify import classify_descriptions
from termspark.plans.codelist import Codelist, build_codelist, numbered_concepts
from termspark.plans.ontology import number_tags, resolve_edges, tag_vectors
from termspark.session import stage, staging_path, tune
from termspark.sources import delimited, manifest, rf2, tables
from termspark.sources.partitioned import Partitioned
from termspark.streaming import load
from termspark.streaming.ingest import ingest_new_files, stream_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_tsv(df: DataFrame, label: str, path: str | None = None) -> str:
    """Tab-separated files with a header line and no quoting, as a release has them."""
    path = path or staging_path(df.sparkSession, label)
    df.write.options(sep="\t", header=True, quote="", emptyValue="", ignoreLeadingWhiteSpace=False,
                     ignoreTrailingWhiteSpace=False).csv(path)
    return path


# ---------------------------------------------------------------- scans and decoding


@query
def tsv_scan(spark, sf_dir):
    """Orders as a description file: scanned, decoded, rows without id dropped."""
    orders = table(spark, sf_dir, "orders")
    path = write_tsv(
        orders.select(
            F.col("o_orderkey").alias("id"),
            D.encode_date(F.col("o_orderdate")).alias("effectiveTime"),
            F.when(F.col("o_orderstatus") == "P", "0").otherwise("1").alias("active"),
            F.lit("m").alias("moduleId"),
            F.col("o_custkey").alias("conceptId"),
            F.lit("en").alias("languageCode"),
            F.col("o_orderstatus").alias("typeId"),
            F.concat(F.lit('"'), "o_orderpriority", F.lit('" \\ end')).alias("term"),
            F.lit("c").alias("caseSignificanceId"),
        ),
        "tsv",
    )
    rows = rf2.keep_rows(rf2.read_layout(spark, path, S.DESCRIPTION), S.DESCRIPTION)
    return rows.select(
        F.col("id").cast("bigint").alias("id"),
        "effective_time",
        "active",
        F.col("concept_id").cast("bigint").alias("concept_id"),
        "type_id",
        "term",
    )


@query
def date_decode(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = D.encode_date(F.col("o_orderdate"))
    return orders.select("o_orderkey", D.decode_date(text).alias("effective_time"))


@query
def uuid_decode(spark, sf_dir):
    """Accepted spellings by part type; one type has no uuid at all."""
    part = table(spark, sf_dir, "part")
    digest = F.md5(F.col("p_partkey").cast("string"))
    pieces = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    plain = F.concat_ws("-", *pieces)
    kind = F.col("p_type")
    text = (
        F.when(kind == "PROMO", F.concat(plain, F.lit("x")))
        .when(kind == "LARGE", F.concat(F.lit("{"), plain, F.lit("}")))
        .when(kind == "SMALL", F.concat(F.lit("urn:uuid:"), plain))
        .when(kind == "MEDIUM", F.upper(digest))
        .otherwise(plain)
    )
    return part.select("p_partkey", D.decode_uuid(text).alias("id"))


def write_release_table(df: DataFrame, base: str, release: str, declared: S.Table, pattern: str) -> None:
    """Files of one raw table at their place in a release folder, with its header names.

    ``df`` has the table's column names; dates and flags are written as releases do.
    """
    texts = {"date": D.encode_date, "flag": lambda c: F.when(c, "1").otherwise("0")}
    columns = [
        texts.get(c.kind, lambda x: x.cast("string"))(F.col(c.name)).alias(c.headers[0])
        for c in declared.columns
        if c.name in df.columns
    ]
    write_tsv(df.select(*columns), "", f"{base}/{release}/{declared.folder.replace('*', 'Clinically ')}/{pattern.replace('*', '1')}")


@query
def release_scan(spark, sf_dir):
    """Line items and orders as the two relationship files of a release, appended to one table."""
    base, release = staging_path(spark, "release"), "release 1"
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_shipdate").alias("effective_time"),
        (F.col("l_linestatus") == "O").alias("active"),
        F.col("l_partkey").alias("source_id"),
        F.col("l_suppkey").alias("destination_id"),
        F.col("l_linenumber").alias("relationship_group_id"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("effective_time"),
        (F.col("o_orderstatus") == "O").alias("active"),
        F.col("o_custkey").alias("source_id"),
        F.col("o_orderpriority").alias("type_id"),
    )
    for rows, pattern in zip((items, orders), S.RELATIONSHIP.files):
        write_release_table(rows, base, release, S.RELATIONSHIP, pattern)
    rows = rf2.read_table(spark, base, release, S.RELATIONSHIP)
    return rows.select(
        F.col("id").cast("bigint").alias("id"),
        "effective_time",
        "active",
        "source_id",
        "destination_id",
        "relationship_group_id",
        "type_id",
    )


@query
def manifest_scan(spark, sf_dir):
    """One manifest per order; the newest release per category (customer)."""
    orders = table(spark, sf_dir, "orders")
    newest = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("releaseDate"),
        F.col("o_orderkey").alias("archiveFileSizeBytes"),
    )
    older = F.struct(*[F.lit("old").alias(n) for n in ("id", "name", "releaseDate")], F.lit(0).cast("bigint").alias("archiveFileSizeBytes"))
    path = staging_path(spark, "manifests")
    orders.select(F.to_json(F.struct(F.lit("1").alias("apiVersion"), F.array(newest, older).alias("releases")))).write.text(path)
    releases = manifest.read_manifests(spark, path, one_per_file=False)
    rows = releases.select("name", "id", "releaseDate", F.col("archiveFileSizeBytes").alias("size"))
    return manifest.latest_release(rows, "name", ["releaseDate", "size"])


@query
def stored_table(spark, sf_dir):
    """Create a table, append to it by column name, and read what is stored."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    name, path = f"stored_{uuid.uuid4().hex}", staging_path(spark, "stored")
    tables.create(part.filter(F.col("p_type") == "PROMO"), name, path=path)
    tables.append(part.filter(F.col("p_type") != "PROMO").select("p_size", "p_type", "p_partkey"), name)
    return read_and_forget(spark, name, path)


@query
def refilled_table(spark, sf_dir):
    """Create a table, then empty and refill it."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    name, path = f"stored_{uuid.uuid4().hex}", staging_path(spark, "stored")
    tables.create(part, name, path=path)
    tables.replace(part.filter(F.col("p_type") != "SMALL"), name, managed=False)
    return read_and_forget(spark, name, path)


def read_and_forget(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The files of an external table; the catalog entry goes."""
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)


LAYOUT_TABLE = S.Table(
    "party",
    (
        S.Column("id", "text", ("id", "ID")),
        S.Column("name", "text", ("name", "NAME")),
        S.Column("nation", "int", ("nation", "NATION")),
        S.Column("map_priority", "int", ("mapPriority",), default="1"),
        S.Column("segment", "text", ("segment",)),
    ),
    folder="",
    files=(),
    category=0,
    trim=True,
)


@query
def layout_union(spark, sf_dir):
    """Files with other column names and order under one glob; absent columns get defaults."""
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    folder = staging_path(spark, "layouts")
    write_tsv(
        supplier.select(F.col("s_name").alias("NAME"), F.col("s_nationkey").alias("NATION"), F.col("s_suppkey").alias("ID")),
        "short",
        f"{folder}/short",
    )
    write_tsv(
        customer.select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("nation"),
            F.col("c_nationkey").alias("mapPriority"),
            F.col("c_mktsegment").alias("segment"),
        ),
        "full",
        f"{folder}/full",
    )
    rows = rf2.read_layout(spark, f"{folder}/*/*.csv", LAYOUT_TABLE)
    return rows.withColumn("id", F.col("id").cast("bigint"))


@query
def external_codemap(spark, sf_dir):
    """Concept -> ``{a,b}`` file, loaded and joined per concept: each target once, at its place."""
    part = table(spark, sf_dir, "part")
    path = staging_path(spark, "external")
    name = F.concat(F.lit('"'), "p_name", F.lit(', \\\\ or \\"so\\""'))
    codes = F.concat(F.lit("{"), F.col("p_partkey").cast("string"), F.lit(", "), name, F.lit(",NULL}"))
    lists = part.select(F.col("p_brand").alias("snomed_code"), codes.alias("codes"))
    delimited.export_delimited(lists, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("snomed_code", "codes")])
    loaded = delimited.load_delimited(spark, path, schema, header=False)
    parsed = loaded.select("snomed_code", scalar.array_text(F.col("codes")).alias("codes"))
    return maps.ordered_targets(maps.external_lists(parsed, "MeSH")).select("code", "source", "target", "ord")


@query
def delimited_roundtrip(spark, sf_dir):
    """Export with minimal quoting, load by position; empty text comes back as NULL."""
    customer = table(spark, sf_dir, "customer")
    path = staging_path(spark, "export")
    delimited.export_delimited(
        customer.select(
            "c_custkey",
            F.concat(F.lit(' "'), "c_name", F.lit('",\n'), "c_mktsegment").alias("label"),
            F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("segment"),
        ),
        path,
    )
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("label", T.StringType()),
            T.StructField("segment", T.StringType()),
        ]
    )
    return delimited.load_delimited(spark, path, schema, header=False)


@query
def quoted_documents(spark, sf_dir):
    """Whole texts with their line ends and quotes through quoted files; empty text comes back as NULL."""
    path = staging_path(spark, "texts")
    delimited.export_delimited(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("text", "lang")]])
    loaded = delimited.load_delimited(spark, path, schema, header=False)
    return loaded.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "lang")


@query
def incremental_ingest(spark, sf_dir):
    """File stream into a table, run twice: every row is there once."""
    target, checkpoint = staging_path(spark, "ingest"), staging_path(spark, "ingest-checkpoint")
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        ingest_new_files(stream_files(spark, sf_dir, schema, pathGlobFilter="events.parquet"), target, checkpoint)
    return spark.read.schema(schema).parquet(target).groupBy("event_type").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- filters and projections


@query
def drop_empty_id(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    key = F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_partkey").cast("string"))
    rows = filters.with_id(part.select(key.alias("id"), "p_name"))
    return rows.select(F.col("id").cast("bigint").alias("p_partkey"), "p_name")


PART_ORIGINS = {"ECONOMY": "OPCS4", "STANDARD": "ICD-10", "PROMO": "ReadCodeV2", "LARGE": "ReadCodeV3"}


@query
def origin_lookup(spark, sf_dir):
    """Map rows: empty and ``#`` targets and unknown refsets dropped, coding system added."""
    part = table(spark, sf_dir, "part")
    target = (
        F.when(F.col("p_size") < 5, "").when(F.col("p_size") > 45, F.concat(F.lit("#"), "p_name")).otherwise(F.col("p_name"))
    )
    rows = part.select("p_partkey", F.col("p_type").alias("refset_id"), target.alias("map_target"))
    return filters.mapped_rows(rows, origins=PART_ORIGINS).select("p_partkey", "map_target", F.col("map_origin").alias("origin"))


@query
def ctv_origin(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    rows = items.select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.when(F.col("l_discount") == 0, "#").otherwise(""), F.col("l_partkey").cast("string")).alias("map_target"),
        F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")).alias("map_origin"),
    )
    return filters.read_rows(rows)


@query
def map_priority(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        "l_orderkey", "l_linenumber", "l_partkey", scalar.assured_priority(F.col("l_linestatus") == "O").alias("priority")
    )


@query
def case_sig(spark, sf_dir):
    numbers = {"1-URGENT": 0, "2-HIGH": 2, "3-MEDIUM": 1}
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", scalar.case_number(F.col("o_orderpriority"), numbers).alias("case_sig"))


@query
def json_field(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", scalar.json_text(F.col("props"), "k").alias("k"))


@query
def category_filter(spark, sf_dir):
    """Rows whose bit flags hold both release categories."""
    part = table(spark, sf_dir, "part")
    wanted = C.CATEGORY_FLAGS["SNOMED_ALL"]
    return part.filter(manifest.in_category(F.col("p_size"), wanted)).select("p_partkey", "p_size")


@query
def snake_case(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", scalar.safe_name(F.concat("c_name", "c_mktsegment")).alias("safe"))


@query
def clamp(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", scalar.clamp(F.col("p_size"), F.lit(40), F.lit(10)).alias("clamped"))


@query
def smallest_largest(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    values = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_orderkey")]
    return items.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        scalar.smallest(*values).alias("smallest"),
        scalar.largest(*values).alias("largest"),
    )


@query
def array_texts(spark, sf_dir):
    """``{a,b}`` text to an array and on to blank-separated text; no list counts as empty."""
    part = table(spark, sf_dir, "part")
    listed = F.concat(F.lit('{"'), "p_name", F.lit(', x", '), "p_type", F.lit("}"))
    text = F.when(F.col("p_type") == "PROMO", None).when(F.col("p_type") == "LARGE", "{}").otherwise(listed)
    codes = scalar.array_text(text)
    return part.select("p_partkey", scalar.codes_text(codes).alias("codes"), F.size(scalar.or_empty(codes)).alias("n"))


@query
def latest_release(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    return manifest.latest_release(events, "event_type", ["ts", "event_id"])


# ---------------------------------------------------------------- classes, concepts, maps


def order_descriptions(spark, sf_dir) -> DataFrame:
    """Orders as descriptions of customers."""
    kind = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").cast("date").alias("effective_time"),
        (F.col("o_orderstatus") != "P").alias("active"),
        F.col("o_custkey").cast("string").alias("concept_id"),
        F.when(kind == "1-URGENT", C.FULLY_SPECIFIED_NAME)
        .when(kind == "2-HIGH", C.SYNONYM)
        .when(kind == "3-MEDIUM", C.DEFINITION)
        .otherwise("other")
        .alias("type_id"),
        F.concat_ws(" ", F.lit("the"), "o_orderpriority", F.lit("of"), F.col("o_orderkey").cast("string"), "o_orderstatus").alias("term"),
        F.when(F.col("o_totalprice") < 100000, C.CASE_FIRST_INSENSITIVE)
        .when(F.col("o_totalprice") < 200000, C.CASE_SENSITIVE)
        .when(F.col("o_totalprice") < 300000, C.CASE_INSENSITIVE)
        .otherwise("other")
        .alias("case_significance_id"),
    )


def item_refsets(spark, sf_dir) -> DataFrame:
    """Line items as language-refset rows of orders."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_linestatus") == "O").alias("active"),
        F.when(F.col("l_tax") > 0.06, "other").otherwise(C.REALM_LANGUAGE_REFSETS[0]).alias("refset_id"),
        F.col("l_orderkey").cast("string").alias("referenced_component_id"),
        F.when(flag == "A", C.PREFERRED).when(flag == "N", C.ACCEPTABLE).otherwise("other").alias("acceptability_id"),
    )


def customer_concepts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        (F.col("c_acctbal") > 0).alias("active"),
        F.lit("2020-01-01").cast("date").alias("effective_time"),
    )


@query
def classify_description(spark, sf_dir):
    rows = classify_descriptions(order_descriptions(spark, sf_dir), item_refsets(spark, sf_dir))
    return rows.select(F.col("id").cast("bigint").alias("o_orderkey"), "identifier")


@query
def concept_terms(spark, sf_dir):
    """Active concepts with their active terms, numbered densely over the whole result."""
    customer = filters.active(customer_concepts(spark, sf_dir)).select(F.col("id").cast("bigint").alias("c"))
    terms = filters.active(order_descriptions(spark, sf_dir)).select(
        F.col("concept_id").cast("bigint").alias("c"), F.col("id").cast("bigint").alias("o_orderkey")
    )
    numbered = dense_ids(customer.join(terms, "c"), [F.col("c"), F.col("o_orderkey")], "id")
    return numbered.select("id", F.col("c").cast("string").alias("code"), "o_orderkey")


@query
def named_concept(spark, sf_dir):
    """Active concepts with one fully specified name each, numbered by code."""
    described = classify_descriptions(order_descriptions(spark, sf_dir), item_refsets(spark, sf_dir))
    return numbered_concepts(customer_concepts(spark, sf_dir), described).select("id", "code", "description", "case_sig")


def item_feeds(spark, sf_dir) -> list[DataFrame]:
    """Line items as two map feeds."""
    items = table(spark, sf_dir, "lineitem")
    names = ("l_suppkey", "l_returnflag", "l_partkey")
    first = maps.map_feed(items.filter(F.col("l_linestatus") == "F"), *names, "l_linenumber")
    assured = scalar.assured_priority(F.col("l_discount") > 0.05)
    return [first, maps.map_feed(items.filter(F.col("l_linestatus") == "O"), *names, assured)]


@query
def map_union(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("code"))
    return maps.union_feeds(*[maps.of_concepts(f, suppliers) for f in item_feeds(spark, sf_dir)])


@query
def map_components(spark, sf_dir):
    return maps.best_priority(*item_feeds(spark, sf_dir))


@query
def codemap(spark, sf_dir):
    """Ordered code lists in long form: ``ord`` is the place in the list."""
    feeds = item_feeds(spark, sf_dir)
    return maps.ordered_targets(maps.best_priority(*feeds)).select("code", "source", "target", "ord")


PRIORITY_COLUMNS = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "unset": "4-NOT SPECIFIED", "low": "5-LOW"}
# entries of a list on one wide row
PAGE_ENTRIES = 4


@query
def codemap_pivot(spark, sf_dir):
    """Customers with one list of orders per priority, in pages; NULL where there is none."""
    orders = table(spark, sf_dir, "orders")
    rank = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    feed = maps.map_feed(orders, "o_custkey", "o_orderpriority", "o_orderkey", rank)
    lists = maps.list_columns(maps.ordered_targets(maps.best_priority(feed)), PRIORITY_COLUMNS, PAGE_ENTRIES)
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"))
    return customer.join(lists, "code", "left").select(
        "code",
        F.coalesce("page", F.lit(0)).alias("page"),
        *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in PRIORITY_COLUMNS],
    )


def order_versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Last order before 1996 per customer, and the last later one."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("code"),
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("value"),
        (F.col("o_orderstatus") != "P").alias("active"),
        F.col("o_orderdate").cast("date").alias("effective_time"),
    )
    early = F.col("effective_time") < "1996-01-01"
    order = ["effective_time", "id"]
    current, incoming = [upsert.latest_per_key(orders.filter(side), "code", order) for side in (early, ~early)]
    return current, incoming


@query
def codelist_upsert(spark, sf_dir):
    """Last order before 1996 per customer, updated from the last later order if active."""
    return upsert.upsert(*order_versions(spark, sf_dir))


@query
def merged_table(spark, sf_dir):
    """The same update of a stored table in partitions, from two batches of which one comes twice."""
    current, incoming = order_versions(spark, sf_dir)
    stored = Partitioned(spark, staging_path(spark, "merged"), current.schema, "code", 16)
    stored.replace_parts(current, stored.numbers(current, "code"))
    for batch in (1, 0, 1):
        upsert.upsert_partitions(stored, incoming.filter(F.col("code") % 2 == batch))
    return stored.read()


# ---------------------------------------------------------------- text vectors


@query
def synonym_lexemes(spark, sf_dir):
    """Vector aggregate: all part names of a brand one after the other."""
    part = table(spark, sf_dir, "part")
    return vectors.aggregate_texts(part, "p_brand", "p_partkey", "p_name", config=X.SIMPLE)


def part_vectors(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return vectors.text_vectors(part, ["p_partkey"], [(F.col("p_brand"), "A"), (F.col("p_name"), "B")], X.SIMPLE)


@query
def weighted_vector(spark, sf_dir):
    return part_vectors(spark, sf_dir)


@query
def reweighted_vector(spark, sf_dir):
    """Vectors with every weight set to C."""
    return vectors.set_weight(part_vectors(spark, sf_dir), "C")


@query
def joined_vector(spark, sf_dir):
    """Two vectors of an owner, one after the other; brands that have no name vector stay."""
    part = table(spark, sf_dir, "part")
    first = vectors.text_vectors(part, ["p_partkey"], [(F.col("p_brand"), "A")], X.SIMPLE)
    second = vectors.text_vectors(part, ["p_partkey"], [(F.col("p_name"), "B")], X.SIMPLE)
    return vectors.concatenate(first, second, ["p_partkey"])


def document_rows(spark, sf_dir, config: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return vectors.text_vectors(documents, ["doc_id"], [(F.col("text"), "D")], config)


@query
def document_vector(spark, sf_dir):
    """Whole documents to lexemes with positions, without stemming."""
    return document_rows(spark, sf_dir, X.SIMPLE)


@query
def english_vector(spark, sf_dir):
    """Positions that hold a lexeme in whole documents, after English stop words.

    A dotted code holds several lexemes at one position. Stems are in ``english_stems``.
    """
    rows = document_rows(spark, sf_dir, X.ENGLISH)
    return rows.groupBy("doc_id", "pos").agg(F.count("*").alias("n"))


@query
def english_stems(spark, sf_dir):
    """Sentences around the documents' ids in words with published stems."""
    documents = table(spark, sf_dir, "documents")
    words = " ".join(STEMS)
    text = F.concat_ws(" ", F.lit(words), F.col("source"), F.lit("of the"), F.col("lang"), F.lit(words))
    return vectors.text_vectors(documents, ["doc_id"], [(text, "B")], X.ENGLISH)


# --- fixed values: stems published with the algorithm ---
STEMS = {
    "consistency": "consist",
    "consolation": "consol",
    "conspicuous": "conspicu",
    "constancy": "constanc",
    "knackeries": "knackeri",
    "knavish": "knavish",
    "kneaded": "knead",
    "knives": "knive",
    "knocked": "knock",
    "hopping": "hop",
    "generously": "generous",
    "generate": "generat",
    "cries": "cri",
    "ties": "tie",
    "happy": "happi",
    "relational": "relat",
    "adjustment": "adjust",
}
# --- end of fixed values ---


@query
def english_part_vector(spark, sf_dir):
    """Part names and types with English stop words and stems."""
    part = table(spark, sf_dir, "part")
    text = F.concat_ws(" ", F.lit("The"), "p_name", F.lit("of"), "p_type")
    return vectors.text_vectors(part, ["p_partkey"], [(F.col("p_brand"), "A"), (text, "B")], X.ENGLISH)


def order_maps(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as code maps of customers, and a customer -> codes table."""
    orders = table(spark, sf_dir, "orders")
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    origin = F.when(status == "F", "OPCS4").when(status == "O", "ICD-10").otherwise("ReadCodeV2")
    refset = orders.select(
        (F.col("o_totalprice") > 50000).alias("active"),
        F.col("o_custkey").cast("string").alias("referenced_component_id"),
        origin.alias("map_origin"),
        F.concat(F.lit("T"), key, F.lit(".1")).alias("map_target"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("map_priority"),
    )
    read = orders.select(
        (F.col("o_totalprice") > 250000).alias("active"),
        F.col("o_custkey").cast("string").alias("concept_id"),
        F.when(status == "P", "ReadCodeV2").otherwise("ReadCodeV3").alias("map_origin"),
        F.when(status == "P", F.concat(F.lit("T"), key, F.lit(".1"))).otherwise(F.concat(F.lit("V"), key)).alias("map_target"),
        (status == "F").alias("is_assured"),
    )
    mesh = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 1000).select(
        F.col("c_custkey").cast("string").alias("snomed_code"), F.array("c_mktsegment", "c_name").alias("codes")
    )
    return refset, read, mesh


def customer_codelist(spark, sf_dir, config: str = X.SIMPLE) -> Codelist:
    """The whole codelist plan over customers, orders and line items."""
    described = classify_descriptions(order_descriptions(spark, sf_dir), item_refsets(spark, sf_dir))
    refset, read, mesh = order_maps(spark, sf_dir)
    return build_codelist(
        customer_concepts(spark, sf_dir), stage(described, "described"), refset, read, mesh, config=config
    )


@query
def codelist(spark, sf_dir):
    """Codelist rows: the concepts, and the first page of their lists."""
    return codelist_rows(customer_codelist(spark, sf_dir))


@query
def codelist_lists(spark, sf_dir):
    """The complete code lists in long form."""
    return customer_codelist(spark, sf_dir).lists.select("code", "source", "ord", "target")


def write_codelist_release(spark, sf_dir, base: str, release: str) -> DataFrame:
    """Customers, orders and line items as the files of a release; returns the customer -> codes table."""
    refset, read, mesh = order_maps(spark, sf_dir)
    refsets = {"OPCS4": "1126441000000105", "ICD-10": "446608001", "ReadCodeV2": "999002721000000108"}
    refset = refset.withColumn("refset_id", scalar.lookup(F.col("map_origin"), refsets)).drop("map_origin")
    read = read.withColumn("map_origin", F.when(F.col("map_origin") == "ReadCodeV2", "").otherwise("P"))
    day = F.lit("2020-01-01").cast("date")
    for declared, rows in (
        (S.CONCEPT, customer_concepts(spark, sf_dir)),
        (S.DESCRIPTION, order_descriptions(spark, sf_dir)),
        (S.RELATIONSHIP, customer_links(spark, sf_dir)),
        (S.REFSET_LANG, item_refsets(spark, sf_dir).withColumn("effective_time", day)),
        (S.REFSET_MAP, refset.withColumn("effective_time", day)),
        (S.CTV_MAP, read.withColumn("effective_time", day)),
    ):
        write_release_table(rows, base, release, declared, declared.files[0])
    return mesh


def customer_links(spark, sf_dir) -> DataFrame:
    """Orders as relationships of their customer to the customer of a tenth of the number."""
    key = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").cast("date").alias("effective_time"),
        (F.col("o_orderstatus") != "P").alias("active"),
        key.cast("string").alias("source_id"),
        F.floor(key / 10).cast("string").alias("destination_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "other").otherwise(C.IS_A).alias("type_id"),
    )


@query
def release_codelist(spark, sf_dir):
    """The codelist from release files: written, scanned, filtered, classified and built."""
    base, release = staging_path(spark, "release"), "release 1"
    mesh = write_codelist_release(spark, sf_dir, base, release)
    raw = rf2.read_release(spark, base, release, C.CATEGORY_FLAGS["SNOMED_ALL"])
    described = stage(classify_descriptions(raw["description"], raw["refset_lang"]), "described")
    built = build_codelist(raw["concept"], described, raw["refset_map"], raw["ctv_map"], mesh, config=X.SIMPLE)
    return codelist_rows(built)


def codelist_rows(built: Codelist) -> DataFrame:
    lists = maps.list_columns(built.lists, C.CODE_LIST_COLUMNS, 1000)
    columns = [F.array_join(F.col(c), ",").alias(c) for c in C.CODE_LIST_COLUMNS]
    rows = built.concepts.join(lists, "code", "left")
    return rows.select("id", "code", F.coalesce("page", F.lit(0)).alias("page"), "description", "case_sig", *columns)


@query
def codelist_vectors(spark, sf_dir):
    """The three vectors of the codelist, one row per occurrence."""
    return customer_codelist(spark, sf_dir).vectors


@query
def codelist_english(spark, sf_dir):
    """The vectors with English stop words and stems."""
    return customer_codelist(spark, sf_dir, X.ENGLISH).vectors


@query
def tag_vector(spark, sf_dir):
    """Search vectors of ontology tags built from the codelist."""
    built = customer_codelist(spark, sf_dir)
    return tag_vectors(built.concepts, stage(built.vectors, "vectors"), X.SIMPLE)


def raw_frames(spark, sf_dir) -> dict[str, DataFrame]:
    """Customers, orders and line items as raw tables, absent columns NULL."""
    refset, read, _ = order_maps(spark, sf_dir)
    day = F.lit("2020-01-01").cast("date")
    given = {
        "concept": customer_concepts(spark, sf_dir),
        "description": order_descriptions(spark, sf_dir),
        "refset_lang": item_refsets(spark, sf_dir),
        "refset_map": refset,
        "ctv_map": read,
    }
    frames = {}
    for name, df in given.items():
        df = df.withColumn("effective_time", day) if "effective_time" not in df.columns else df
        fields = S.RAW_TABLES[name].struct
        frames[name] = df.select(
            *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
        )
    return frames


def incremental_store(spark, sf_dir) -> increment.Store:
    """A store filled by two batches of raw rows, the second one applied twice. Built once for a session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        store = increment.Store(spark, staging_path(spark, "store"), parts=8, config=X.SIMPLE)
        frames = raw_frames(spark, sf_dir)
        for number in (1, 2, 2):
            # rows of one concept come in both batches
            batch = {n: df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(2)) == number % 2) for n, df in frames.items()}
            increment.apply_batch(store, batch, number)
        _stores[key] = store
    return _stores[key]


_stores: dict[tuple[str, str], increment.Store] = {}


@query
def incremental_concepts(spark, sf_dir):
    """Concepts derived batch by batch."""
    return incremental_store(spark, sf_dir).table("concepts").select("code", "description", "case_sig")


@query
def incremental_lists(spark, sf_dir):
    """Code lists derived batch by batch, in their order."""
    return incremental_store(spark, sf_dir).table("lists").select("code", "source", "ord", "target")


@query
def drop_load(spark, sf_dir):
    """Orders as description files of two drops, loaded by a stream that runs after each drop and once more."""
    orders = order_descriptions(spark, sf_dir)
    base, landing, checkpoint = (staging_path(spark, name) for name in ("drops", "landing", "checkpoint"))
    for number, half in enumerate((F.col("active"), ~F.col("active"))):
        write_release_table(orders.filter(half), base, f"release {number}", S.DESCRIPTION, S.DESCRIPTION.files[0])
        for _ in range(number + 1):
            load.land_table(spark, base, landing, checkpoint, "description")
    rows = load.landed(spark, landing, "description")
    return rows.select(
        F.col("id").cast("bigint").alias("id"), "effective_time", "active", F.col("concept_id").cast("bigint").alias("concept_id"), "term"
    )


@contextmanager
def built_release(spark, sf_dir):
    """Inside, every stored table of a whole build from release files is in the current database.

    Built once for a session and a folder of tables, in a database below the staging folder.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    before = spark.catalog.currentDatabase()
    if key not in _built:
        base, name = staging_path(spark, "release"), f"build_{uuid.uuid4().hex}"
        mesh = write_codelist_release(spark, sf_dir, base, "release 1")
        spark.sql(f"CREATE DATABASE {name} LOCATION '{staging_path(spark, 'database')}'")
        spark.catalog.setCurrentDatabase(name)
        try:
            category = C.CATEGORY_FLAGS["SNOMED_ALL"]
            build.build_release(spark, base, [("release 1", category)], mesh=mesh, config=X.SIMPLE)
        finally:
            spark.catalog.setCurrentDatabase(before)
        _built[key] = name
    spark.catalog.setCurrentDatabase(_built[key])
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


# databases of the builds, by session and folder of tables
_built: dict[tuple[str, str], str] = {}


@query
def built_tags(spark, sf_dir):
    """Tags of the whole build: scan, store, classify, codelist, ontology."""
    with built_release(spark, sf_dir):
        return spark.table(S.TAG_TABLE).select("id", "code", "name", "type_id", "properties")


@query
def built_edges(spark, sf_dir):
    """Edges of the whole build: active is-a links between tags, numbered."""
    with built_release(spark, sf_dir):
        return spark.table(S.EDGE_TABLE)


@query
def built_search(spark, sf_dir):
    """Text, code and similarity searches on the stored posting tables."""
    with built_release(spark, sf_dir):
        found = [
            ("text", indexes.search_text(spark, "1 URGENT the urgent", config=X.SIMPLE)),
            ("weight", indexes.search_text(spark, "1 2 HIGH", vector="search", weights="B", config=X.SIMPLE)),
            ("any", indexes.search_text(spark, "t7 v3 machinery", vector="relation", every=False, config=X.SIMPLE)),
            ("target", indexes.search_targets(spark, "MeSH", ["MACHINERY", "BUILDING"])),
            ("similar", indexes.search_similar(spark, "the 1-URGENT of 100 F", threshold=0.6).select("code")),
        ]
    rows = [df.select(F.lit(kind).alias("kind"), "code") for kind, df in found]
    every = rows[0]
    for one in rows[1:]:
        every = every.unionByName(one)
    return every


@query
def reference_columns(spark, sf_dir):
    """Every declared reference of line items that finds no target, in one scan."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("part"),
        (F.col("l_suppkey") * 2).cast("string").alias("supplier"),
        F.col("l_orderkey").cast("string").alias("source"),
        (F.col("l_orderkey") + 7).cast("string").alias("target"),
    )
    known = {
        "part": table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id")),
        "supplier": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("id")),
        "order": table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id")),
    }
    return checks.declared_orphans({"item": items, **known}, ITEM_REFERENCES)


ITEM_REFERENCES = S.Table(
    "item",
    (
        S.Column("part", "text", (), refers_to=("part", "id")),
        S.Column("supplier", "text", (), refers_to=("supplier", "id")),
        S.Column("source", "text", (), refers_to=("order", "id")),
        S.Column("target", "text", (), refers_to=("order", "id")),
    ),
    folder="",
    files=(),
    category=0,
    trim=False,
)


@query
def replaced_table(spark, sf_dir):
    """A stored table replaced from a plan that reads it."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    name = f"replaced_{uuid.uuid4().hex}"
    tables.create(part, name)
    tables.replace(spark.table(name).filter(F.col("p_size") > 10).withColumn("p_size", F.col("p_size") * 2), name)
    rows = stage(spark.table(name), "replaced")
    spark.sql(f"DROP TABLE {name}")
    return rows


# ---------------------------------------------------------------- ontology


def party_codes(spark, sf_dir) -> DataFrame:
    """Regions, nations and customers as codes."""
    region, nation, customer = [table(spark, sf_dir, n) for n in ("region", "nation", "customer")]
    parts = [(region, "R", "r_regionkey", "r_name"), (nation, "N", "n_nationkey", "n_name"), (customer, "C", "c_custkey", "c_name")]
    rows = [df.select(F.concat(F.lit(p), F.col(k).cast("string")).alias("code"), F.col(n).alias("name")) for df, p, k, n in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def ontology_tags(spark, sf_dir):
    tags = number_tags(party_codes(spark, sf_dir), root="R0")
    return tags.select(
        F.col("tag_id").alias("id"),
        "name",
        F.lit(C.TAG_DISEASE).alias("type_id"),
        scalar.json_object(code=F.col("code"), coding_system_id=F.lit(C.CODING_SYSTEM)).alias("properties"),
    )


@query
def ontology_edges(spark, sf_dir):
    tags = number_tags(party_codes(spark, sf_dir), root="R0").select("code", F.col("tag_id").alias("id"))
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")

    def link(df, child, child_key, parent, parent_key):
        return df.select(
            F.concat(F.lit(child), F.col(child_key).cast("string")).alias("source_id"),
            F.concat(F.lit(parent), F.col(parent_key).cast("string")).alias("destination_id"),
        )

    links = link(nation, "N", "n_nationkey", "R", "n_regionkey").unionByName(
        link(customer, "C", "c_custkey", "N", "c_nationkey")
    )
    return resolve_edges(filters.is_a_edges(links, kind=None, root="R0"), tags)


# ---------------------------------------------------------------- lookups


@query
def text_match(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.filter(lookup.has_lexemes(X.tokenize(F.col("p_name")), ["red", "widget"])).select("p_partkey")


@query
def posting_match(spark, sf_dir):
    """Documents that hold all lexemes of a query, from postings."""
    documents = table(spark, sf_dir, "documents")
    postings = vectors.text_vectors(documents, ["doc_id"], [(F.col("source"), "A"), (F.col("text"), "D")], X.SIMPLE)
    return lookup.match_lexemes(postings, ["and", "the", "and"], owner="doc_id", weights="D")


@query
def tree_match(spark, sf_dir):
    """Documents that hold a phrase, or two words of which one begins a given way, and not a third."""
    rows = document_rows(spark, sf_dir, X.SIMPLE).withColumnRenamed("doc_id", "code")
    word = search.Word
    tree = (search.phrase("of", "the") | (word("la") & word("que", prefix=True)) | search.Phrase(word("der"), word("und"), 2)) & ~word("is")
    return search.match_tree(rows, tree).select(F.col("code").alias("doc_id"))


@query
def pattern_match(spark, sf_dir):
    """Documents that match a LIKE pattern, and a regular expression, through their trigrams."""
    documents = table(spark, sf_dir, "documents")
    grams = stage(search.word_trigrams(documents, "doc_id"), "word-trigrams")
    found = [
        search.match_pattern(documents, grams, pattern, kind, "doc_id").select("doc_id", F.lit(kind).alias("kind"))
        for kind, pattern in (("like", "%license%under%"), ("rlike", "(the|and) [a-z]*ation(al)? of"))
    ]
    return found[0].unionByName(found[1])


@query
def array_lookup(spark, sf_dir):
    rows = maps.union_feeds(*item_feeds(spark, sf_dir))
    return lookup.owners_of_codes(rows, "A", [5, 17, 99])


@query
def list_overlap(spark, sf_dir):
    """Customers whose wide list of orders of any priority overlaps a set of codes."""
    orders = table(spark, sf_dir, "orders")
    feed = maps.map_feed(orders, "o_custkey", "o_orderpriority", "o_orderkey", F.lit(1))
    ordered = maps.ordered_targets(maps.best_priority(feed)).withColumn("target", F.col("target").cast("string"))
    lists = maps.list_columns(ordered, PRIORITY_COLUMNS, PAGE_ENTRIES)
    wanted = ["3", "17", "41", "99"]
    hit = F.lit(False)
    for column in PRIORITY_COLUMNS:
        hit = hit | F.coalesce(lookup.list_overlaps(F.col(column), wanted), F.lit(False))
    return lists.filter(hit).select("code").distinct()


@query
def trigram_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return lookup.similar_rows(part, "p_name", "red widgit").select("p_partkey", F.round("sim", 6).alias("sim"))


@query
def trigram_index_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    postings = lookup.trigram_postings(part, "p_partkey", "p_name")
    found = lookup.similar_owners(postings, "red widgit", owner="p_partkey")
    return found.select("p_partkey", F.round("sim", 6).alias("sim"))


# ---------------------------------------------------------------- checks


@query
def orphan_check(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return checks.unreferenced(orders, "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def reference_check(spark, sf_dir):
    """Line items whose supplier is no active supplier."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    known = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 0)
    return checks.orphans(items, "l_suppkey", known, "s_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query
def unique_check(spark, sf_dir):
    return checks.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def bounds_check(spark, sf_dir):
    return checks.too_long(table(spark, sf_dir, "part"), "p_name", 10).select("p_partkey", "len")


PART_BOUNDS = S.Table(
    "part",
    (
        S.Column("p_name", "text", (), size=10),
        S.Column("p_brand", "text", (), size=7),
        S.Column("p_type", "text", (), size=25),
    ),
    folder="",
    files=(),
    category=0,
    trim=False,
)


@query
def declared_bounds(spark, sf_dir):
    """Every broken text bound of a table in one scan, counted by value."""
    found = checks.out_of_bounds(table(spark, sf_dir, "part"), PART_BOUNDS)
    return found.groupBy("column", "value", "len").agg(F.count("*").alias("n"))


@query
def enum_check(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return checks.not_in_enum(orders, "o_orderstatus", ("F", "O")).select("o_orderkey", "o_orderstatus")


@query
def foreign_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    active = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    return checks.broken_edges(orders, active, ["o_custkey"], "c_custkey")
