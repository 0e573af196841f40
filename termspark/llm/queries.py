"""The operators over their whole tables, and SQL with the same results where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termspark.llm import (
    alignment,
    conversations,
    decontaminate,
    html_text,
    language,
    licenses,
    packing,
    perplexity,
    search,
    sharding,
    simhash,
    token_files,
    warc,
)
from termspark.llm.oracles import ORACLES
from termspark.llm.tokens import tokenizer_path
from termspark.session import staging_path, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
__all__ = ["ORACLES", "QUERIES"]


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark, sf_dir):
    """All documents against all benchmark items, in windows of ten words."""
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contamination_report(docs, benchmark)


@query
def op2_html_extraction(spark, sf_dir):
    """The main text of all pages."""
    return html_text.page_report(table(spark, sf_dir, "pages"))


@query
def op3_simhash(spark, sf_dir):
    """Near-duplicates among all documents: 64-bit fingerprints within 4 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def page_records(pages: DataFrame) -> DataFrame:
    """All pages as archive records: a later revisit each, and a full response for three of four.

    A fifth of the revisits name another entity tag, a seventh name none; a third name a time.
    """
    tag = F.md5(F.col("html").cast("binary"))
    changed = F.floor(F.col("page_id") / 100).cast("string")

    def headers(**named):
        made = F.create_map(*[x for name, v in named.items() for x in (F.lit(name.replace("_", "-")), v)])
        return F.map_filter(made, lambda _, v: v.isNotNull())

    full = pages.filter("page_id % 4 <> 1").select(
        (2 * F.col("page_id")).alias("record_id"),
        "url",
        (10 * F.col("page_id")).alias("ts"),
        F.lit(200).alias("status"),
        headers(
            cache_control=F.lit("max-age=60"),
            content_type=F.lit("text/html"),
            etag=F.concat(F.lit('"'), tag, F.lit('"')),
            last_modified=changed,
        ).alias("headers"),
    )
    own = F.when(F.col("page_id") % 5 == 0, F.lit('"stale"')).otherwise(F.concat(F.lit('W/"'), tag, F.lit('"')))
    revisit = pages.select(
        (2 * F.col("page_id") + 1).alias("record_id"),
        "url",
        (10 * F.col("page_id") + 5 + 100_000 * (F.col("page_id") % 2)).alias("ts"),
        F.lit(304).alias("status"),
        headers(
            cache_control=F.lit("no-cache"),
            content_type=F.lit("text/plain"),
            date=F.col("page_id").cast("string"),
            etag=F.when(F.col("page_id") % 7 != 0, own),
            last_modified=F.when(F.col("page_id") % 3 == 0, changed),
        ).alias("headers"),
    )
    return full.unionByName(revisit)


@query
def op4_warc_revisits(spark, sf_dir):
    """The revisits of all pages, resolved to full responses."""
    found = warc.resolve_revisits(page_records(table(spark, sf_dir, "pages")))
    entries = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.array_join(F.array_sort(entries), "; "))


@query
def op5_license_scan(spark, sf_dir):
    """Licenses named in all documents."""
    return licenses.license_report(table(spark, sf_dir, "documents"))


@query
def op6_language_codes(spark, sf_dir):
    """The language of all documents."""
    return language.language_report(table(spark, sf_dir, "documents"))


@query
def op7_block_max_search(spark, sf_dir):
    """The ten best of all documents for every document whose id is divisible by 20, whole texts as queries."""
    docs = table(spark, sf_dir, "documents")
    asked = docs.filter("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return search.top_documents(docs, asked)


@query
def op8_hierarchical_packing(spark, sf_dir):
    """All documents in windows of 1024, 512, 256 and 128 byte-pair ids."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


@query
def op9_virtual_slots(spark, sf_dir):
    """All documents in 24 shards of near-equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op10_arrow_token_files(spark, sf_dir):
    """All documents as Arrow stream files of ids, and one row per document read from them."""
    docs, folder = table(spark, sf_dir, "documents"), staging_path(spark, "token-files")
    index = token_files.write_token_files(docs, tokenizer_path("word_bpe_49k.json"), folder)
    return token_files.read_token_files(index, folder)


def damaged_turns(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults put in by a checksum of ``conv_id:turn``."""
    space = F.lit(" ")
    name = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    text = F.coalesce("text", space)
    made = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), fault.alias("fault"))
    made = made.filter("fault <> 0")
    made = made.withColumns(
        {
            "role": F.when(F.col("fault") == 4, "user").otherwise(F.col("role")),
            "text": F.when(F.col("fault") == 1, "")
            .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")),
            "copies": F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)),
        }
    )
    return made.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


@query
def op11_conversation_repair(spark, sf_dir):
    """All conversations, damaged and repaired."""
    rows = table(spark, sf_dir, "conversations")
    return conversations.structure_report(damaged_turns(rows), rows)


@query
def op12_quality_rules(spark, sf_dir):
    """All documents: base rules, and the perplexity bands of each language."""
    return perplexity.quality_report(table(spark, sf_dir, "documents"))


@query
def op13_token_alignment(spark, sf_dir):
    """All documents under two tokenizers, aligned by bytes."""
    docs = table(spark, sf_dir, "documents")
    return alignment.alignment_report(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
