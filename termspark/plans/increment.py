"""Incremental derivation: new raw rows change the concepts they touch, and nothing else.

All tables of a store are in hash partitions: raw rows by the concept they belong to (language refset rows by their
description), derived rows by code, edges by their child. A batch of raw rows names the touched codes; their
raw rows are read from their partitions, their concepts, lists, vectors, tags and edges are derived anew by
the functions of the full build, and only the partitions that hold them are replaced. A code keeps its ids;
new codes are numbered after the last one.

Of several raw rows with one id the latest ``effective_time`` counts. A component's concept, and both ends of a
relationship, never change between its versions, as the release format has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termspark import constants as C
from termspark import schemas as S
from termspark.functions import scalar
from termspark.functions import text as X
from termspark.operators import filters, maps
from termspark.operators.numbering import dense_ids
from termspark.operators.upsert import latest_per_key
from termspark.plans.classify import classify_descriptions
from termspark.plans.codelist import Codelist, build_lists, concept_vectors, named_concepts, synonym_texts, vector_parts
from termspark.plans.ontology import build_tag_vectors
from termspark.session import drop_staged, staging_path
from termspark.sources.partitioned import Partitioned, PartitionedLog
from termspark.streaming import load

# the column that says where a raw row is kept
OWNERS = {
    "concept": "id",
    "description": "concept_id",
    "refset_lang": "referenced_component_id",
    "refset_map": "referenced_component_id",
    "ctv_map": "concept_id",
    "relationship": "source_id",
}
VECTOR = "code string, vector string, lexeme string, pos bigint, weight string"
DERIVED = {
    "concepts": ("code", "id bigint, code string, description string, case_sig int, active boolean, effective_time date"),
    "lists": ("code", "code string, source string, target string, priority int, ord bigint"),
    "vectors": ("code", VECTOR),
    "tags": ("code", "id bigint, code string, name string, type_id int, reference_id bigint, properties string"),
    "tag_vectors": ("code", VECTOR),
    "edges": ("child", "id bigint, child_id bigint, parent_id bigint, child string, parent string"),
}
# small tables that lead from a row to the codes it touches
WAYS = {
    "described": ("id", "id string, concept_id string"),
    "children": ("parent", "parent string, child string"),
}
NUMBERED = ("concepts", "tags", "edges")
LAST_IDS = "number string, name string, last bigint"


def current_rows(df: DataFrame) -> DataFrame:
    """The latest row of every id; rows without an id all stay."""
    others = [c for c in df.columns if c not in ("id", "effective_time")]
    known = df.filter("id is not null")
    latest = latest_per_key(known, "id", ["effective_time", *others])
    return latest.select(*df.columns).unionByName(df.filter("id is null"))


class Store:
    """The tables of an incremental build below ``path``."""

    def __init__(self, spark: SparkSession, path: str, parts: int = 256, config: str = X.ENGLISH, null_safe: bool = False):
        self.spark, self.path, self.config, self.null_safe = spark, path.rstrip("/"), config, null_safe
        self.raw = {
            name: PartitionedLog(spark, f"{self.path}/raw_{name}", S.RAW_TABLES[name].struct, owner, parts)
            for name, owner in OWNERS.items()
        }
        self.ways = {
            name: PartitionedLog(spark, f"{self.path}/{name}", T.StructType.fromDDL(columns), key, parts)
            for name, (key, columns) in WAYS.items()
        }
        self.derived = {
            name: Partitioned(spark, f"{self.path}/{name}", T.StructType.fromDDL(columns), key, parts)
            for name, (key, columns) in DERIVED.items()
        }
        self.ids = PartitionedLog(spark, f"{self.path}/last_ids", T.StructType.fromDDL(LAST_IDS), "name", 1)

    def table(self, name: str) -> DataFrame:
        """A derived table, whole."""
        return self.derived[name].read()

    def last_id(self, name: str, batch: str) -> int:
        """The highest id given to rows of a table before a batch."""
        row = self.ids.read().filter((F.col("name") == name) & (F.col("number") < batch)).agg(F.max("last")).first()
        return row[0] or 0


class _Staged:
    """Tables of one batch that are written once and dropped at its end."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        path = staging_path(self.spark, label)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for path in self.paths:
            drop_staged(self.spark, path)


def _of_keys(table: Partitioned, keys: DataFrame, column: str) -> DataFrame:
    """The rows of a table whose key is among ``keys``, from their partitions only."""
    wanted = keys.select(F.col(column).alias(table.key)).distinct()
    return table.read(table.numbers(wanted, table.key)).join(wanted, table.key, "left_semi").select(*table.schema.names)


def touched_codes(store: Store, batch: dict[str, DataFrame]) -> DataFrame:
    """``code``: the concepts that new raw rows may change.

    A language refset row touches the concept of its description, known or in the same batch.
    """
    columns = [("concept", "id"), ("description", "concept_id"), ("refset_map", "referenced_component_id"),
               ("ctv_map", "concept_id"), ("relationship", "source_id"), ("relationship", "destination_id")]
    found = [batch[name].select(F.col(column).alias("code")) for name, column in columns if name in batch]
    if "refset_lang" in batch:
        component = batch["refset_lang"].select(F.col("referenced_component_id").alias("id")).distinct()
        found.append(_of_keys(store.ways["described"], component, "id").select(F.col("concept_id").alias("code")))
        if "description" in batch:
            new = batch["description"].select("id", F.col("concept_id").alias("code"))
            found.append(component.join(new, "id").select("code"))
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    return every.filter("code is not null").distinct()


def _numbered(rows: DataFrame, known: DataFrame, key: list[str], order: list, last: int) -> DataFrame:
    """``rows`` with the ``id`` that their key has in ``known``, or the next one in order."""
    ids = known.select(*key, F.col("id").alias("_known"))
    joined = rows.join(ids, key, "left")
    old = joined.filter("_known is not null").withColumnRenamed("_known", "id")
    new = dense_ids(joined.filter("_known is null").drop("_known"), order, "id").withColumn("id", F.col("id") + last)
    return old.unionByName(new)


def apply_batch(store: Store, batch: dict[str, DataFrame], number: int) -> dict[str, list[int]]:
    """Add new raw rows (by raw table name) and derive anew what they touch; returns the partitions replaced.

    Numbers of batches rise. Running the same batch again, also after it failed half way, changes nothing
    more. An empty store gets a full build this way.
    """
    spark, name_of = store.spark, f"{number:012d}"
    staged = _Staged(spark)
    batch = {name: staged(df.select(*S.RAW_TABLES[name].names), f"new-{name}") for name, df in batch.items()}
    if not batch:
        return {}
    for name, df in batch.items():
        store.raw[name].append(df, name_of)
    if "description" in batch:
        store.ways["described"].append(batch["description"].select("id", "concept_id").distinct(), name_of)
    if "relationship" in batch:
        links = filters.is_a_edges(batch["relationship"])
        pairs = links.select(F.col("destination_id").alias("parent"), F.col("source_id").alias("child")).distinct()
        store.ways["children"].append(pairs, name_of)
    touched = staged(touched_codes(store, batch), "touched")

    # the raw rows of the touched codes
    def own(name: str) -> DataFrame:
        return current_rows(_of_keys(store.raw[name], touched, "code"))

    description = staged(own("description"), "descriptions")
    marks = current_rows(_of_keys(store.raw["refset_lang"], description, "id"))
    classified = staged(classify_descriptions(description, marks), "classified")
    named = named_concepts(own("concept"), classified)
    known = _of_keys(store.derived["concepts"], touched, "code")
    order = [scalar.as_number(F.col("code"))]
    concepts = staged(_numbered(named, known, ["code"], order, store.last_id("concepts", name_of)), "concepts")
    feeds = [
        maps.refset_feed(filters.active(own("refset_map"))),
        maps.read_feed(filters.active(own("ctv_map"))),
    ]
    lists = staged(build_lists(concepts, feeds), "lists")
    vectors = concept_vectors(vector_parts(concepts, synonym_texts(classified), lists), store.config, store.null_safe)
    vectors = staged(vectors, "vectors")
    coded = concepts.filter(F.col("code") != C.ROOT_CONCEPT)
    tags = coded.select(
        "code",
        F.col("description").alias("name"),
        F.lit(C.TAG_DISEASE).alias("type_id"),
        F.lit(None).cast("bigint").alias("reference_id"),
        scalar.json_object(code=F.col("code"), code_id=F.col("id"), coding_system_id=F.lit(C.CODING_SYSTEM)).alias("properties"),
    )
    known = _of_keys(store.derived["tags"], touched, "code")
    tags = staged(_numbered(tags, known, ["code"], [F.col("code")], store.last_id("tags", name_of)), "tags")
    tag_vectors = build_tag_vectors(Codelist(concepts, lists, vectors), store.config)
    replaced = {}
    for name, df in (("concepts", concepts), ("lists", lists), ("vectors", vectors), ("tags", tags), ("tag_vectors", tag_vectors)):
        replaced[name] = store.derived[name].replace_keys(touched, df)
    replaced["edges"] = _edges(store, touched, name_of, staged)
    highest = [
        (name_of, name, df.agg(F.max("id")).first()[0])
        for name, df in (("concepts", concepts), ("tags", tags), ("edges", _of_keys(store.derived["edges"], touched, "code")))
    ]
    last = [(n, name, max(top or 0, store.last_id(name, name_of))) for n, name, top in highest]
    store.ids.append(spark.createDataFrame(last, store.ids.schema), name_of)
    staged.drop()
    return replaced


def _edges(store: Store, touched: DataFrame, batch: str, staged: _Staged) -> list[int]:
    """Edges of the touched codes and of the children of touched parents; tags are already replaced."""
    below = _of_keys(store.ways["children"], touched, "code").select(F.col("child").alias("code"))
    children = staged(touched.unionByName(below).distinct(), "children")
    links = filters.is_a_edges(filters.active(current_rows(_of_keys(store.raw["relationship"], children, "code"))))
    pairs = staged(
        links.select(F.col("source_id").alias("child"), F.col("destination_id").alias("parent")).distinct(), "pairs"
    )
    sides = []
    for side in ("child", "parent"):
        tags = _of_keys(store.derived["tags"], pairs, side)
        sides.append(tags.select(F.col("code").alias(side), F.col("id").alias(f"{side}_id")))
    found = pairs.join(sides[0], "child").join(sides[1], "parent")
    known = _of_keys(store.derived["edges"], children, "code")
    ordered = [F.col("child_id"), F.col("parent_id")]
    edges = staged(_numbered(found, known, ["child", "parent"], ordered, store.last_id("edges", batch)), "edges")
    return store.derived["edges"].replace_keys(children.withColumnRenamed("code", "child"), edges)


def apply_drops(
    store: Store, base: str, landing: str, checkpoint: str, category: int, **options
) -> tuple[int, bool]:
    """Land the files of a drop folder that are new, and apply what landed since the last batch.

    Returns the number of the last batch, and whether there was anything to apply. Which micro-batches a batch takes
    is written down before it runs, so a batch that failed is run again as it was.
    """
    spark = store.spark
    load.land_drops(spark, base, landing, checkpoint, category, **options)
    plans = PartitionedLog(spark, f"{store.path}/batches", T.StructType.fromDDL("number bigint, name string, drop string"), "name", 1)
    planned = plans.read().collect()
    taken = {(r["name"], r["drop"]) for r in planned}
    last = max((r["number"] for r in planned), default=0)
    new = [(name, drop) for name in OWNERS for drop in load.drops_of(spark, landing, name) if (name, drop) not in taken]
    done = store.ids.read().agg(F.max("number")).first()[0]
    if last and (done is None or int(done) < last):
        # planned, but not finished
        _apply_planned(store, landing, [(r["name"], r["drop"]) for r in planned if r["number"] == last], last)
    if not new:
        return last, False
    last += 1
    rows = spark.createDataFrame([(last, *n) for n in new], plans.schema)
    plans.append(rows, f"{last:012d}")
    _apply_planned(store, landing, new, last)
    return last, True


def _apply_planned(store: Store, landing: str, drops: list[tuple[str, str]], number: int) -> None:
    names = dict.fromkeys(name for name, _ in drops)
    batch = {n: load.landed(store.spark, landing, n, [d for name, d in drops if name == n]) for n in names}
    apply_batch(store, batch, number)
