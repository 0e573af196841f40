"""Typed streaming load, partitioned tables and incremental derivation against one whole build."""

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from termspark import constants as C
from termspark import schemas as S
from termspark.functions import text as X
from termspark.operators import upsert
from termspark.plans import increment
from termspark.plans.classify import classify_descriptions
from termspark.plans.codelist import build_codelist
from termspark.plans.ontology import build_edges, build_tag_vectors, build_tags
from termspark.sources import rf2
from termspark.sources.partitioned import Partitioned, PartitionedLog
from termspark.streaming import load

DAY = datetime.date(2024, 1, 1)
LATER = datetime.date(2025, 1, 1)


def rows_of(spark, name, rows):
    """Raw rows from dicts; what is not named is NULL."""
    schema = S.RAW_TABLES[name].struct
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


def drop(first, last, day=DAY, active=True, suffix=""):
    """Raw rows of concepts first..last: names, two synonyms, maps, and is-a links to a third of the number."""
    raw = {name: [] for name in S.RAW_TABLES}
    base = {"effective_time": day, "active": active}
    for n in range(first, last):
        code = str(1000 + n)
        raw["concept"].append({**base, "id": code})
        for k, (kind, acceptability) in enumerate(
            [(C.FULLY_SPECIFIED_NAME, C.PREFERRED), (C.SYNONYM, C.PREFERRED), (C.SYNONYM, C.ACCEPTABLE)]
        ):
            text = f"name {n} of the heart{suffix} part {k}"
            case = "900000000000448009"
            raw["description"].append(
                {**base, "id": f"{n}{k}", "concept_id": code, "type_id": kind, "term": text, "case_significance_id": case}
            )
            raw["refset_lang"].append(
                {**base, "id": f"l{n}-{k}", "refset_id": C.REALM_LANGUAGE_REFSETS[0], "referenced_component_id": f"{n}{k}",
                 "acceptability_id": acceptability}
            )
        raw["refset_map"].append(
            {**base, "id": f"m{n}", "referenced_component_id": code, "map_origin": "ICD-10", "map_target": f"I{n}.1{suffix}",
             "map_priority": 1}
        )
        raw["ctv_map"].append(
            {**base, "id": f"c{n}", "concept_id": code, "map_origin": "ReadCodeV3", "map_target": f"X{n}", "is_assured": n % 2 == 0}
        )
        raw["relationship"].append(
            {**base, "id": f"r{n}", "source_id": code, "destination_id": str(1000 + n // 3), "type_id": C.IS_A}
        )
    return raw


def frames(spark, raw):
    return {name: rows_of(spark, name, rows) for name, rows in raw.items() if rows}


def joined(*raws):
    return {name: [r for raw in raws for r in raw[name]] for name in S.RAW_TABLES}


def whole_build(spark, raw):
    """Derived rows of the full build over the current raw rows, without ids."""
    now = {name: increment.current_rows(rows_of(spark, name, rows)) for name, rows in raw.items()}
    described = classify_descriptions(now["description"], now["refset_lang"])
    built = build_codelist(now["concept"], described, now["refset_map"], now["ctv_map"], config=X.SIMPLE)
    tags = build_tags(built.concepts)
    edges = build_edges(now["relationship"], tags)
    names = [tags.select(F.col("id").alias(f"{s}_id"), F.col("code").alias(s)) for s in ("child", "parent")]
    return {
        "concepts": built.concepts.drop("id"),
        "lists": built.lists,
        "vectors": built.vectors,
        "tags": tags.select("code", "name", "type_id"),
        "tag_vectors": build_tag_vectors(built, X.SIMPLE),
        "edges": edges.join(names[0], "child_id").join(names[1], "parent_id").select("child", "parent"),
    }


def check_store(spark, store, raw):
    for name, wanted in whole_build(spark, raw).items():
        got = store.table(name).select(*wanted.columns).collect()
        assert sorted(map(str, got)) == sorted(map(str, wanted.collect())), name
    for name in increment.NUMBERED:
        ids = [r["id"] for r in store.table(name).select("id").collect()]
        assert len(set(ids)) == len(ids) and None not in ids
    tags = {r["code"]: r["id"] for r in store.table("tags").collect()}
    for r in store.table("edges").collect():
        assert (r["child_id"], r["parent_id"]) == (tags[r["child"]], tags[r["parent"]])


def ids_of(store):
    return {name: {r["code"]: r["id"] for r in store.table(name).collect()} for name in ("concepts", "tags")}


def files_of(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_batches_equal_whole_build(spark, tmp_path):
    """New, changed and retired concepts; a batch applied twice; ids stay; other partitions keep their files."""
    store = increment.Store(spark, f"{tmp_path}/store", parts=8, config=X.SIMPLE)
    first = drop(1, 16)
    increment.apply_batch(store, frames(spark, first), 1)
    check_store(spark, store, first)
    before = ids_of(store)

    second = joined(drop(40, 42), drop(7, 8, LATER, suffix="s"), drop(12, 13, LATER, active=False))
    files = files_of(f"{store.path}/concepts")
    replaced = increment.apply_batch(store, frames(spark, second), 2)
    check_store(spark, store, joined(first, second))
    after = ids_of(store)
    for name, ids in before.items():
        assert {c: i for c, i in after[name].items() if c in ids} == {c: i for c, i in ids.items() if c != "1012"}
        assert min(after[name][str(1000 + n)] for n in range(40, 42)) > max(ids.values())
    untouched = {f for f in files if int(f.split("=")[1].split("/")[0]) not in replaced["concepts"]}
    assert untouched and untouched <= files_of(f"{store.path}/concepts")

    increment.apply_batch(store, frames(spark, second), 2)
    check_store(spark, store, joined(first, second))
    assert ids_of(store) == after

    # a language row alone reaches its concept; one concept comes back
    third = {name: [] for name in S.RAW_TABLES}
    third["refset_lang"] = [
        {"id": "l5-2", "effective_time": LATER, "active": False, "refset_id": C.REALM_LANGUAGE_REFSETS[0],
         "referenced_component_id": "52", "acceptability_id": C.ACCEPTABLE}
    ]
    third["concept"] = [{"id": "1012", "effective_time": datetime.date(2026, 1, 1), "active": True}]
    increment.apply_batch(store, frames(spark, third), 3)
    check_store(spark, store, joined(first, second, third))


def test_reads_touched_partitions_only(spark, tmp_path):
    store = increment.Store(spark, f"{tmp_path}/store", parts=8, config=X.SIMPLE)
    increment.apply_batch(store, frames(spark, drop(1, 16)), 1)
    keys = spark.createDataFrame([("1005",)], "code string")
    found = increment._of_keys(store.derived["concepts"], keys, "code")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan.split("PartitionFilters")[1].split("]")[0] and found.count() == 1
    wanted = store.derived["concepts"].numbers(keys, "code")
    assert len(wanted) == 1


def test_nothing_to_apply(spark, tmp_path):
    store = increment.Store(spark, f"{tmp_path}/store", parts=4, config=X.SIMPLE)
    assert increment.apply_batch(store, {}, 1) == {}
    assert store.table("concepts").count() == 0
    increment.apply_batch(store, {"concept": rows_of(spark, "concept", [])}, 2)
    assert store.table("concepts").count() == 0


def test_partitioned_table(spark, tmp_path):
    """Rows leave with their key, partitions that become empty go, NULL keys are kept."""
    schema = spark.createDataFrame([], "k string, v int").schema
    table = Partitioned(spark, f"{tmp_path}/t", schema, "k", 8)
    rows = spark.createDataFrame([(str(n), n) for n in range(40)] + [(None, -1)], "k string, v int")
    table.replace_parts(rows, table.numbers(rows, "k"))
    assert table.read().count() == 41
    gone = spark.createDataFrame([(str(n),) for n in range(40) if n % 2], "k string")
    table.replace_keys(gone, rows.limit(0))
    assert sorted(r["v"] for r in table.read().collect()) == [-1, *range(0, 40, 2)]
    every = rows.select("k").distinct()
    table.replace_keys(every.filter("k is not null"), rows.filter("v = 3"))
    assert sorted(r["v"] for r in table.read().collect()) == [-1, 3]
    log = PartitionedLog(spark, f"{tmp_path}/log", schema, "k", 4)
    for batch, part in (("a", "v < 10"), ("b", "v >= 10"), ("b", "v >= 10")):
        log.append(rows.filter(part), batch)
    assert sorted(r["v"] for r in log.read().collect()) == [-1, *range(40)]


@pytest.mark.parametrize("parts", [1, 8])
def test_pruned_upsert(spark, tmp_path, parts):
    """The merge equals the upsert of whole tables, and leaves other partitions' files alone."""
    columns = "code string, id bigint, value int, active boolean, effective_time date"
    old = [(str(n), n, n, True, DAY) for n in range(50)]
    new = [("3", 99, 100, True, LATER), ("4", 99, 100, False, LATER), ("5", 99, 100, True, DAY), ("90", 7, 1, False, DAY)]
    current, incoming = spark.createDataFrame(old, columns), spark.createDataFrame(new, columns)
    table = Partitioned(spark, f"{tmp_path}/t", current.schema, "code", parts)
    table.replace_parts(current, table.numbers(current, "code"))
    before = files_of(table.path)
    touched = upsert.upsert_partitions(table, incoming)
    wanted = sorted(map(tuple, upsert.upsert(current, incoming).collect()))
    assert sorted(map(tuple, table.read().collect())) == wanted
    assert {f for f in before if int(f.split("=")[1].split("/")[0]) not in touched} <= files_of(table.path)
    upsert.upsert_partitions(table, incoming)
    assert sorted(map(tuple, table.read().collect())) == wanted


HEADS = [
    "id\teffectiveTime\tactive\tmoduleId\tdefinitionStatusId",
    "active\tid\tmoduleId\teffectiveTime\tdefinitionStatusId",
]


def write_drop(base, release, number, head, rows):
    folder = f"{base}/{release}/{S.CONCEPT.folder}".replace("*", "x")
    os.makedirs(folder, exist_ok=True)
    name = S.CONCEPT.files[0].rsplit("/", 1)[-1].replace("*", f"n{number}")
    with open(f"{folder}/{name}", "w", newline="") as out:
        out.write("\r\n".join([head, *rows]) + "\r\n")


def test_typed_stream(spark, tmp_path):
    """Two drops with different headers, each file once; the landed rows are those of the batch scan."""
    base, landing, checkpoint = f"{tmp_path}/drops", f"{tmp_path}/landing", f"{tmp_path}/checkpoint"
    assert load.landed(spark, landing, "concept").count() == 0 and load.drops_of(spark, landing, "concept") == []
    write_drop(base, "r1", 1, HEADS[0], ["11\t20240101\t1\tm\td", '"12\t20240102\t0\tm\td', "\t20240102\t0\tm\td"])
    load.land_table(spark, base, landing, checkpoint, "concept")
    assert load.landed(spark, landing, "concept").count() == 2
    load.land_table(spark, base, landing, checkpoint, "concept")
    write_drop(base, "r2", 2, HEADS[1], ["1\t13\tm\t20250101\td"])
    load.land_table(spark, base, landing, checkpoint, "concept", files_a_batch=1)
    wanted = [r for release in ("r1", "r2") for r in rf2.read_table(spark, base, release, S.CONCEPT).collect()]
    assert sorted(map(str, load.landed(spark, landing, "concept").collect())) == sorted(map(str, wanted))
    drops = load.drops_of(spark, landing, "concept")
    assert len(drops) == 2
    assert load.landed(spark, landing, "concept", drops[1:]).count() in (1, 2)


def test_repeated_micro_batch(spark, tmp_path):
    """A micro-batch that runs again under its number replaces itself."""
    base, landing = f"{tmp_path}/drops", f"{tmp_path}/landing"
    write_drop(base, "r1", 1, HEADS[0], ["11\t20240101\t1\tm\td"])
    folder = glob.glob(f"{base}/r1/**/*.txt", recursive=True)
    lines = rf2.read_lines(spark, folder, places=True).drop("_at")
    for _ in range(2):
        load.land_batch(lines, landing, "concept", "0-0")
    assert load.landed(spark, landing, "concept").count() == 1
    # without its checkpoint a stream starts over under the same numbers
    for attempt in ("one", "two"):
        load.land_table(spark, base, f"{tmp_path}/other", f"{tmp_path}/{attempt}", "concept")
    assert load.landed(spark, f"{tmp_path}/other", "concept").count() == 1


def test_drops_to_store(spark, tmp_path):
    """From files to derived tables, drop by drop."""
    base, landing, checkpoint = (f"{tmp_path}/{n}" for n in ("drops", "landing", "checkpoint"))
    store = increment.Store(spark, f"{tmp_path}/store", parts=4, config=X.SIMPLE)
    raw = drop(1, 6)
    for number, (release, part) in enumerate([("r1", drop(1, 4)), ("r2", drop(4, 6))], 1):
        for name, rows in part.items():
            declared = S.RAW_TABLES[name]
            texts = {"date": lambda c: F.date_format(c, "yyyyMMdd"), "flag": lambda c: F.when(c, "1").otherwise("0")}
            df = rows_of(spark, name, rows)
            if name == "refset_map":
                df = df.withColumn("refset_id", F.lit("446608001"))
            if name == "ctv_map":
                df = df.withColumn("map_origin", F.lit("P"))
            columns = [
                texts.get(c.kind, lambda x: x.cast("string"))(F.col(c.name)).alias(c.headers[0])
                for c in declared.columns
                if not (name == "refset_map" and c.name == "map_origin")
            ]
            folder = f"{base}/{release}/{declared.folder}".replace("*", "x")
            os.makedirs(folder, exist_ok=True)
            table = df.select(*columns).toPandas()
            file = declared.files[0].rsplit("/", 1)[-1].replace("*", f"n{number}")
            table.to_csv(f"{folder}/{file}", sep="\t", index=False)
        assert increment.apply_drops(store, base, landing, checkpoint, C.CATEGORY_FLAGS["SNOMED_ALL"]) == (number, True)
    assert increment.apply_drops(store, base, landing, checkpoint, C.CATEGORY_FLAGS["SNOMED_ALL"]) == (2, False)
    got = {r["code"]: r["description"] for r in store.table("concepts").collect()}
    assert got == {str(1000 + n): f"name {n} of the heart part 0" for n in range(1, 6)}
    wanted = whole_build(spark, raw)["edges"].collect()
    assert sorted(map(tuple, store.table("edges").select("child", "parent").collect())) == sorted(map(tuple, wanted))


def test_current_rows(spark):
    """Rows without an id all stay; of versions the latest stays."""
    rows = [{"id": "1", "effective_time": DAY, "active": True}, {"id": "1", "effective_time": LATER, "active": False}]
    rows += [{"id": None, "effective_time": DAY, "active": True}] * 2
    found = increment.current_rows(rows_of(spark, "concept", rows)).collect()
    assert sorted(str((r["id"], r["active"])) for r in found) == ["('1', False)", "(None, True)", "(None, True)"]
