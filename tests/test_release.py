"""The tiny release: scan, classes, codelist, ontology and the whole build."""

import datetime
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tiny_release as tiny
from termspark import constants as C
from termspark import schemas as S
from termspark.operators import checks, maps
from termspark.plans import build, indexes
from termspark.plans.classify import classify_descriptions
from termspark.plans.codelist import build_codelist
from termspark.session import stage
from termspark.sources import delimited, rf2, tables


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    folder = tmp_path_factory.mktemp("releases")
    tiny.write_release(folder)
    return str(folder)


@pytest.fixture(scope="module")
def raw(spark, base):
    return rf2.read_release(spark, base, tiny.NAME, C.CATEGORY_FLAGS["SNOMED_ALL"])


def mesh(spark):
    return spark.createDataFrame(
        [("200", ["D006331", "D1"]), ("200", ["D1", "D2"]), ("300", []), ("999", ["D9"])],
        "snomed_code string, codes array<string>",
    )


@pytest.fixture(scope="module")
def built(spark, base):
    tables.drop_groups(spark, "all")
    assert build.build_release(spark, base, [(tiny.NAME, 6)], mesh=mesh(spark))
    yield spark
    tables.drop_groups(spark, "all")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def vector(df):
    """Occurrence rows as lexeme -> places."""
    found = {}
    for r in sorted(df.collect(), key=lambda r: r["pos"]):
        found.setdefault(r["lexeme"], []).append(f"{r['pos']}{r['weight']}")
    return {k: " ".join(v) for k, v in found.items()}


def of(built, code, kind, table=S.LEXEME_INDEX):
    return vector(built.table(table).filter((F.col("code") == code) & (F.col("vector") == kind)))


def test_concepts_are_scanned_and_empty_ids_dropped(raw):
    found = rows(raw["concept"], "id", "active")
    assert len(found) == 10
    assert ("400", False) in found


def test_schemas_are_the_declared_ones(raw):
    for name, df in raw.items():
        assert df.columns == S.RAW_TABLES[name].names
        assert [f.dataType for f in df.schema] == [f.dataType for f in S.RAW_TABLES[name].struct]


def test_text_is_kept_as_written(raw):
    terms = dict(rows(raw["description"], "id", "term"))
    assert terms["11"] == '"Clinical" finding (finding)'
    assert terms["21"] == "Disorder of \\ heart (disorder)"
    assert terms["23"] == "Cardiac\rdisorders"


def test_short_and_long_rows(raw):
    found = {r["id"]: r for r in raw["relationship"].collect()}
    assert len(found) == 12
    assert (found["9"]["source_id"], found["9"]["destination_id"]) == ("300", "")
    assert found["10"]["modifier_id"] == "900000000000451002"


def test_map_layouts_filters_and_defaults(raw):
    found = rows(raw["refset_map"], "map_target", "map_origin", "map_priority", "map_group")
    assert found == [
        ("I10", "ICD-10", 1, 1),
        ("I25", "ICD-10", 1, 1),
        ("I51.9", "ICD-10", 1, 1),
        ("I99", "ICD-10", 1, 1),
        ("K40.1", "OPCS4", 2, 1),
        ("XaBVJ", "ReadCodeV3", 1, 1),
    ]
    ids = dict(rows(raw["refset_map"], "map_target", F.coalesce("id", F.lit("none"))))
    assert ids["I51.9"] == tiny.uid(2)
    assert ids["I25"] == "none"


def test_read_map_layouts(raw):
    found = rows(raw["ctv_map"], "map_target", "map_origin", "is_assured", "active")
    assert found == [
        ("G5y..", "ReadCodeV2", True, True),
        ("G5z..", "ReadCodeV2", False, True),
        ("XaBVJ", "ReadCodeV3", False, True),
        ("YaaB1", "ReadCodeV3", True, True),
        ("Zempt", "ReadCodeV2", True, True),
        ("Zgone", "ReadCodeV3", True, False),
    ]


def test_release_without_files_gives_empty_tables(spark, base):
    df = rf2.read_table(spark, base, "no such release", S.CONCEPT)
    assert df.columns == S.CONCEPT.names
    assert df.isEmpty()


def test_bad_date_raises_unless_lenient(spark, tmp_path):
    path = tmp_path / "bad.txt"
    tiny.write(path, "concept", [["1", "2020-01-01", "", "m", "d"]])
    with pytest.raises(PySparkException, match="bad date"):
        rf2.read_layout(spark, str(path), S.CONCEPT).collect()
    row = rf2.read_layout(spark, str(path), S.CONCEPT, strict=False).first()
    assert (row["effective_time"], row["active"]) == (None, False)


def test_empty_cell_in_both_modes(spark, tmp_path):
    path = tmp_path / "gap.txt"
    tiny.write(path, "concept", [["1", "20200101", "1", "", "d"]])
    plain = rf2.read_layout(spark, str(path), S.CONCEPT).first()
    assert (plain["module_id"], plain["definition_status_id"]) == ("", "d")
    shifted = rf2.read_layout(spark, str(path), S.CONCEPT, shift_empty=True).first()
    assert (shifted["module_id"], shifted["definition_status_id"]) == ("d", "")


def test_each_file_has_its_own_header(spark, tmp_path):
    tiny.write(tmp_path / "a.txt", "ctv_2", tiny.CTV_2)
    tiny.write(tmp_path / "b.txt", "ctv_3", tiny.CTV_3)
    alone = [rf2.read_layout(spark, str(tmp_path / f"{n}.txt"), S.CTV_MAP) for n in "ab"]
    together = rf2.read_layout(spark, str(tmp_path / "*.txt"), S.CTV_MAP)
    wanted = [tuple(r) for df in alone for r in df.collect()]
    assert sorted(map(repr, (tuple(r) for r in together.collect()))) == sorted(map(repr, wanted))


def test_a_cell_that_reads_like_a_header_is_data(spark, tmp_path):
    tiny.write(tmp_path / "c.txt", "concept", [["id", "20200101", "1", "m", "d"], ["2", "20200101", "1", "m", "d"]])
    assert rows(rf2.read_layout(spark, str(tmp_path / "c.txt"), S.CONCEPT), "id") == [("2",), ("id",)]


def test_scan_options(spark, tmp_path):
    path = tmp_path / "options.txt"
    path.write_bytes(b"# note\nid\teffectiveTime\tactive\tmoduleId\tdefinitionStatusId\n1\t20200101\t1\tm\"\td\r")
    read = lambda **options: rf2.read_layout(spark, str(path), S.CONCEPT, comment="#", **options)
    assert read(exact_width=True).first()["definition_status_id"] == "d"
    with pytest.raises(PySparkException, match="bare quote"):
        read(strict_quotes=True).collect()
    tiny.write(tmp_path / "short.txt", "concept", [["1", "20200101"]])
    with pytest.raises(PySparkException, match="wrong number of fields"):
        rf2.read_layout(spark, str(tmp_path / "short.txt"), S.CONCEPT, exact_width=True).collect()


def test_description_classes(built):
    found = dict(rows(built.table(S.RAW_PREFIX + "description"), "id", F.coalesce("identifier", F.lit("-"))))
    wanted = {"22": "P", "23": "S", "32": "S", "33": "D", "34": "S", "42": "-", "43": "-", "71": "-"}
    assert {k: found[k] for k in wanted} == wanted
    assert all(found[k] == "F" for k in ("1", "11", "21", "31", "41", "51", "61", "62", "81", "91"))


def test_codelist_rows(built):
    found = rows(built.table(S.CODELIST_TABLE), "id", "code", "description", "case_sig")
    assert found == [
        (1, "100", '"Clinical" finding (finding)', 0),
        (2, "200", "Disorder of \\ heart (disorder)", 2),
        (3, "210", "Finding of chest (finding)", 1),
        (4, "300", "Myocarditis (disorder)", 1),
        (5, "500", "Lonely (finding)", 1),
        (6, "600", "New name", 1),
        (7, C.ROOT_CONCEPT, "Root concept", 1),
        (8, tiny.BIG, "Big", 1),
    ]


def test_code_lists(built):
    found = {}
    for r in built.table(S.CODE_INDEX).filter("code = '200'").orderBy("ord").collect():
        found.setdefault(r["source"], []).append(r["target"])
    assert found == {
        "MeSH": ["D006331", "D1", "D2"],
        "OPCS4": ["K40.1"],
        "ICD-10": ["I25", "I51.9"],
        "ReadCodeV2": ["G5y..", "Zempt", "G5z.."],
        "ReadCodeV3": ["XaBVJ", "YaaB1"],
    }
    row = built.table(S.CODELIST_TABLE).filter("code = '200'").first()
    assert row["effective_time"] == datetime.date(2020, 1, 1)


def test_wide_lists(spark, raw):
    """An external list that is empty is an empty array, none is NULL."""
    described = stage(classify_descriptions(raw["description"], raw["refset_lang"]))
    built = build_codelist(raw["concept"], described, raw["refset_map"], raw["ctv_map"], mesh(spark))
    assert built.concepts.count() == built.concepts.select("code").distinct().count() == 8
    for page in (1000, 2):
        wide = maps.list_columns(built.lists, C.CODE_LIST_COLUMNS, page).orderBy("page").collect()
        of_code = lambda code, column: [r[column] for r in wide if r["code"] == code]
        assert of_code("300", "mesh_codes") == [[]] and of_code("300", "icd10_codes") == [None]
        assert sum((x or [] for x in of_code("200", "readcv2_codes")), []) == ["G5y..", "Zempt", "G5z.."]
        assert len(of_code("200", "mesh_codes")) == (1 if page == 1000 else 2)


def test_codelist_vectors(built):
    assert of(built, "200", "synonyms") == {"heart": "1D", "diseas": "2D", "cardiac": "3D", "disord": "4D"}
    lists = {
        "d006331": 0, "d1": 1, "d2": 2, "k40.1": 3, "k40": 3, "i25": 4, "i51.9": 5, "i51": 5, "9": 5,
        "g5y": 6, "zempt": 7, "g5z": 8, "xabvj": 9, "yaab1": 10,
    }
    assert of(built, "200", "search") == {
        "200": "1A", "disord": "2A 5A 9B", "heart": "4A 6B", "diseas": "7B", "cardiac": "8B",
        "1": "13B", **{k: f"{v + 10}B" for k, v in lists.items()},
    }
    assert of(built, "200", "relation") == {"200": "1A", "1": "5B", **{k: f"{v + 2}B" for k, v in lists.items()}}


def test_no_search_vector_exactly_without_synonyms(built):
    every = {r["code"] for r in built.table(S.CODELIST_TABLE).collect()}
    found = {k: {r["code"] for r in built.table(S.LEXEME_INDEX).filter(F.col("vector") == k).collect()} for k in ("search", "synonyms")}
    assert every - found["search"] == {"210", "500", "600", C.ROOT_CONCEPT, tiny.BIG}
    assert found["search"] == found["synonyms"]


def test_tags(built):
    found = built.table(S.TAG_TABLE).orderBy("id").collect()
    assert [(r["id"], r["code"]) for r in found] == [
        (i + 1, c) for i, c in enumerate(("100", "200", "210", "300", "500", "600", tiny.BIG))
    ]
    assert json.loads(found[1]["properties"]) == {"code": "200", "code_id": 2, "coding_system_id": 9}
    assert {r["type_id"] for r in found} == {0} and {r["reference_id"] for r in found} == {None}
    # without synonyms the tag vector holds description, code and relations
    assert of(built, "500", "search", S.TAG_VECTORS) == {"lone": "1A", "find": "2A", "500": "3A 4B"}
    # description 4 positions, code 1, relations 12; then heart, disease, cardiac, disorders
    heart = of(built, "200", "search", S.TAG_VECTORS)
    assert (heart["disord"], heart["200"], heart["diseas"]) == ("1A 4A 21B", "5A 6B", "19B")
    assert of(built, "200", "synonyms", S.TAG_VECTORS) == of(built, "200", "synonyms")
    assert C.ROOT_CONCEPT not in {r["code"] for r in built.table(S.TAG_VECTORS).collect()}


def test_edges(built):
    code = dict(rows(built.table(S.TAG_TABLE), "id", "code"))
    found = built.table(S.EDGE_TABLE).collect()
    assert sorted((code[r["child_id"]], code[r["parent_id"]]) for r in found) == [
        ("200", "100"), ("210", "100"), ("300", "200"), ("300", "210"), ("600", "500"),
    ]
    assert sorted(r["id"] for r in found) == [1, 2, 3, 4, 5]
    assert checks.broken_edges(built.table(S.EDGE_TABLE), built.table(S.TAG_TABLE), ["child_id", "parent_id"]).isEmpty()


def codes(df):
    return sorted(r["code"] for r in df.collect())


def test_text_search(built):
    assert codes(indexes.search_text(built, "diseases of the heart")) == ["200"]
    assert codes(indexes.search_text(built, "heart")) == ["200", "300"]
    assert codes(indexes.search_text(built, "heart", weights="A")) == ["200"]
    assert codes(indexes.search_text(built, "clinical inflammation", every=False)) == ["100", "300"]
    assert codes(indexes.search_text(built, "K40.1", vector="relation")) == ["200"]
    assert codes(indexes.search_text(built, "the of")) == []


def test_code_and_similarity_search(built):
    assert codes(indexes.search_targets(built, "ICD-10", ["I25", "none"])) == ["200"]
    assert codes(indexes.search_targets(built, "OPCS4", ["I25"])) == []
    # 9 of 30 and 18 of 24 trigrams shared
    found = indexes.search_similar(built, "myocardites disorder").collect()
    assert sorted((r["code"], r["sim"]) for r in found) == [("200", 0.3), ("300", 0.75)]
    assert codes(indexes.search_similar(built, "300", "code")) == ["300"]


def test_search_reads_only_its_keys(built):
    plan = indexes.search_text(built, "heart")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(lexeme,heart)" in plan


def test_second_build_loads_nothing(built, base):
    assert not build.build_release(built, base, [(tiny.NAME, 6)])


def test_refill_gives_the_same_rows(built):
    before = rows(built.table(S.CODELIST_TABLE), "id", "code")
    build.derive(built, mesh=mesh(built), managed=False)
    assert rows(built.table(S.CODELIST_TABLE), "id", "code") == before


def test_declared_checks_on_the_release(raw):
    lost = rows(checks.declared_orphans(raw, S.REFSET_LANG), "column", "value", "n")
    assert ("refset_id", tiny.REALM_2, 2) in lost
    assert not [r for r in lost if r[0] == "referenced_component_id"]
    assert checks.out_of_bounds(raw["description"], S.DESCRIPTION).isEmpty()
    long = raw["ctv_map"].withColumn("map_target", F.concat("map_target", F.lit("xyz")))
    assert ("map_target", "YaaB1xyz", 8) in rows(checks.out_of_bounds(long, S.CTV_MAP), "column", "value", "len")


def test_external_file(spark, tmp_path):
    path = tmp_path / "mesh.csv"
    path.write_text('snomed_code|codes\n200|{D1,D2}\n300|{}\n400|\n500|"{""a b"",c}"\n')
    found = rows(delimited.load_code_lists(spark, str(path), "|"), "snomed_code", F.coalesce("codes", F.array(F.lit("null"))))
    assert found == [("200", ["D1", "D2"]), ("300", []), ("400", ["null"]), ("500", ["a b", "c"])]


def test_headers_without_a_sort(spark, tmp_path):
    """The lines of the first blocks are not sorted to find the headers."""
    for n in range(3):
        (tmp_path / f"{n}.txt").write_text("\n" + "".join(f"{n}-{i}\n" for i in range(2000)))
    found = rf2.header_lines(rf2.read_lines(spark, str(tmp_path / "*.txt"), places=True))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort " not in plan
    assert sorted(r["_header"] for r in found.collect()) == ["0-0", "1-0", "2-0"]
