"""A tiny release, written file by file, that holds every odd case once."""

from pathlib import Path

from termspark import constants as C

NAME = "tiny release 1"
REALM_1, REALM_2 = C.REALM_LANGUAGE_REFSETS
BIG = "999002271000000101"
HEADERS = {
    "concept": "id effectiveTime active moduleId definitionStatusId",
    "description": "id effectiveTime active moduleId conceptId languageCode typeId term caseSignificanceId",
    "relationship": (
        "id effectiveTime active moduleId sourceId destinationId relationshipGroup typeId characteristicTypeId modifierId"
    ),
    "refset_lang": "id effectiveTime active moduleId refsetId referencedComponentId acceptabilityId",
    "map_long": (
        "id effectiveTime active moduleId refsetId referencedComponentId mapGroup mapPriority mapRule mapAdvice "
        "mapTarget correlationId mapBlock"
    ),
    "map_short": "id effectiveTime active moduleId refsetId referencedComponentId mapTarget",
    "ctv_2": "MapId ReadCode TermCode ConceptId DescriptionId IS_ASSURED EffectiveDate MapStatus",
    "ctv_2_enhanced": "MapId ReadCode TermCode ConceptId T30ID T60ID T198ID EffectiveDate MapStatus",
    "ctv_3": (
        "MAPID CTV3_CONCEPTID CTV3_TERMID CTV3_TERMTYPE SCT_CONCEPTID SCT_DESCRIPTIONID MAPSTATUS EFFECTIVEdate IS_ASSURED"
    ),
}


def uid(n: int) -> str:
    return f"00000000-0000-4000-8000-{n:012d}"


def concept(key, active="1"):
    return [key, "20200101", active, "900", "900000000000074008"]


def description(key, owner, kind, term, active="1", case=C.CASE_INSENSITIVE, day="20200101"):
    return [key, day, active, "900", owner, "en", kind, term, case]


def link(key, source, destination, active="1", kind=C.IS_A):
    return [key, "20200101", active, "900", source, destination, "0", kind, "900000000000011006", "900000000000451002"]


def acceptance(n, refset, key, acceptability, active="1"):
    return [uid(n), "20200101", active, "900", refset, key, acceptability]


def long_map(key, refset, owner, target, priority="1", active="1"):
    return [key, "20200101", active, "900", refset, owner, "1", priority, "TRUE", "ALWAYS", target, "447561005", "1"]


F, S, D = C.FULLY_SPECIFIED_NAME, C.SYNONYM, C.DEFINITION
P, A = C.PREFERRED, C.ACCEPTABLE

CONCEPTS = [concept(k) for k in (C.ROOT_CONCEPT, "100", "200", "210", "300", "500", "600", "700", BIG)]
CONCEPTS += [concept("400", "0"), ["", "20200101", "1", "900", "900"]]

DESCRIPTIONS = [
    description("1", C.ROOT_CONCEPT, F, "Root concept"),
    description("11", "100", F, '"Clinical" finding (finding)', case=C.CASE_FIRST_INSENSITIVE),
    description("12", "100", S, "Clinical finding"),
    description("21", "200", F, "Disorder of \\ heart (disorder)", case=C.CASE_SENSITIVE),
    description("22", "200", S, 'Heart "disease"'),
    description("23", "200", S, "  Cardiac\rdisorders"),
    description("31", "300", F, "Myocarditis (disorder)", case="999"),
    description("32", "300", S, "Inflammation of the heart"),
    description("33", "300", D, "A definition"),
    description("34", "300", S, "Old synonym", active="0"),
    description("41", "210", F, "Finding of chest (finding)"),
    description("42", "210", S, "Chest finding"),
    description("43", "210", S, "Thorax"),
    description("51", "500", F, "Lonely (finding)"),
    description("61", "600", F, "Old name", day="20200101"),
    description("62", "600", F, "New name", day="20210101"),
    description("71", "700", F, "Only acceptable"),
    description("81", "400", F, "Inactive concept"),
    description("91", BIG, F, "Big"),
]

LANGUAGE = [
    *[acceptance(i, REALM_1, k, P) for i, k in enumerate(("1", "11", "12", "21", "22", "31", "33", "41", "51", "61", "62", "81", "91"))],
    acceptance(20, REALM_2, "22", A),
    acceptance(21, REALM_2, "23", A),
    acceptance(22, REALM_1, "32", A),
    acceptance(23, REALM_1, "34", A),
    acceptance(24, REALM_1, "42", P, active="0"),
    acceptance(25, "123", "43", P),
    acceptance(26, REALM_1, "71", A),
]

RELATIONSHIPS = [
    link("1", "200", "100"),
    link("2", "210", "100"),
    link("3", "300", "200"),
    link("4", "300", "210"),
    link("5", "100", C.ROOT_CONCEPT),
    link("6", "300", "100", active="0"),
    link("7", "300", "200", kind="363698007"),
    link("8", "500", "400"),
    ["9", "20200101", "1", "900", "300"],
    [*link("10", "210", "100"), "one", "more"],
]
STATED = [link("11", "200", "100"), link("12", "600", "500")]

OPCS, ICD = "1126441000000105", "446608001"
MAPS_LONG = [
    long_map(uid(1), OPCS, "200", "K40.1", "2"),
    long_map("{" + uid(2).upper() + "}", ICD, "200", "I51.9"),
    long_map("broken", ICD, "200", "I25"),
    long_map(uid(4), ICD, "200", ""),
    long_map(uid(5), ICD, "200", "#HLT"),
    long_map(uid(6), "42", "200", "X1"),
    long_map(uid(7), ICD, "200", "I99", active="0"),
    long_map(uid(8), ICD, "400", "I10"),
]
MAPS_SHORT = [[uid(9), "20200101", "1", "900", "900000000000497000", "200", "XaBVJ"]]
CTV_3 = [
    [uid(11), "Xa1", "XaBVJ", "P", "200", "22", "1", "20200101", "0"],
    [uid(12), "Xa1", "YaaB1", "S", "200", "22", "1", "20200101", "1"],
    [uid(13), "Xa1", "Zempt", "", "200", "22", "1", "20200101", "1"],
    [uid(14), "Xa1", "Zgone", "S", "200", "22", "0", "20200101", "1"],
]
CTV_2 = [
    [uid(15), "G5y..", "00", "200", "22", "1", "20200101", "1"],
    [uid(16), "#G5..", "00", "200", "22", "1", "20200101", "1"],
]
CTV_2_ENHANCED = [[uid(17), "G5z..", "00", "200", "1", "2", "3", "20200101", "1"]]


def write(path: Path, header: str, rows: list[list[str]], blank: bool = False) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = ["\t".join(r) for r in [HEADERS[header].split(" "), *rows]]
    if blank:
        lines.insert(2, "")
    path.write_bytes("".join(x + "\r\n" for x in lines).encode())


def write_release(base: Path) -> str:
    root = base / NAME
    terms, refsets = root / "Snapshot/Terminology", root / "Snapshot/Refset"
    mapping = root / "Mapping Tables/Updated"
    write(terms / "sct2_Concept_Snapshot_1.txt", "concept", CONCEPTS, blank=True)
    write(terms / "sct2_Description_Snapshot_1.txt", "description", DESCRIPTIONS)
    write(terms / "sct2_Relationship_Snapshot_1.txt", "relationship", RELATIONSHIPS)
    write(terms / "sct2_StatedRelationship_Snapshot_1.txt", "relationship", STATED)
    write(refsets / "Language/der2_cRefset_Language_1.txt", "refset_lang", LANGUAGE)
    write(refsets / "Map/der2_iisssciRefset_Map_1.txt", "map_long", MAPS_LONG)
    write(refsets / "Map/der2_sRefset_Map_1.txt", "map_short", MAPS_SHORT)
    write(mapping / "Clinically Assured/ctv3sctmap2_uk_1.txt", "ctv_3", CTV_3)
    write(mapping / "Clinically Assured/rcsctmap2_uk_1.txt", "ctv_2", CTV_2)
    write(mapping / "Not Clinically Assured/rcsctmap_enhanced_uk_1.txt", "ctv_2_enhanced", CTV_2_ENHANCED)
    return NAME
