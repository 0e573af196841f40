"""The six raw tables: columns, source header names, defaults, bounds and references.

One declaration drives scanning (which header feeds which column), decoding, bounds checks and
orphan checks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SPARK_TYPES = {
    "text": T.StringType(),
    "uuid": T.StringType(),
    "date": T.DateType(),
    "flag": T.BooleanType(),
    "int": T.IntegerType(),
}


@dataclass(frozen=True)
class Column:
    """One column. ``headers`` are the names it may carry in a source file."""

    name: str
    kind: str
    headers: tuple[str, ...]
    size: int | None = None
    default: str | None = None
    refers_to: tuple[str, str] | None = None


@dataclass(frozen=True)
class Table:
    """One raw table and where its files lie in a release folder."""

    name: str
    columns: tuple[Column, ...]
    folder: str
    files: tuple[str, ...]
    category: int
    trim: bool
    checks_id: bool = field(default=False)

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, SPARK_TYPES[c.kind]) for c in self.columns])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def _sctid(name: str, *headers: str, refers_to: tuple[str, str] | None = ("concept", "id")) -> Column:
    return Column(name, "text", headers, size=18, refers_to=refers_to)


def _head(keyed_by: str) -> tuple[Column, ...]:
    """The columns every release table starts with."""
    key = Column("id", "uuid", ("id",)) if keyed_by == "uuid" else _sctid("id", "id", refers_to=None)
    return (
        key,
        Column("effective_time", "date", ("effectiveTime",)),
        Column("active", "flag", ("active",)),
        _sctid("module_id", "moduleId"),
    )


# --- fixed values: table layouts, header names, sizes, defaults and file patterns ---
CONCEPT = Table(
    "concept",
    (*_head("sctid"), _sctid("definition_status_id", "definitionStatusId")),
    folder="Snapshot/Terminology",
    files=("sct2_Concept_*.txt",),
    category=2,
    trim=True,
    checks_id=True,
)
DESCRIPTION = Table(
    "description",
    (
        *_head("sctid"),
        _sctid("concept_id", "conceptId"),
        Column("language_code", "text", ("languageCode",), size=2),
        _sctid("type_id", "typeId"),
        Column("term", "text", ("term",), size=256),
        _sctid("case_significance_id", "caseSignificanceId"),
    ),
    folder="Snapshot/Terminology",
    files=("sct2_Description_*.txt",),
    category=2,
    trim=True,
    checks_id=True,
)
RELATIONSHIP = Table(
    "relationship",
    (
        *_head("sctid"),
        _sctid("source_id", "sourceId"),
        _sctid("destination_id", "destinationId"),
        Column("relationship_group_id", "text", ("relationshipGroup",), size=18),
        _sctid("type_id", "typeId"),
        _sctid("characteristic_type_id", "characteristicTypeId"),
        _sctid("modifier_id", "modifierId"),
    ),
    folder="Snapshot/Terminology",
    files=("sct2_Relationship_*.txt", "sct2_StatedRelationship_*.txt"),
    category=2,
    trim=True,
    checks_id=True,
)
REFSET_LANG = Table(
    "refset_lang",
    (
        *_head("uuid"),
        _sctid("refset_id", "refsetId"),
        _sctid("referenced_component_id", "referencedComponentId", refers_to=("description", "id")),
        _sctid("acceptability_id", "acceptabilityId"),
    ),
    folder="Snapshot/Refset/Language",
    files=("der2_cRefset_*.txt",),
    category=2,
    trim=True,
)
REFSET_MAP = Table(
    "refset_map",
    (
        *_head("uuid"),
        _sctid("refset_id", "refsetId"),
        _sctid("referenced_component_id", "referencedComponentId"),
        Column("map_group", "int", ("mapGroup",), default="1"),
        Column("map_priority", "int", ("mapPriority",), default="1"),
        Column("map_target", "text", ("mapTarget",), size=7),
        Column("map_origin", "text", ("mapOrigin",), size=12),
    ),
    folder="Snapshot/Refset/Map",
    files=("der2_iisssciRefset_*.txt", "der2_sRefset_*.txt"),
    category=2,
    trim=False,
)
CTV_MAP = Table(
    "ctv_map",
    (
        Column("id", "uuid", ("id", "MapId", "MAPID")),
        Column(
            "effective_time",
            "date",
            ("effectiveTime", "effectiveDate", "EffectiveDate", "EFFECTIVEdate"),
        ),
        Column("active", "flag", ("active", "MapStatus", "MAPSTATUS")),
        _sctid("concept_id", "conceptId", "ConceptId", "SCT_CONCEPTID"),
        _sctid(
            "description_id",
            "descriptionId",
            "DescriptionId",
            "SCT_DESCRIPTIONID",
            refers_to=("description", "id"),
        ),
        Column("is_assured", "flag", ("IS_ASSURED",)),
        Column("map_target", "text", ("readCode", "ReadCode", "CTV3_TERMID"), size=7),
        Column("map_origin", "text", ("mapOrigin", "CTV3_TERMTYPE"), size=12),
    ),
    folder="Mapping Tables/Updated/*Assured",
    files=("ctv3sctmap2_uk_*.txt", "rcsctmap2_uk_*.txt", "rcsctmap_enhanced_uk_*.txt"),
    category=4,
    trim=False,
)
RAW_TABLES = {t.name: t for t in (CONCEPT, DESCRIPTION, RELATIONSHIP, REFSET_LANG, REFSET_MAP, CTV_MAP)}

# --- stored table names, and the groups the drop operator knows ---
RAW_PREFIX = "terminology_"
CODELIST_TABLE = "terminology_codes"
TAG_TABLE = "ontology_tag"
EDGE_TABLE = "ontology_tag_edge"
LEXEME_INDEX = CODELIST_TABLE + "_lexemes"
CODE_INDEX = CODELIST_TABLE + "_targets"
TRIGRAM_INDEX = CODELIST_TABLE + "_trigrams"
TAG_VECTORS = TAG_TABLE + "_lexemes"
TABLE_GROUPS = {
    "releases": tuple(RAW_PREFIX + name for name in RAW_TABLES),
    "codelist": (CODELIST_TABLE, LEXEME_INDEX, CODE_INDEX, TRIGRAM_INDEX),
    "ontology": (TAG_TABLE, TAG_VECTORS, EDGE_TABLE),
}

# --- fixed values: the fields of a release manifest ---
RELEASE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("releaseDate", T.StringType()),
        T.StructField("archiveFileUrl", T.StringType()),
        T.StructField("archiveFileName", T.StringType()),
        T.StructField("archiveFileSizeBytes", T.LongType()),
        T.StructField("archiveFileSha256", T.StringType()),
        T.StructField("archiveFileLastModifiedTimestamp", T.TimestampType()),
        T.StructField("checksumFileUrl", T.StringType()),
        T.StructField("checksumFileName", T.StringType()),
        T.StructField("checksumFileSizeBytes", T.LongType()),
        T.StructField("checksumFileLastModifiedTimestamp", T.TimestampType()),
        T.StructField("signatureFileUrl", T.StringType()),
        T.StructField("signatureFileName", T.StringType()),
        T.StructField("signatureFileSizeBytes", T.LongType()),
        T.StructField("signatureFileLastModifiedTimestamp", T.TimestampType()),
        T.StructField("publicKeyFileUrl", T.StringType()),
        T.StructField("publicKeyFileName", T.StringType()),
        T.StructField("publicKeyFileSizeBytes", T.LongType()),
        T.StructField("publicKeyId", T.IntegerType()),
    ]
)
MANIFEST = T.StructType(
    [
        T.StructField("apiVersion", T.StringType()),
        T.StructField("httpStatus", T.IntegerType()),
        T.StructField("message", T.StringType()),
        T.StructField("releases", T.ArrayType(RELEASE)),
    ]
)
# --- end of fixed values ---
