"""Fixed values of the terminology formats this package reads.

Every value here must equal the published one for results to be right.
"""

# --- fixed values: description types, acceptability, realm language refsets ---
FULLY_SPECIFIED_NAME = "900000000000003001"
SYNONYM = "900000000000013009"
DEFINITION = "900000000000550004"
PREFERRED = "900000000000548007"
ACCEPTABLE = "900000000000549004"
REALM_LANGUAGE_REFSETS = ("999001261000000100", "999000691000001104")

# --- fixed values: case significance ids and their stored numbers ---
CASE_FIRST_INSENSITIVE = "900000000000020002"
CASE_SENSITIVE = "900000000000017005"
CASE_INSENSITIVE = "900000000000448009"
CASE_NUMBERS = {CASE_FIRST_INSENSITIVE: 0, CASE_INSENSITIVE: 1, CASE_SENSITIVE: 2}
CASE_DEFAULT = 1

# --- fixed values: description classes, best first ---
DESCRIPTION_CLASSES = ("F", "P", "S", "D")

# --- fixed values: ontology ---
ROOT_CONCEPT = "138875005"
IS_A = "116680003"
CODING_SYSTEM = 9
TAG_DISEASE, TAG_DOMAIN, TAG_ANATOMY = 0, 1, 2

# --- fixed values: map refset -> coding system ---
MAP_ORIGINS = {
    "1126441000000105": "OPCS4",
    "1382401000000109": "OPCS4",
    "999002721000000108": "ReadCodeV2",
    "999002731000000105": "ReadCodeV3",
    "900000000000497000": "ReadCodeV3",
    "446608001": "ICD-10",
    "447562003": "ICD-10",
    "999002271000000101": "ICD-10",
    "999001921000000102": "ICD-10",
    "999001331000000104": "ICD-10",
}
READ_V2, READ_V3 = "ReadCodeV2", "ReadCodeV3"

# --- fixed values: code-list column -> coding system, in text-vector order ---
CODE_LIST_COLUMNS = {
    "mesh_codes": "MeSH",
    "opcs4_codes": "OPCS4",
    "icd9_codes": "ICD-9",
    "icd10_codes": "ICD-10",
    "readcv2_codes": "ReadCodeV2",
    "readcv3_codes": "ReadCodeV3",
}

# --- fixed values: release categories (bit flags), names and item numbers ---
CATEGORY_FLAGS = {"SNOMED_NONE": 1, "SNOMED_RELEASE": 2, "SNOMED_READ_MAP": 4, "SNOMED_ALL": 6}
CATEGORY_ITEMS = {2: 1799, 4: 9}
MANIFEST_VERSION = "1"

# --- fixed values: the classic English stop list ---
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more "
    "most other some such no nor not only own same so than too very s t can will just don "
    "should now"
).split()
