"""Operators on small tables, against brute force in Python."""

import datetime
import json
import random
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from termspark import constants as C
from termspark import schemas as S
from termspark import session
from termspark.functions import decode as D
from termspark.functions import running, scalar
from termspark.functions import text as X
from termspark.functions.english import stem
from termspark.operators import checks, lookup, maps, numbering, upsert, vectors
from termspark.plans import codelist, ontology
from termspark.sources import delimited, manifest, tables
from termspark.streaming import ingest


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def vector(rows):
    """Occurrence rows as a mapping."""
    found = defaultdict(list)
    for r in rows:
        found[r["lexeme"]].append((r["pos"], r["weight"]))
    return {k: sorted(v) for k, v in found.items()}


# ---------------------------------------------------------------- decoding and scalars


def test_uuid_spellings(spark):
    plain = "0f8fad5b-d9cb-469f-a165-70867728950e"
    given = [plain, plain.upper(), "{" + plain + "}", "urn:uuid:" + plain, plain.replace("-", ""), plain[1:], "", None, "{" + plain]
    got = [r[0] for r in texts(spark, given).select(D.decode_uuid(F.col("t"))).collect()]
    assert got == [plain] * 5 + [None] * 4


def test_flags_and_numbers(spark):
    given = ["1", "0", "", None, "true", "F", "yes"]
    got = [r[0] for r in texts(spark, given).select(D.decode_flag(F.col("t"))).collect()]
    assert got == [True, False, False, False, True, False, True]
    with pytest.raises(PySparkException, match="bad flag"):
        texts(spark, ["2"]).select(D.decode_flag(F.col("t"))).collect()
    assert [r[0] for r in texts(spark, ["7", "", None]).select(D.decode_int(F.col("t"), 1)).collect()] == [7, 1, 1]
    with pytest.raises(PySparkException, match="bad number"):
        texts(spark, ["x"]).select(D.decode_int(F.col("t"))).collect()


def test_dates_go_both_ways(spark):
    day = one(spark, D.decode_date(F.lit("20240229")))
    assert day == datetime.date(2024, 2, 29)
    assert one(spark, D.encode_date(F.lit(day))) == "20240229"
    given = ["20230229", "2024022", "202402290", ""]
    assert [r[0] for r in texts(spark, given).select(D.decode_date(F.col("t"), strict=False)).collect()] == [None] * 4


def test_scalars(spark):
    assert one(spark, scalar.safe_name(F.lit("MapTargetX2Id"))) == "map_target_x_id"
    assert [one(spark, scalar.clamp(F.lit(v), F.lit(9), F.lit(3))) for v in (1, 5, 12)] == [3, 5, 9]
    assert one(spark, scalar.smallest(F.lit(4), F.lit(2), F.lit(3))) == 2
    assert one(spark, scalar.largest(F.lit(4), F.lit(2))) == 4
    assert one(spark, scalar.case_number(F.lit("?"))) == 1
    document = scalar.json_object(code=F.lit('a"b'), n=F.lit(9))
    assert json.loads(one(spark, document)) == {"code": 'a"b', "n": 9}
    assert one(spark, scalar.json_text(document, "n")) == "9"
    assert one(spark, scalar.or_today(F.lit(None).cast("date"))) is not None
    assert one(spark, scalar.codes_text(F.lit(None).cast("array<string>"))) == ""


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("{a,b}", ["a", "b"]),
        ("{}", []),
        ("{ }", []),
        (None, None),
        ('{"Diabetes, Type 1",b}', ["Diabetes, Type 1", "b"]),
        ('{"say \\"so\\"", c\\\\d ,NULL,"NULL",null}', ['say "so"', "c\\d", None, "NULL", None]),
        ('{"{x}","",y}', ["{x}", "", "y"]),
        ('{"two\nlines"}', ["two\nlines"]),
    ],
)
def test_array_text(spark, text, wanted):
    assert texts(spark, [text]).select(scalar.array_text(F.col("t")).alias("x")).first()["x"] == wanted


def test_staging_folder(spark):
    assert session.staging_root(spark) == spark.conf.get("spark.checkpoint.dir")

    class Unset:
        conf = type("C", (), {"get": staticmethod(lambda name, other=None: other)})
        sparkContext = type("S", (), {"applicationId": "app-1"})

    with pytest.raises(ValueError):
        session.staging_root(Unset)
    assert not session.has_staging_folder(Unset)
    session.name_staging_folder(Unset, "/shared/")
    assert session.has_staging_folder(Unset) and session.staging_root(Unset) == "/shared"


def test_staged_tables_can_be_dropped(spark):
    path = session.staging_path(spark, "mine")
    spark.range(3).write.parquet(path)
    session.drop_staged(spark, path)
    with pytest.raises(PySparkException):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.drop_staged(spark, "/elsewhere/mine")


# ---------------------------------------------------------------- numbering


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in group 0, a tenth without group."""
    rng = random.Random(1)
    pick = lambda r: 0 if r < 0.35 else None if r < 0.45 else rng.randrange(1, 40)
    rows = [(pick(rng.random()), i, rng.randrange(5)) for i in range(3000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g int, k int, v int"), rows


def test_dense_ids(spark, skewed):
    df, rows = skewed
    got = {(r["g"], r["k"]): r["id"] for r in numbering.dense_ids(df, [F.col("g"), F.col("k")]).collect()}
    nulls_first = sorted(((g, k) for g, k, _ in rows), key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    assert got == {key: i + 1 for i, key in enumerate(nulls_first)}


def test_dense_ids_of_uneven_identifiers(spark):
    rng = random.Random(2)
    codes = sorted({rng.randrange(10**5, 10 ** rng.randrange(6, 19)) for _ in range(2000)})
    df = spark.createDataFrame([(str(c),) for c in rng.sample(codes, len(codes))], "code string")
    got = {r["code"]: r["id"] for r in numbering.dense_ids(df, [scalar.as_number(F.col("code"))]).collect()}
    assert got == {str(c): i + 1 for i, c in enumerate(codes)}


def test_dense_ids_of_nothing(spark):
    assert numbering.dense_ids(spark.createDataFrame([], "a int"), [F.col("a")]).count() == 0


@pytest.fixture(params=["1", "16"])
def pieces(spark, request):
    """Groups in one range piece, and cut into many."""
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_running_totals_of_large_groups(skewed, pieces):
    df, rows = skewed
    got = {(r["g"], r["k"]): r["t"] for r in numbering.running_totals(df, ["g"], ["k"], {"t": F.col("v")}).collect()}
    wanted, total = {}, defaultdict(int)
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        wanted[g, k] = total[g]
        total[g] += v
    assert got == wanted


def test_ordinals_of_large_groups(skewed, pieces):
    df, rows = skewed
    got = {(r["g"], r["k"]): r["n"] for r in numbering.ordinals(df, ["g"], ["k"], "n").collect()}
    wanted, total = {}, defaultdict(int)
    for g, k, _ in sorted(rows, key=lambda r: r[1]):
        total[g] += 1
        wanted[g, k] = total[g]
    assert got == wanted


# ---------------------------------------------------------------- maps


def map_rows(rng, n=2500):
    return [
        ("hot" if rng.random() < 0.4 else f"c{rng.randrange(60)}", rng.choice(["OPCS4", "ICD-10"]), f"t{rng.randrange(300)}", rng.randrange(1, 4))
        for _ in range(n)
    ]


@pytest.mark.parametrize("page", [100_000, 40])
def test_code_lists(spark, page, pieces):
    rng = random.Random(3)
    first, second = map_rows(rng), map_rows(rng)
    shape = "code string, source string, target string, priority int"
    feeds = [spark.createDataFrame(r, shape) for r in (first, second)]
    best = {}
    for code, source, target, priority in first + second:
        key = (code, source, target)
        best[key] = min(best.get(key, 99), priority)
    lists = defaultdict(list)
    for (code, source, target), priority in best.items():
        lists[code, source].append((priority, target))
    wanted = {k: [t for _, t in sorted(v)] for k, v in lists.items()}

    ordered = maps.ordered_targets(maps.best_priority(*feeds))
    wide = maps.list_columns(ordered, {"opcs": "OPCS4", "icd": "ICD-10", "none": "MeSH"}, page)
    got = defaultdict(list)
    for r in wide.orderBy("code", "page").collect():
        assert r["none"] is None
        for column, source in (("opcs", "OPCS4"), ("icd", "ICD-10")):
            assert r[column] is None or len(r[column]) <= page
            got[r["code"], source] += r[column] or []
    assert {k: v for k, v in got.items() if v} == wanted
    assert maps.union_feeds(*feeds).count() == len(set(first + second))


# ---------------------------------------------------------------- text


def test_stems_of_the_published_examples():
    pairs = {
        "consistency": "consist", "consolation": "consol", "conspicuous": "conspicu", "constancy": "constanc",
        "knackeries": "knackeri", "knavish": "knavish", "kneaded": "knead", "knives": "knive", "knocked": "knock",
        "hopping": "hop", "hoped": "hope", "generously": "generous", "generate": "generat", "communism": "communism",
        "arsenal": "arsenal", "cries": "cri", "ties": "tie", "kiwis": "kiwi", "gas": "gas", "this": "this",
        "say": "say", "by": "by", "happy": "happi", "dying": "die", "news": "news", "inning": "inning",
        "proceed": "proceed", "relational": "relat", "hopefulness": "hope", "adjustment": "adjust",
        "luxuriated": "luxuri", "fluently": "fluentli", "diseases": "diseas", "infarction": "infarct",
    }
    assert {w: stem(w) for w in pairs} == pairs


def test_tokens_positions_and_stop_words(spark):
    given = ["The pains of A01.1, and type-2!", None, "of the", ""]
    df = texts(spark, given).select(X.tokenize(F.col("t")).alias("k"))
    got = df.select("k", X.lexize(F.col("k")).alias("x")).select("*", X.last_position(F.col("x")).alias("m")).collect()
    assert got[0]["k"] == ["the", "pains", "of", "a01.1", "and", "type", "2"]
    assert got[0]["x"] == [None, "pain", None, "a01.1", None, "type", "2"]
    assert [r["m"] for r in got] == [7, 0, 0, 0]
    with pytest.raises(ValueError):
        X.lexize(F.col("k"), "klingon")


def brute_vector(parts):
    """Vector of (text, weight) parts, unstemmed, from the definition."""
    found, offset = defaultdict(list), 0
    for text, weight in parts:
        words = text.split()
        for i, word in enumerate(words):
            found[word].append((offset + i + 1, weight))
        offset += len(words)
    return dict(found)


def test_long_texts_are_kept_whole(spark):
    """20,000 tokens, a word 300 times, and a word of 3,000 bytes."""
    long = " ".join(["common"] * 300 + [f"w{i}" for i in range(19_700)] + ["x" * 3000, "last"])
    df = spark.createDataFrame([(1, "head", long, "tail last")], "k int, a string, b string, c string")
    rows = vectors.text_vectors(df, ["k"], [(F.col("a"), "A"), (F.col("b"), "B"), (F.col("c"), "C")], X.SIMPLE)
    got = vector(rows.collect())
    assert got == brute_vector([("head", "A"), (long, "B"), ("tail last", "C")])
    assert len(got["common"]) == 300 and got["x" * 3000] == [(20_002, "B")] and got["last"] == [(20_003, "B"), (20_005, "C")]
    assert codes_of(lookup.match_lexemes(rows, ["x" * 3000], "k"), "k") == [1]


def codes_of(df, column="code"):
    return sorted(r[column] for r in df.collect())


def test_text_aggregate_of_a_hot_group(spark, pieces):
    rng = random.Random(4)
    rows = [("hot" if i % 3 == 0 else f"g{i % 17}", i, " ".join(f"w{rng.randrange(20)}" for _ in range(rng.randrange(4)))) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, k int, t string").repartition(5)
    found = vectors.aggregate_texts(df, "g", "k", "t", "D", X.SIMPLE).collect()
    for group in {r[0] for r in rows}:
        wanted = brute_vector([(t, "D") for g, _, t in sorted(rows, key=lambda r: r[1]) if g == group])
        assert vector(r for r in found if r["g"] == group) == wanted


@pytest.mark.parametrize("null_safe", [False, True])
def test_codelist_vectors_of_a_hot_concept(spark, pieces, null_safe):
    """A concept with most synonyms, and long lists; some concepts have no synonyms."""
    rng = random.Random(5)
    concepts = [(f"{i}", f"name {i}") for i in range(1, 8)]
    words = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    synonyms = [("3" if i % 2 else f"{rng.randrange(1, 7)}", i, words(rng.randrange(1, 5))) for i in range(200)]
    listed = {c: {"OPCS4": [f"x{c}", "w1"], "ReadCodeV3": [f"y{c}"]} for c, _ in concepts[:5]}
    for code in ("5", "7"):
        listed.setdefault(code, {})["OPCS4"] = [f"m{i}" for i in range(40)]
    lists = [(c, s, t, n + 1) for c, own in listed.items() for s, targets in own.items() for n, t in enumerate(targets)]
    concept_df = spark.createDataFrame(concepts, "code string, description string")
    synonym_df = spark.createDataFrame(synonyms, "code string, sub bigint, text string")
    list_df = spark.createDataFrame([*lists, ("1", "MeSH", None, 1)], "code string, source string, target string, ord int")
    parts = codelist.vector_parts(concept_df, synonym_df, list_df)
    rows = codelist.concept_vectors(parts, X.SIMPLE, null_safe).collect()
    for code, name in concepts:
        own = sorted((k, t) for c, k, t in synonyms if c == code)
        own_lists = [" ".join(listed.get(code, {}).get(s, [])) for s in C.CODE_LIST_COLUMNS.values()]
        wanted = {
            "search": brute_vector([(code, "A"), (name, "A"), *[(t, "B") for _, t in own], *[(t, "B") for t in own_lists]]),
            "synonyms": brute_vector([(t, "D") for _, t in own]),
            "relation": brute_vector([(code, "A"), *[(t, "B") for t in own_lists]]),
        }
        if not own and not null_safe:
            wanted["search"] = {}
        for kind, value in wanted.items():
            assert vector(r for r in rows if (r["code"], r["vector"]) == (code, kind)) == value


def test_stop_words_inside_a_list_keep_their_place(spark):
    """A list is one text: a stop word in it holds a position, one at its end does not."""
    concepts = spark.createDataFrame([("7", "n")], "code string, description string")
    synonyms = spark.createDataFrame([("7", 1, "one of the"), ("7", 2, "two")], "code string, sub bigint, text string")
    rows = [("7", "OPCS4", t, n + 1) for n, t in enumerate(["x", "a", "y", "the"])] + [("7", "ICD-10", "z", 1)]
    lists = spark.createDataFrame(rows, "code string, source string, target string, ord int")
    found = codelist.concept_vectors(codelist.vector_parts(concepts, synonyms, lists)).collect()
    of = lambda kind: vector(r for r in found if r["vector"] == kind)
    assert of("relation") == {"7": [(1, "A")], "x": [(2, "B")], "y": [(4, "B")], "z": [(5, "B")]}
    assert of("synonyms") == {"one": [(1, "D")], "two": [(2, "D")]}
    assert {k: v[0][0] for k, v in of("search").items()} == {"7": 1, "n": 2, "one": 3, "two": 4, "x": 5, "y": 7, "z": 8}


def test_tag_vectors(spark):
    entries = [("relation", "7", 1, "A"), ("relation", "r1", 2, "B"), ("relation", "r2", 3, "B"), ("synonyms", "s1", 1, "D"),
               ("synonyms", "s1", 4, "D"), ("synonyms", "r1", 2, "D"), ("synonyms", "s2", 3, "D"), ("search", "no", 1, "A")]
    found = spark.createDataFrame([("7", *e) for e in entries] + [("9", *entries[0])], "code string, vector string, lexeme string, pos bigint, weight string")
    concepts = spark.createDataFrame([("7", "two words"), ("8", "of the")], "code string, description string")
    rows = ontology.tag_vectors(concepts, found, X.SIMPLE).collect()
    assert vector(r for r in rows if r["code"] == "7") == {
        "two": [(1, "A")], "words": [(2, "A")], "7": [(3, "A"), (4, "B")],
        "r1": [(5, "B"), (8, "B")], "r2": [(6, "B")], "s1": [(7, "B"), (10, "B")], "s2": [(9, "B")],
    }
    assert {r["code"] for r in rows} == {"7", "8"}


def test_vectors_are_joined_and_reweighted(spark):
    df = spark.createDataFrame([(1, "b a b", "c"), (2, "", "d d")], "k int, t string, u string")
    first, second = [vectors.text_vectors(df, ["k"], [(F.col(c), "A")], X.SIMPLE) for c in ("t", "u")]
    rows = vectors.concatenate(first, vectors.set_weight(second, "C"), ["k"]).collect()
    assert sorted(tuple(r) for r in rows) == [
        (1, "a", 2, "A"), (1, "b", 1, "A"), (1, "b", 3, "A"), (1, "c", 4, "C"), (2, "d", 1, "C"), (2, "d", 2, "C"),
    ]


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange ")


def test_text_vectors_do_not_shuffle(spark):
    df = spark.createDataFrame([(1, "a b")], "k int, t string")
    simple = vectors.text_vectors(df, ["k"], [(F.col("t"), "D")], X.SIMPLE)
    assert exchanges(simple) == 0
    assert exchanges(vectors.text_vectors(df, ["k"], [(F.col("t"), "D")], X.ENGLISH)) == 0
    # the lookup's own aggregate, and nothing before it
    assert exchanges(lookup.match_lexemes(simple, ["a", "b"], "k")) == 2


def test_code_lists_shuffle_twice(spark):
    df = spark.createDataFrame([("a", "s", "t", 1)], "code string, source string, target string, priority int")
    best = maps.best_priority(df)
    assert exchanges(best) == 1
    assert exchanges(maps.list_columns(maps.ordered_targets(best), {"s": "s"}, 10)) <= 4


# ---------------------------------------------------------------- lookups


@pytest.fixture(scope="module")
def named(spark):
    return spark.createDataFrame(
        [("1", "Disorder of heart"), ("2", "Heart rate"), ("3", "Hearts and disorders"), ("4", "Lung")], "code string, name string"
    )


def test_text_lookup_on_postings(spark, named, tmp_path):
    rows = vectors.text_vectors(named, ["code"], [(F.col("code"), "A"), (F.col("name"), "B")])
    lookup.clustered(rows, ["lexeme", "code"]).write.parquet(str(tmp_path / "p"))
    postings = spark.read.parquet(str(tmp_path / "p"))
    lexemes = lookup.query_lexemes(spark, "the disorders of a HEART")
    assert lexemes == ["disord", "heart"]
    codes = lambda df: sorted(r["code"] for r in df.collect())
    assert codes(lookup.match_lexemes(postings, lexemes)) == ["1", "3"]
    assert codes(lookup.match_lexemes(postings, lexemes, every=False)) == ["1", "2", "3"]
    assert codes(lookup.match_lexemes(postings, ["1"], weights="A")) == ["1"]
    assert codes(lookup.match_lexemes(postings, ["1"], weights="B")) == []
    assert codes(lookup.match_lexemes(postings, [*lexemes, *lexemes])) == ["1", "3"]
    assert codes(lookup.match_lexemes(postings, [])) == []
    tokens = X.lexize(X.tokenize(F.col("name")))
    assert codes(named.filter(lookup.has_lexemes(tokens, lexemes, every=False))) == ["1", "2", "3"]


def test_code_lookup_both_ways(spark):
    rows = [("1", "ICD-10", "a", 1, 1), ("1", "ICD-10", "b", 1, 2), ("2", "ICD-10", "b", 1, 1), ("3", "OPCS4", "b", 1, 1)]
    ordered = spark.createDataFrame(rows, "code string, source string, target string, priority int, ord bigint")
    assert sorted(r[0] for r in lookup.owners_of_codes(ordered, "ICD-10", ["b", "z"]).collect()) == ["1", "2"]
    wide = maps.list_columns(ordered, {"icd": "ICD-10"}, 10)
    assert [r["code"] for r in wide.filter(lookup.list_holds(F.col("icd"), "a")).collect()] == ["1"]
    assert sorted(r["code"] for r in wide.filter(lookup.list_overlaps(F.col("icd"), ["b"])).collect()) == ["1", "2"]


def test_trigram_searches_agree_with_brute_force(spark, named):
    def grams(text):
        return {f"  {w} "[i : i + 3] for w in text.lower().split() for i in range(len(w) + 1)}

    query = "haert disorder"
    wanted = {}
    for code, name in [tuple(r) for r in named.collect()]:
        a, b = grams(name), grams(query)
        sim = len(a & b) / len(a | b)
        if sim >= 0.3:
            wanted[code] = round(sim, 9)
    assert wanted
    direct = {r["code"]: round(r["sim"], 9) for r in lookup.similar_rows(named, "name", query).collect()}
    indexed = {r["code"]: round(r["sim"], 9) for r in lookup.similar_owners(lookup.trigram_postings(named, "code", "name"), query).collect()}
    assert direct == indexed == wanted
    assert one(spark, X.trigram_similarity(X.trigrams(F.lit("")), X.trigrams(F.lit("")))) == 0.0


# ---------------------------------------------------------------- upsert and checks


def test_upsert_rules(spark):
    shape = "id bigint, code string, description string, active boolean, effective_time date"
    day = lambda y: datetime.date(y, 1, 1)
    current = spark.createDataFrame([(i, c, "old", True, day(2020)) for i, c in enumerate("abcd")], shape)
    incoming = spark.createDataFrame(
        [(90, "a", "new", True, day(2021)), (91, "b", "new", False, day(2021)), (92, "c", "new", True, day(2020)), (93, "e", "new", True, day(2019))],
        shape,
    )
    once = upsert.upsert(current, incoming)
    got = {r["code"]: (r["id"], r["description"], r["effective_time"].year) for r in once.collect()}
    assert got == {"a": (0, "new", 2020), "b": (1, "old", 2020), "c": (2, "old", 2020), "d": (3, "old", 2020), "e": (93, "new", 2019)}
    twice = upsert.upsert(once, incoming)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    repeated = incoming.unionByName(incoming.withColumn("id", F.col("id") + 1))
    assert upsert.latest_per_key(repeated, "code", ["effective_time", "id"]).count() == 4


def test_checks(spark):
    df = spark.createDataFrame([("a", "F"), ("a", None), ("b", "X"), ("", "S"), (None, "D")], "k string, e string")
    assert [tuple(r) for r in checks.repeated_keys(df, ["k"]).collect()] == [("a", 2)]
    known = spark.createDataFrame([("a",)], "id string")
    assert [r["k"] for r in checks.orphans(df, "k", known, "id").collect()] == ["b"]
    assert [r["e"] for r in checks.not_in_enum(df, "e").collect()] == ["X"]
    assert checks.nulls(df, ["k", "e"]).count() == 2
    assert checks.unreferenced(known, "id", df, "k").isEmpty()


# ---------------------------------------------------------------- sources, sinks, streams


def test_export_format(spark, tmp_path):
    rows = [("plain", "a,b"), ('q"q', " lead"), ("\\.", ""), (None, "l\nf"), ("trail ", "c\rr")]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    read = lambda p: b"".join(f.read_bytes() for f in sorted(p.glob("part-*")))
    delimited.export_delimited(df, str(tmp_path / "lf"))
    assert read(tmp_path / "lf") == b'plain,"a,b"\n"q""q"," lead"\n"\\.",\n,"l\nf"\ntrail ,"c\rr"\n'
    delimited.export_delimited(df, str(tmp_path / "crlf"), separator="|", crlf=True)
    assert read(tmp_path / "crlf") == b'plain|a,b\r\n"q""q"|" lead"\r\n"\\."|\r\n|"l\r\nf"\r\ntrail |"cr"\r\n'


def test_line_ends_inside_quotes_come_back(spark, tmp_path):
    rows = [("x\ny", 'a "b", c'), ("plain", "z")]
    delimited.export_delimited(spark.createDataFrame(rows, "a string, b string"), str(tmp_path / "x"))
    schema = spark.createDataFrame(rows, "a string, b string").schema
    assert sorted(tuple(r) for r in delimited.load_delimited(spark, str(tmp_path / "x"), schema, header=False).collect()) == sorted(rows)
    with pytest.raises(Exception, match="MALFORMED"):
        delimited.load_delimited(spark, str(tmp_path / "x"), schema, header=False, line_ends=False).collect()


def test_manifest(spark, tmp_path):
    release = {"id": "r2", "name": "Release 2", "releaseDate": "2024-01-01", "archiveFileSizeBytes": 5, "publicKeyId": 7,
               "archiveFileLastModifiedTimestamp": "2024-01-02T03:04:05Z"}
    good = {"apiVersion": "1", "httpStatus": 200, "message": "OK", "releases": [release, {"id": "r1"}]}
    (tmp_path / "good.json").write_text(json.dumps(good, indent=1))
    row = manifest.read_manifests(spark, str(tmp_path / "good.json")).first()
    assert (row["id"], row["name"], row["archiveFileSizeBytes"], row["publicKeyId"]) == ("r2", "Release 2", 5, 7)
    assert len(row) == 21
    for change, message in (({"apiVersion": "2"}, "manifest version"), ({"releases": []}, "without releases")):
        (tmp_path / "bad.json").write_text(json.dumps({**good, **change}))
        with pytest.raises(PySparkException, match=message):
            manifest.read_manifests(spark, str(tmp_path / "bad.json")).collect()


def test_categories(spark):
    assert [manifest.parse_category(x) for x in ("snomed_all", "4", "300", "x")] == [6, 4, None, None]
    assert (manifest.categories_in(6), manifest.item_numbers(2)) == ([2, 4], [1799])
    df = spark.createDataFrame([(1799,), (9,), (5,)], "i int")
    for category, wanted in ((6, [1799, 9]), (2, [1799]), (1, [])):
        assert [r[0] for r in df.filter(manifest.item_in_category(F.col("i"), category)).collect()] == wanted


def test_stored_tables(spark):
    tables.drop_groups(spark, "all")
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    name = S.CODELIST_TABLE
    assert not tables.exists(spark, name)
    tables.create(df, name)
    with pytest.raises(PySparkException):
        tables.create(df, name)
    tables.append(df.select("s", "n"), name)
    assert spark.table(name).count() == 2
    tables.replace(spark.createDataFrame([("b", 2)], "s string, n int"), name, managed=False)
    assert [tuple(r) for r in spark.table(name).collect()] == [(2, "b")]
    tables.replace(spark.createDataFrame([("c",)], "s string"), name)
    assert spark.table(name).columns == ["s"]
    # from itself, and after a failure the old content is still there
    tables.replace(spark.table(name).withColumn("s", F.concat("s", F.lit("!"))), name)
    with pytest.raises(PySparkException):
        tables.replace(spark.table(name).withColumn("s", F.raise_error(F.lit("no")).cast("string")), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [("c!",)]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name + "_new")] == []
    assert tables.drop_groups(spark, "nothing") == []
    assert tables.exists(spark, name)
    assert tables.drop_groups(spark, " CodeList ,x") == list(S.TABLE_GROUPS["codelist"])
    assert not tables.exists(spark, name)


def test_new_files_are_loaded_once(spark, tmp_path):
    drop, target, checkpoint = (str(tmp_path / n) for n in ("drop", "target", "checkpoint"))
    for new_file, expected in ((True, 10), (False, 10), (True, 20), (False, 20)):
        if new_file:
            spark.range(10).write.mode("append").parquet(drop)
        ingest.ingest_new_files(ingest.stream_files(spark, drop, spark.range(1).schema), target, checkpoint)
        assert spark.read.parquet(target).count() == expected


def test_stream_of_release_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_bytes(b"id\tx\r\n\r\n1\ta\rb\r\n")
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    ingest.ingest_new_files(ingest.stream_lines(spark, str(tmp_path / "in")), target, checkpoint)
    assert sorted(r["value"] for r in spark.read.parquet(target).collect()) == ["1\ta\rb", "id\tx"]


def test_batches_are_bounded(spark):
    """Batches that go to Python hold 2,000 rows, and few of long texts."""

    def batch_sizes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([len(batch)] * len(batch), pa.int64())

    session.tune(spark)
    sizes = F.arrow_udf(batch_sizes, "bigint")
    for words, most in ((1, 2000), (5000, 400)):
        df = spark.range(0, 3000, 1, 1).select(sizes(F.array_repeat(F.lit("lexeme"), words)).alias("n"))
        assert df.agg(F.max("n")).first()[0] <= most


def test_running_totals_move_rows_once(spark, skewed, pieces):
    """After the range sort the rows are neither shuffled nor sorted again; NULL is a group like any other."""
    df, rows = skewed
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    made = numbering.running_totals(df, ["g"], ["k"], {"t": F.col("v")})
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan
    wanted, total = {}, defaultdict(int)
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        g = g if g and g > 0 else None
        wanted[g, k] = total[g]
        total[g] += v
    assert {(r["g"], r["k"]): r["t"] for r in made.collect()} == wanted


def test_sums_go_on_over_batches():
    rows = [("a", 1), ("a", 2), ("a", 3), (None, 4), (None, 5), ("b", 6), ("b", 7)]
    for size in range(1, 8):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [
            (pa.array([{"g": g} for g, _ in p], pa.struct([("g", pa.string())])), pa.array([{"t": v} for _, v in p], pa.struct([("t", pa.int64())])))
            for p in parts
        ]
        assert [r["t"] for made in running.sums_before(iter(batches)) for r in made.to_pylist()] == [0, 1, 3, 0, 4, 0, 6]


def test_shuffle_partitions_stay_small(spark):
    """Partitions are put together up to a size, not up to one per core, so that a task's memory does not grow with the table."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        rows = spark.range(2_000_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition("x")
        sizes = rows.groupBy(F.spark_partition_id().alias("at")).agg(F.count("*").alias("n")).collect()
        # 32 bytes of a hash at least can't be packed
        assert sum(r["n"] for r in sizes) == 2_000_000
        assert max(r["n"] for r in sizes) * 32 < 4 << 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
