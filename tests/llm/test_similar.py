"""Near-duplicates of the pipeline against the Jaccard similarity of all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from termspark.llm import similar

DEDUP = dict(corpus_pipeline.STAGES)["near_dedup"]


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def slow_kept(rows):
    """The smallest doc_id of every component of pairs with a similarity of 0.8."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc)
    return sorted(min((d for d in g if d is not None), default=-1) for g in ids.values())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def made_rows():
    """Copies with few and many edits around the limit, chains, short texts, a common line, one hot group."""
    rng = random.Random(7)
    line, texts = [f"l{n}" for n in range(30)], ["", None, " ", "a b", "A  b", "a b c", "a b c d e", "x a b c d e"]
    for size in (6, 9, 14, 40, 90, 200, 1500):
        for _ in range(4):
            words = [f"w{rng.randrange(3000)}" for _ in range(size)]
            texts.append(" ".join(words))
            for _ in range(4):
                texts.append(" ".join(edited(rng, words, rng.randrange(1 + size // 30))))
                texts.append(" ".join(words[: size - rng.randrange(1 + size // 4)]))
            for _ in range(3):
                words = edited(rng, words, 1 + size // 80)
                texts.append(" ".join(words))
    texts += [" ".join(line + [f"u{n}-{i}" for i in range(20)]) for n in range(30)]
    hot = [f"h{n}" for n in range(120)]
    texts += [" ".join(edited(rng, hot, 2)) for _ in range(60)]
    rng.shuffle(texts)
    return [*enumerate(texts, 1), (None, texts[0]), (None, "only without an id"), (3, texts[2])]


def test_all_pairs(spark):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    kept = DEDUP(spark, docs, None)
    assert kept.columns == docs.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == slow_kept(rows)


def test_given_documents(spark, tables, odd_docs, no_docs, clashing):
    """A pair of the given documents is 9 bits of a fingerprint apart at a similarity of 0.83."""
    for docs in (tables("documents"), clashing(odd_docs)):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        kept = DEDUP(spark, docs, None)
        assert kept.columns == docs.columns
        assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == slow_kept(rows)
    assert DEDUP(spark, no_docs, None).count() == 0


@pytest.mark.parametrize("n, wanted", [(0, 0), (1, 1), (5, 2), (100, 21)])
def test_taken(n, wanted):
    assert similar.taken(n) == wanted


@pytest.mark.parametrize("m", [100, 200, 400])
def test_common_passage(spark, m):
    """Texts of 100 words that share a passage of 60 are no candidates of one another."""
    passage = " ".join(f"p{n}" for n in range(60))
    rows = [(n, " ".join([*(f"a{n}x{i}" for i in range(20)), passage, *(f"b{n}x{i}" for i in range(20))])) for n in range(m)]
    texts = spark.createDataFrame(rows, "at bigint, text string").withColumn("doc_id", F.col("at"))
    counts = similar.sketch_counts(texts)
    assert counts.sum() == 96 * m and counts.max() >= m
    keys = similar.with_keys(texts, counts).select(F.explode("keys").alias("key")).groupBy("key").count()
    assert keys.filter("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0] <= m // 20


def test_maps_reject_no_similar_pair(spark):
    """The bits that the other map lacks never are more than the hashes that the other set lacks."""
    rng, rows = random.Random(8), []
    for _ in range(300):
        x = {rng.getrandbits(62) for _ in range(rng.randrange(1, 1500))}
        y = set(rng.sample(sorted(x), len(x) - rng.randrange(1 + len(x) // 5)))
        y |= {rng.getrandbits(62) for _ in range(rng.randrange(1 + len(x) // 4))}
        maps = [similar.bit_map(np.array(sorted(s), "<i8")).tolist() for s in (x, y)]
        rows += [(*maps, len(x - y), len(x)), (*maps[::-1], len(y - x), len(y))]
    df = spark.createDataFrame(rows, "x array<bigint>, y array<bigint>, missing int, n int")
    found = df.select(similar._missing("x", "y").alias("bits"), "missing", "n", (F.size("x") != F.size("y")).alias("folded"))
    assert found.filter("folded").count() > 10
    assert found.filter("bits > missing").count() == 0
    assert found.filter("missing > 100 and bits < missing / 3").count() == 0


def test_fingerprint_links(spark, monkeypatch):
    """The stage links fingerprints by the SimHash operator first; of its components only similar texts stay linked."""
    asked, link = [], similar.simhash.link_fingerprints
    monkeypatch.setattr(similar.simhash, "link_fingerprints", lambda fps: asked.append(fps.count()) or link(fps))
    rng = random.Random(9)
    words = [f"w{n}" for n in range(400)]
    texts = [" ".join(edited(rng, words, n % 2)) for n in range(20)] + ["", "other words here"]
    # the same fingerprint by hand, and nothing in common
    texts += [" ".join(f"{side}{n}" for n in range(200)) for side in "xy"]
    rows = [(n, n, t) for n, t in enumerate(dict.fromkeys(texts))]
    docs = spark.createDataFrame(rows, "at bigint, doc_id bigint, text string")
    standing = similar.with_keys(docs, np.zeros(similar.CELLS, np.int64)).drop("doc_id", "same")
    last = [n for n, _, t in rows if t[0:1] in ("x", "y")]
    standing = standing.withColumn("fp", F.when(F.col("at").isin(last), F.lit(77)).otherwise(F.col("fp")))
    found = similar.fingerprint_links(standing, docs).collect()
    sets = [shingles(t) for _, _, t in rows]
    assert found and all(5 * len(sets[r["a"]] & sets[r["b"]]) >= 4 * len(sets[r["a"]] | sets[r["b"]]) for r in found)
    assert asked == [standing.select("fp").distinct().count()]
    asked.clear()
    assert DEDUP(spark, docs, None).count() == len(slow_kept([(n, t) for n, _, t in rows])) and len(asked) == 1


def test_first_shared_key(spark):
    """Every similar pair passes at the first key that it shares; keys that come late in a text pair it with no one."""
    rng, rows = random.Random(10), []
    for n in range(400):
        x = sorted({rng.getrandbits(40) for _ in range(rng.randrange(1, 120))})
        y = {h for h in x if rng.random() > 0.1} | {rng.getrandbits(40) for _ in range(rng.randrange(1 + len(x) // 6))}
        y, both = sorted(y), sorted(set(x) & set(y))
        if both and 5 * len(both) >= 4 * len({*x, *y}):
            rows.append((len(x), len(x) - x.index(both[0]), len(y), len(y) - y.index(both[0])))
    assert len(rows) > 100
    near = spark.createDataFrame(rows, "n bigint, rest bigint, m bigint, left bigint")
    passes = similar._first_shared(*map(F.col, ("n", "rest", "m", "left")))
    small = similar._leads(F.least("n", "m"), F.when(F.col("n") <= F.col("m"), F.col("rest")).otherwise(F.col("left")))
    assert near.filter(passes & (small | (F.col("n") == F.col("m")))).count() == len(rows)
    late = spark.createDataFrame([(100, 85, 100, 100), (100, 100, 82, 80)], near.schema)
    assert late.filter(passes).count() == 0


@pytest.mark.parametrize("sent", [0, similar.SENT_WORDS])
def test_rows_at_every_place(spark, monkeypatch, sent):
    monkeypatch.setattr(similar, "SENT_WORDS", sent)
    rows = [(n + (part << 33), {"doc_id": n}) for part in (0, 1, 70) for n in range(200)]
    wanted = [at for at, _ in rows if at % 3 == 0 or at & 63 == 63]
    numbered = spark.createDataFrame(rows, "at bigint, given struct<doc_id: bigint>")
    kept = spark.createDataFrame([(at,) for at in wanted], "at bigint")
    found = similar.rows_at(numbered, kept)
    assert found.columns == numbered.columns
    assert sorted(r["at"] for r in found.collect()) == wanted
    assert similar.rows_at(numbered, kept.limit(0)).collect() == []


def test_kept_texts_do_not_move(spark):
    """The last join is the only one in the plan; it has the whole texts on one side."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")], "doc_id bigint, text string")
        found = similar.drop_similar(docs)
        assert sorted(r["doc_id"] for r in found.collect()) == [1, 3]
        assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
