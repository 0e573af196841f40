"""The operators against brute force on small tables, and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from termspark.llm import decontaminate, html_text, language, licenses, search, sharding, simhash, warc
from termspark.llm.common import connected_components, words_of


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


# ---------------------------------------------------------------- decontamination


def slow_report(docs, items, n=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = []
    for item, text in items:
        w = split(text)
        windows += [(item, w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    for doc, text in docs:
        w, hit, owners = split(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    owners |= {str(item)} if item is not None else set()
        ids = ",".join(sorted(owners))
        yield doc, len(w), len(hit), len(owners), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


ITEMS = [
    (1, "A b c d e f g h i j k l"),
    (10, "c d e f g h i j k l m"),
    (2, "Short Item"),
    (3, None),
    (4, "..."),
    (None, "only without id"),
    (2, "Short Item"),
]
TEXTS = [
    "x A, B c-d e f g h i j y short item, SHORT ITEM!",
    "a b c d e f g h i j k l m n",
    "short. items item short",
    "only without id; a b c",
    None,
    "",
    "ÉA b c",
]


@pytest.mark.parametrize("block_words", [4_000_000, 15])
def test_decontamination(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    pairs = [*enumerate(TEXTS), (0, TEXTS[0]), (None, TEXTS[1])]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontaminate.contamination_report(docs, items)
    assert rows_of(found) == sorted(map(repr, slow_report(pairs, ITEMS)))


def test_spans_and_documents(spark, odd_docs, no_docs, clashing):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    docs = clashing(docs)
    kept = decontaminate.remove_contamination(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {2, 4, 5, 6}
    cut = decontaminate.remove_contamination(docs, items, action="spans")
    assert cut.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts == {0: "x  y !", 1: " n", 2: TEXTS[2], 3: "; a b c", 4: None, 5: "", 6: TEXTS[6]}
    with pytest.raises(ValueError):
        decontaminate.remove_contamination(docs, items, action="nothing")
    odd = clashing(odd_docs)
    assert rows_of(decontaminate.remove_contamination(odd, items)) == rows_of(odd)
    assert decontaminate.contamination_report(no_docs, items).count() == 0
    assert decontaminate.contamination_report(odd_docs, items.limit(0)).filter("contaminated").count() == 0


# ---------------------------------------------------------------- pages


def test_page_text():
    page = """<html><head><title>T</title></head><body class="has-sidebar">
      <div id=header><h1>Site</h1></div><nav><ul><li><a href=/>Home</a></ul></nav>
      <div class="content"><h2>Title &amp; more</h2>
        <p>First paragraph, with commas, and <a href=x>a link</a>, and length enough to be scored.
        <p>Second one<br>has a break,&nbsp;and <b>bold <i>text.</p>
        <div class="ad">Buy now, buy often, buy, buy</div>
        <ul><li>A point<li>Another</ul>
        <ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>
        <form><p>Your name, please, here, now</p><input></form>
        <script>document.write("<p>no, no, no</p>")</script><style>p{}</style><!-- <p>nor this</p> -->
      </div>
      <div class="sidebar"><p>Aside, aside, aside, and some more words here</p></div>
      <section id="comments"><p>I, for one, did not like this, at all, really, no, not</p></section>
      <div class="cookie-notice">We use cookies, and so on</div><footer>(c), all, rights</footer>"""
    assert html_text.extract(page).split("\n") == [
        "Title & more",
        "First paragraph, with commas, and a link, and length enough to be scored.",
        "Second one has a break, and bold text.",
        "A point",
        "Another",
    ]


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain, &lt;text&gt;", "plain, <text>"),
        ("<p>a<p>b", "a\nb"),
        ("<script>x", ""),
        ("<!-- never closed <p>a</p>", ""),
        ("<p title='a > b'>inside</p>", "inside"),
        ("</p></div><p>x", "x"),
        ("<div>" * 3000 + "deep, text" + "</div>" * 3000, "deep, text"),
        ("<p>a < b and <", "a < b and <"),
        ("<p>before <span class='ad'>buy</span> after</p>", "before after"),
        ("<p>x <a class=share href=#>share <b>this</b></a> y", "x y"),
        ("<table><tr><td>a, b<td>c<tr><td>d</table>", "a, b\nc\nd"),
        ("<b>" * 3000 + "<p>one</b></b><p>two</i></p>", "one\ntwo"),
        ("<div class='has-sidebar'><p>kept</p></div><div class='my-sidebar'><p>left, out</p></div>", "kept"),
    ],
)
def test_odd_pages(page, text):
    assert html_text.extract(page) == text


def test_all_pages(spark, tables):
    """Against the articles cut out by a pattern, which the given pages allow."""
    import html

    def cut(page):
        article = re.search("<article>(.*?)</article>", page, re.S)[1]
        blocks = [html.unescape(re.sub("<br>", " ", b.replace("<b>", ""))) for b in re.split("</?(?:p|h1)>", article)]
        return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)

    pages = tables("pages")
    wanted = {r["page_id"]: cut(r["html"]) for r in pages.collect()}
    odd = spark.createDataFrame([(None, None, None)], pages.schema)
    found = html_text.page_report(pages.unionByName(odd)).collect()
    assert {r["page_id"]: r["text"] for r in found} == {**wanted, None: ""}
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html_text.page_report(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- near-duplicates


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(points, near):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    for i, a in enumerate(points):
        for b in points[:i]:
            if near(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in points}


def test_components(spark):
    pick = random.Random(3)
    edges = [(pick.randint(0, 300), pick.randint(0, 300)) for _ in range(220)]
    edges += [(1000, n) for n in range(1001, 1400)] + [(n, n + 1) for n in range(2000, 2100)] + [(7, 7), (5, None)]
    real = {tuple(sorted(e)) for e in edges if None not in e}
    nodes = sorted({n for e in real if e[0] != e[1] for n in e})
    wanted = slow_components(nodes, lambda a, b: tuple(sorted((a, b))) in real)
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r["node"]: r["component"] for r in found.collect()} == wanted
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("radius, spread", [(4, 9), (4, 4), (2, 6)])
def test_links_of_fingerprints(spark, radius, spread):
    """Groups of near copies with many different fingerprints, and strangers."""
    pick = random.Random(spread)
    points = {pick.getrandbits(64) for _ in range(150)}
    for _ in range(4):
        centre = pick.getrandbits(64)
        for _ in range(80):
            points.add(centre ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, spread))))
    points = sorted(map(simhash._signed, points))
    wanted = slow_components(points, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= radius)
    fps = spark.createDataFrame([(p, 1) for p in points], "fp bigint, n bigint")
    assert {r["fp"]: r["root"] for r in simhash.link_fingerprints(fps, radius).collect()} == wanted


def test_thresholds():
    cost, chosen = simhash.allocate([[10, 100, 1000], [1, 2, 3], [5, 50, 500]], 2)
    assert (cost, chosen) == min(
        (sum(c[t] if t >= 0 else 0 for c, t in zip(([10, 100, 1000], [1, 2, 3], [5, 50, 500]), ts)), list(ts))
        for ts in [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 2]
    )


def test_near_duplicates(spark, tables, odd_docs, no_docs, clashing):
    for docs in (tables("documents"), clashing(odd_docs)):
        rows = [(r["doc_id"], slow_fingerprint(r["text"])) for r in docs.collect()]
        points = sorted({f for _, f in rows})
        near = slow_components(points, lambda a, b: (a ^ b).bit_count() <= 4)
        least = {}
        for doc, f in rows:
            if doc is not None:
                least[near[f]] = min(least.get(near[f], doc), doc)
        wanted = [(doc, f"{f:016x}", least.get(near[f])) for doc, f in rows]
        assert rows_of(simhash.near_duplicates(docs)) == sorted(map(repr, wanted))
        kept = simhash.drop_near_duplicates(docs)
        assert kept.columns == docs.columns
        roots = Counter(near[f] for _, f in rows)
        assert kept.count() == len(roots)
        assert {r["doc_id"] for r in kept.collect()} == {least.get(r) for r in roots}
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


# ---------------------------------------------------------------- archives


def test_canonical_urls(spark):
    urls = {
        "HTTP://WWW.Example.com:80/a/?b=2&a=1&utm_source=x#top": "example.com/a?a=1&b=2",
        "https://example.com/a/?a=1&b=2": "example.com/a?a=1&b=2",
        "https://example.com": "example.com",
        "https://example.com/A?ref=1": "example.com/A",
        None: None,
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    found = df.select("url", warc.canonical_url(F.col("url")).alias("c")).collect()
    assert {r["url"]: r["c"] for r in found} == urls


def slow_revisits(records, canonical):
    weak = lambda t: t and t.removeprefix("W/")
    for rid, url, ts, status, headers in records:
        if status != 304:
            continue
        c = canonical.get(url)
        earlier = [
            (r[2], r[0], r[4] or {})
            for r in records
            if r[3] == 200 and c and canonical.get(r[1]) == c and r[2] is not None and ts is not None and r[2] < ts
        ]
        now, outcome, merged, used = headers or {}, "no-response", None, None
        if earlier:
            _, used, then = max(earlier, key=lambda e: e[:2])
            pairs = [(weak(now.get("etag")), weak(then.get("etag"))), (now.get("last-modified"), then.get("last-modified"))]
            known = [a == b for a, b in pairs if a is not None and b is not None]
            outcome = "resolved" if known and all(known) else "changed"
            if outcome == "resolved":
                merged = {**then, **{k: v for k, v in now.items() if k in warc.PERMITTED}}
        yield rid, c, used if merged is not None else None, outcome, merged and sorted(merged.items())


@pytest.mark.parametrize("partitions", [1, 7])
def test_revisits(spark, partitions):
    pick = random.Random(5)
    urls = ["http://hot.example/a", "https://www.hot.example/a/#x", "http://b.example/1", "http://b.example/2", None]
    canonical = {u: c for u, c in zip(urls, ["hot.example/a", "hot.example/a", "b.example/1", "b.example/2", None])}
    records = []
    for n in range(400):
        headers = {"etag": pick.choice(['"1"', 'W/"1"', '"2"']), "content-type": f"t{n}", "date": str(n)}
        if pick.random() < 0.3:
            headers["last-modified"] = pick.choice("ab")
        if pick.random() < 0.2:
            del headers["etag"]
        ts = pick.choice([None, *range(60)])
        status = pick.choice([200, 304, 304, 404])
        records.append((n, pick.choice(urls[:2] * 4 + urls), ts, status, headers if pick.random() < 0.95 else None))
    schema = "record_id bigint, url string, ts bigint, status int, headers map<string,string>"
    df = spark.createDataFrame(records, schema).repartition(5).withColumn("found", F.lit(1))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = warc.resolve_revisits(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = [(*r[:4], r[4] and sorted(r[4].items())) for r in rows]
    assert sorted(map(repr, found)) == sorted(map(repr, slow_revisits(records, canonical)))
    assert {r["outcome"] for r in rows} == {"resolved", "changed", "no-response"}
    assert warc.resolve_revisits(df.limit(0)).count() == 0


# ---------------------------------------------------------------- licenses


@pytest.mark.parametrize(
    "text, labels",
    [
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0,gpl-notice"),
        ("this very good work of ours is licensed under the terms of the GNU general public license", "gpl,gpl-notice"),
        ("This work of more than four words is licenced under the GNU General Public License", "gpl"),
        ("Released under the MIT License.", "mit,mit-notice"),
        ("Licensed under the Apache License, Version 2.0 (the \"License\")", "apache,apache-2.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
        ("Copyright (c) 2020 Some One. All rights reserved", "all-rights-reserved"),
        ("Copyright a b c d e f g h i j all rights reserved", ""),
        ("the mit licences", ""),
        ("cc, by", "cc-by"),
    ],
)
def test_license_labels(text, labels):
    _, base, more, _ = licenses.Scanner().scan(words_of(text.encode()))
    assert ",".join(sorted(base | more)) == labels


def test_license_places(spark, odd_docs, no_docs, clashing):
    docs = spark.createDataFrame([(1, "MIT license, mit mit license; é apache LICENSE"), (2, None)], "doc_id bigint, text string")
    one, two = licenses.license_report(clashing(docs)).orderBy("doc_id").collect()
    assert tuple(one) == (1, 8, 3, 0, 6, "apache,mit", "apache,mit", 0.5)
    assert tuple(two) == (2, 0, 0, None, None, "", "", 0.0)
    assert licenses.license_report(odd_docs).count() == odd_docs.count()
    assert licenses.license_report(no_docs).count() == 0


def test_templates_as_patterns():
    """Random short texts against the templates as regular expressions."""
    from termspark.llm.oracles import license_pattern

    pick = random.Random(2)
    for label, template in licenses.TEMPLATES.items():
        automaton, pattern = licenses.Automaton.of(template), re.compile(license_pattern(template))
        plain = [w for *_, w in licenses.MARKUP.findall(template) if w]
        for _ in range(300):
            words = [w if pick.random() < 0.97 else pick.choice(plain) for w in plain if pick.random() < 0.93]
            words = [x for w in words for x in ([w] if pick.random() < 0.95 else [w, "other"])]
            at = pick.randint(0, 2)
            words = ["x"] * at + words
            data = [w.lower().encode() for w in words]
            found = any(automaton.accepts_from(data, n) for n in range(len(data) or 1))
            assert found == bool(pattern.search(" " + " ".join(w.lower() for w in words) + " ")), (label, words)
    with pytest.raises(ValueError):
        licenses.Automaton.of("<<beginOptional>>open")


# ---------------------------------------------------------------- language


def test_codewords():
    for count in (2, 3, 4, 6, 7, 20):
        code = language.codewords(count)
        far = [(code[a] != code[b]).sum() for a in range(count) for b in range(a)]
        assert min(far) >= {2: 1, 3: 2, 4: 4, 6: 16}.get(count, code.shape[1] // 5)
    assert language.codewords(1).shape == (1, 0)


def test_letters():
    assert [language.has_letter(t) for t in (None, "", "12 ½²_!", "½ é", "中", "1a")] == [False] * 3 + [True] * 3


def test_held_out_accuracy(spark, tables):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held_out = [r for r in found if r["held_out"]]
    assert len(held_out) > 300
    assert sum(r["lang"] == r["lang_pred"] for r in held_out) >= 0.97 * len(held_out)
    assert all(0 <= r["score"] <= 1 for r in found)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)


def test_language_ignores_all_but_the_text(spark, tables):
    docs = tables("documents")
    model = language.train(docs)
    other = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("z")})
    pick = lambda df: rows_of(language.predict(df, model, ["doc_id"]).select("_row.doc_id", "lang_pred", "score"))
    assert pick(docs) == pick(other)


def test_odd_languages(spark, odd_docs, no_docs, clashing):
    report = language.language_report(clashing(odd_docs))
    assert report.count() == odd_docs.count()
    nothing = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.language_report(nothing).collect()} == {"und"}
    assert language.language_report(no_docs).count() == 0
    kept = language.keep_identified(clashing(odd_docs))
    assert kept.columns == clashing(odd_docs).columns
    assert all(language.has_letter(r["text"]) for r in kept.collect())
    assert language.keep_identified(no_docs).count() == 0


# ---------------------------------------------------------------- search


def slow_top(docs, queries, k):
    import math

    merged = {}
    for doc, text in docs:
        if doc is not None:
            merged.setdefault(doc, []).extend(words_of((text or "").encode()))
    bags = {d: Counter(w) for d, w in merged.items() if w}
    df = Counter(w for bag in bags.values() for w in bag)
    mean = sum(map(Counter.total, bags.values())) / max(len(bags), 1)
    for q, text in queries:
        scores = []
        for doc, bag in bags.items():
            score = 0
            for w in set(words_of((text or "").encode())) & bag.keys():
                rarity = math.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5))
                tf = bag[w]
                norm = search.K1 * (1 - search.B + search.B * bag.total() / mean)
                score += math.floor(rarity * (tf * (search.K1 + 1) / (tf + norm)) * search.UNIT + 0.5)
            if score > 0:
                scores.append((-score, doc))
        yield from ((q, n + 1, doc, -s) for n, (s, doc) in enumerate(sorted(scores)[:k]))


@pytest.mark.parametrize("shard_docs, group_terms", [(16_384, 1 << 23), (37, 1 << 23), (50, 700)])
def test_search(spark, tables, odd_docs, monkeypatch, shard_docs, group_terms):
    monkeypatch.setattr(search, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(search, "GROUP_TERMS", group_terms)
    docs = tables("documents").select("doc_id", "text")
    docs = docs.unionByName(odd_docs.select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    asked = docs.filter("doc_id % 20 = 0 or doc_id >= 1000").select(F.col("doc_id").alias("query_id"), "text")
    asked = asked.dropDuplicates(["query_id"])
    asked = asked.withColumn("doc_id", F.lit("x")).unionByName(spark.sql("select cast(null as bigint) query_id, 'the' text, '' doc_id"))
    found = search.top_documents(docs.withColumns({"terms": F.lit(1), "place": F.lit("x"), "group": F.lit(2)}), asked, 5)
    asked = asked.filter("query_id is not null").select("query_id", "text")
    docs = docs.select("doc_id", "text")
    wanted = slow_top([tuple(r) for r in docs.collect()], [tuple(r) for r in asked.collect()], 5)
    assert rows_of(found) == sorted(map(repr, wanted))


def test_pruning_changes_nothing(monkeypatch):
    import numpy as np

    pick = np.random.default_rng(4)
    n = 20_000
    docs, terms = pick.integers(0, 900, n), (pick.pareto(1, n) * 3).astype(int) % 400
    pairs = sorted(set(zip(docs.tolist(), terms.tolist())))
    docs, terms = map(np.array, zip(*pairs))
    ids = np.array([int(i) * 3 for i in pick.permutation(900)])
    weights = pick.integers(1, 50, len(docs))
    queries = [np.unique(pick.integers(0, 450, 12)) for _ in range(60)]
    for block, dense in [(64, 1 / 32), (8, 1 / 8), (8, 2)]:
        monkeypatch.setattr(search, "BLOCK", block)
        monkeypatch.setattr(search, "DENSE_SHARE", dense)
        names = np.arange(401)
        found = search.Shard(ids, docs, terms, weights, names).search(queries, 7)
        for query, top in zip(queries, found):
            scores = Counter()
            for d, t, w in zip(docs.tolist(), terms.tolist(), weights.tolist()):
                if t in query:
                    scores[int(ids[d])] += w
            assert top == [(s, d) for s, d in sorted(((s, d) for d, s in scores.items()), key=lambda x: (-x[0], x[1]))[:7]]


def test_a_group_of_queries_is_held_as_numbers(tmp_path, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    monkeypatch.setattr(search, "MERGED_TERMS", 5)
    pick = random.Random(3)
    terms = [pick.sample(range(-40, 40), pick.randint(0, 12)) for _ in range(20)]
    for n in range(2):
        lists = terms[n * 10 : n * 10 + 10]
        kept = {"query_id": range(n * 10, n * 10 + 10), "terms": lists, "dfs": [[t + 100 for t in x] for x in lists]}
        pq.write_table(pa.table({c: pa.array(list(v)) for c, v in kept.items()}), f"{tmp_path}/part-{n}.parquet")
    asked = search.Asked(str(tmp_path))
    assert asked.names.tolist() == sorted({t for x in terms for t in x})
    assert (asked.df == asked.names + 100).all() and asked.ids.tolist() == list(range(20))
    assert asked.names[asked.numbers].tolist() == [t for x in terms for t in x]
    assert asked.lengths.tolist() == [len(x) for x in terms]
    names = np.arange(50)
    shard = search.Shard(np.arange(300), np.arange(50), names, np.arange(50) + 1.0, names)
    assert {a.itemsize for a in (asked.numbers, shard.weights, shard.listed_max, shard.places, shard.local)} == {4}


def test_more_groups_of_queries_move_no_more_documents(spark, monkeypatch):
    pick = random.Random(5)
    docs = [(n, " ".join(pick.choices([f"w{n}" for n in range(60)], k=30))) for n in range(300)]
    asked, table = docs[::10], spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    monkeypatch.setattr(search, "SHARD_DOCS", 40)
    monkeypatch.setattr(search, "GROUP_TERMS", 90)
    found = search.top_documents(table, spark.createDataFrame(asked, "query_id bigint, text string"), 4)
    assert rows_of(found) == sorted(map(repr, slow_top(docs, asked, 4)))
    # of the groups, only the tasks' results are shuffled
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"Exchange (\w+\(\w+)", plan)) == {"hashpartitioning(query_id"} and "Generate" not in plan


@pytest.mark.parametrize("shares", [1, 3, 40])
def test_shares_of_a_group_have_each_document_once(tmp_path, shares):
    pick, ids = random.Random(6), list(range(200))
    terms = [pick.sample(range(90), pick.randint(1, 9)) for _ in ids]
    for n, (first, end, size) in enumerate([(0, 120, 25), (120, 121, 25), (121, 200, 10), (200, 200, 10)]):
        lists = terms[first:end]
        kept = {"doc_id": ids[first:end], "length": [len(t) for t in lists], "terms": lists, "checks": lists, "tfs": lists}
        kinds = {"doc_id": pa.int64(), "length": pa.int64(), "terms": pa.list_(pa.int64())}
        made = pa.table({c: pa.array(v, kinds.get(c, pa.list_(pa.int32()))) for c, v in kept.items()})
        pq.write_table(made, f"{tmp_path}/part-{n}.parquet", row_group_size=size)
    seen, counts = [], []
    for share in range(shares):
        shards = [pa.Table.from_batches(parts) for parts in search._shards(str(tmp_path), share, shares, 16)]
        counts.append(sum(map(len, shards)))
        assert search._share(str(tmp_path), share, shares)[0] == counts[-1]
        assert all(len(s) <= 25 for s in shards) and len({len(s) for s in shards[:-1]}) < 2
        seen += [row for s in shards for row in zip(s["doc_id"].to_pylist(), s["terms"].to_pylist())]
    assert sorted(seen) == list(zip(ids, terms)) and max(counts) - min(counts) <= 25


def test_empty_search(spark, no_docs, tables):
    asked = tables("documents").select(F.col("doc_id").alias("query_id"), "text")
    assert search.top_documents(no_docs, asked).count() == 0
    assert search.top_documents(tables("documents"), asked.limit(0)).count() == 0


# ---------------------------------------------------------------- sharding


def test_sharding(spark, tables, odd_docs, no_docs, clashing):
    import zlib

    for docs in (tables("documents"), clashing(odd_docs)):
        rows = sharding.shard_documents(docs, 5).collect()
        size = lambda t: len((t or "").encode())
        wanted = [(r["doc_id"], size(r["text"]) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()]
        assert sorted(map(repr, (tuple(r)[:3] for r in rows))) == sorted(map(repr, wanted))
        per_shard = {}
        for r in rows:
            assert r["law"] == "bytes" and r["grown_shard"] is None
            per_shard.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(own) == list(range(len(own))) for own in per_shard.values())
    assert sharding.shard_documents(no_docs).count() == 0


def test_repeated_rows_keep_the_law(spark):
    """Half of all rows are one row."""
    rows = [(n, f"text {n}") for n in range(2000)] + [(-1, "the same row again")] * 2000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    made = sharding.shard_documents(docs).collect()
    sizes, slots = {}, {}
    for r in made:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(made) == 4000 and len(sizes) == 24
    assert max(sizes.values()) - min(sizes.values()) < 0.05 * max(sizes.values())
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_even_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = [r["b"] for r in sharding.shard_documents(docs).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 24 and max(sizes) < 1.02 * sum(sizes) / 24


def test_map_versions(spark):
    pick = random.Random(1)
    sizes = {s: pick.randint(1, 1000) for s in range(512)}
    first = sharding.rebalance(sizes, {}, 8, 512)
    assert sharding.rebalance(sizes, first, 8, 512) == first
    grown = sharding.rebalance(sizes, first, 9, 512)
    moved = [s for s in grown if grown[s] != first[s]]
    assert 512 / 9 * 0.5 < len(moved) < 512 / 9 * 2
    shrunk = sharding.rebalance(sizes, first, 7, 512)
    assert set(shrunk.values()) == set(range(7))
    for made, n in ((grown, 9), (shrunk, 7)):
        load = Counter()
        for slot, shard in made.items():
            load[shard] += sizes[slot]
        assert max(load.values()) < 1.03 * sum(sizes.values()) / n
    frame = spark.createDataFrame(list(sizes.items()), "virtual_slot int, bytes bigint")
    one = sharding.new_version(spark, frame, 8, 512)
    two = sharding.new_version(spark, frame, 9, 512, one)
    assert {r["version"] for r in two.collect()} == {2} and two.count() == 512


