"""Near-duplicates by word overlap: all pairs of texts with a Jaccard similarity of 0.8 in five-word shingles.

The pairs are found by prefix filtering, which loses none. All shingle hashes are put in one order, common ones
last; of a text's n hashes the first n - ceil(0.8 n) + 1 become its keys, and similar texts share at least one.
The order comes from a count sketch: each task counts in how many of its texts a cell's hashes occur, Spark adds
the cells up, and a hash stands where its cell's count puts it, then by its value. Hashes that share a cell
only make the order less sharp; any one order for all texts finds all pairs. A passage that many otherwise different
texts share is thus no key of them, as each has rarer hashes.

Texts with the same shingles count once. First the SimHash operator links fingerprints (``simhash``), and every text
of such a component is compared with its first one. What SimHash does not reach is found by keys: of each key's texts
a few hubs are compared with the others, then only texts whose components differ meet, and a key's largest component
stands on one side only. Two texts are candidates of a key only if it may be the first that they share: the hashes
from it on must then hold all they need to have in common. Candidates are first tested on bit maps of their
hashes, which never reject a similar pair; those that pass are verified with all shingle hashes (64 bits) of both
texts, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspark.llm import simhash
from termspark.llm.common import connected_components, map_rows, read_once, release, struct, texts_of, with_batch_bounds
from termspark.session import drop_staged

SHINGLE_WORDS = 5
# similarity of at least OF_ALL / ALL
OF_ALL, ALL = 4, 5
SEED = 42
HUBS = 3
# cells of the count sketch, and how many of them travel in one row
CELLS, CHUNK = 1 << 20, 1 << 12
# 64-bit words of the smallest map, and bits for each hash at least; sizes are powers of two
MAP_WORDS, MAP_BITS = 8, 2
# words of 64 rows each that are sent to every task, some 50 bytes each there, so that the rows need not move
SENT_WORDS = 1 << 20


def shingle_hashes(text: bytes, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of a UTF-8 text's shingles in order: lower-cased A-Z, words between ASCII white space.

    Fewer words make one shingle; no words none.
    """
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, "<i8")
    columns = [words[i:] for i in range(k)] if len(words) >= k else [[w] for w in words]
    shingles = map(b" ".join, zip(*columns))
    number = max(len(words) - k + 1, 1)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", number).view("<i8"))


def taken(n: int) -> int:
    """How many of the first of ``n`` hashes are keys."""
    return n - -(-OF_ALL * n // ALL) + 1 if n else 0


def sketch_counts(texts: DataFrame, cells: int = CELLS) -> np.ndarray:
    """For each cell, how many (text, hash) of ``texts(text)`` fall into it.

    A task hands on one array; the arrays are added up chunk by chunk. The driver gets one number per cell.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(cells, np.int64)
        for batch in batches:
            hashes = [shingle_hashes(t) for t in texts_of(batch["text"])]
            places = np.concatenate([*hashes, np.zeros(0, "<i8")]) & (cells - 1)
            sums += np.bincount(places, minlength=cells)
            del hashes, places
            release()
        yield from chunks({n: sums[n * CHUNK : (n + 1) * CHUNK] for n in range(-(-cells // CHUNK))})

    def chunks(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        made = {n: s for n, s in sums.items() if s.any()}
        lists = pa.array(list(made.values()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()), lists], names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, counts in zip(batch["chunk"].to_pylist(), batch["counts"]):
                values = counts.values.to_numpy()
                sums[n] = sums[n] + values if n in sums else values
        yield from chunks(sums)

    kind = "chunk int, counts array<bigint>"
    asked = with_batch_bounds(texts.select(F.col("text").cast("binary").alias("text")))
    found = asked.mapInArrow(count, kind).repartition("chunk").mapInArrow(add, kind)
    made = np.zeros(cells, np.int64)
    for row in found.toLocalIterator():
        made[row["chunk"] * CHUNK : row["chunk"] * CHUNK + len(row["counts"])] = row["counts"]
    return made


def ordered_keys(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The keys of a text: the first of its hashes in the order of their cells' counts."""
    if not len(hashes):
        return hashes
    return hashes[np.lexsort((hashes, counts[hashes & (len(counts) - 1)]))[: taken(len(hashes))]]


def bit_map(hashes: np.ndarray) -> np.ndarray:
    """Bits in 64-bit words, each set if a hash falls on it; folding a map in half gives that of half the size."""
    words = MAP_WORDS
    while 64 * words < MAP_BITS * len(hashes):
        words *= 2
    bits = np.zeros(64 * words, np.uint8)
    bits[(hashes >> 32) & (64 * words - 1)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def with_keys(numbered: DataFrame, counts: np.ndarray) -> DataFrame:
    """``at, same`` (alike for equal sets of shingles), ``n``, ``bits`` (the text's map), ``keys`` in order and ``fp``."""
    held = numbered.sparkSession.sparkContext.broadcast(counts)

    def start():
        import xxhash

        def work(batch: pa.RecordBatch) -> dict:
            made: dict[str, list] = {"same": [], "n": [], "bits": [], "keys": [], "fp": []}
            for text in texts_of(batch["text"]):
                hashes = shingle_hashes(text)
                made["same"].append(xxhash.xxh3_128_digest(hashes.tobytes()))
                made["n"].append(len(hashes))
                made["bits"].append(bit_map(hashes))
                made["keys"].append(ordered_keys(hashes, held.value))
                made["fp"].append(simhash._signed(simhash.fingerprint(text)))
            return made

        return work

    out = struct("same binary, n bigint, bits array<bigint>, keys array<bigint>, fp bigint")
    found = map_rows(numbered, {"text": "binary"}, out, start, ["at", "doc_id"])
    return found.select("_row.at", "_row.doc_id", "same", "n", "bits", "keys", "fp")


def _sets(texts: DataFrame) -> DataFrame:
    """``(at, hashes)``: all shingle hashes of ``texts(at, text)``."""

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            return {"hashes": [shingle_hashes(t) for t in texts_of(batch["text"])]}

        return work

    found = map_rows(texts, {"text": "binary"}, struct("hashes array<bigint>"), start, ["at"])
    return found.select(F.col("_row.at").alias("at"), "hashes")


def _first_shared(n: Column, rest: Column, other_n: Column, other_rest: Column) -> Column:
    """Whether a key may be the first that two similar texts share, by their sizes and how many hashes it begins.

    All shared hashes then stand in both rests, and ``OF_ALL (x + y) / (ALL + OF_ALL)`` are needed.
    """
    return (ALL + OF_ALL) * F.least(rest, other_rest) >= OF_ALL * (n + other_n)


def _leads(n: Column, rest: Column) -> Column:
    """Whether a key may be the first shared one for the smaller of two texts."""
    return (ALL + OF_ALL) * rest >= 2 * OF_ALL * n


def _folded(one: str, other: str) -> Column:
    """A map, folded to the size of the other if that is half as large."""
    half = F.size(other)
    low, high = F.slice(one, F.lit(1), half), F.slice(one, half + 1, half)
    return F.when(F.size(one) > half, F.zip_with(low, high, lambda x, y: x.bitwiseOR(y))).otherwise(F.col(one))


def _missing(one: str, other: str) -> Column:
    """Bits of one map that the other lacks: so many hashes of the one set at least are not in the other.

    Similar sets differ by a quarter in size, so their maps by one step at most; others are not compared.
    """
    pairs = F.zip_with(_folded(one, other), _folded(other, one), lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.aggregate(pairs, F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(0)))


def verified(pairs: DataFrame, maps: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the distinct ``pairs(a, b)`` that are similar, by ``maps(at, n, bits)``, then ``texts(at, text)``."""
    spark = pairs.sparkSession
    first, second = (maps.select(*[F.col(c).alias(f"{c}_{side}") for c in maps.columns]) for side in "ab")
    mapped = pairs.join(first, F.col("a") == F.col("at_a")).join(second, F.col("b") == F.col("at_b"))
    # both / (x + y - both) >= OF_ALL / ALL, so both >= OF_ALL (x + y) / (ALL + OF_ALL)
    both = OF_ALL * (F.col("n_a") + F.col("n_b"))
    possible = ((ALL + OF_ALL) * (F.col("n_a") - _missing("bits_a", "bits_b")) >= both) & (
        (ALL + OF_ALL) * (F.col("n_b") - _missing("bits_b", "bits_a")) >= both
    )
    near, near_path = read_once(mapped.filter(possible).select("a", "b"), "candidates")
    # written first: the join then knows how few they are, and does not move the texts
    ends, ends_path = read_once(near.select(F.explode(F.array("a", "b")).alias("at")).distinct(), "ends")
    sets, sets_path = read_once(_sets(texts.join(ends, "at", "left_semi")), "shingles")
    first = sets.select(F.col("at").alias("a"), F.col("hashes").alias("x"))
    second = sets.select(F.col("at").alias("b"), F.col("hashes").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    enough = (ALL + OF_ALL) * shared >= OF_ALL * (F.size("x") + F.size("y"))
    made, _ = read_once(near.join(first, "a").join(second, "b").filter(enough).select("a", "b"), "similar")
    for path in (near_path, ends_path, sets_path):
        drop_staged(spark, path)
    return made


def fingerprint_links(standing: DataFrame, texts: DataFrame) -> DataFrame:
    """Similar pairs ``(a, b)`` among texts whose fingerprints SimHash links, each with the first of its component."""
    fps, fps_path = read_once(standing.groupBy("fp").agg(F.count("*").alias("n")), "fingerprints")
    roots, roots_path = read_once(simhash.link_fingerprints(fps), "fingerprint-roots")
    rooted = standing.select("at", "fp").join(roots, "fp")
    firsts = rooted.groupBy("root").agg(F.min("at").alias("a"))
    pairs = rooted.join(firsts, "root").filter("at <> a").select("a", F.col("at").alias("b"))
    found = verified(pairs, standing.select("at", "n", "bits"), texts)
    for path in (fps_path, roots_path):
        drop_staged(standing.sparkSession, path)
    return found


def link_sets(standing: DataFrame, texts: DataFrame) -> DataFrame:
    """``(at, root)`` for those of ``standing(at, n, bits, keys, fp)``, one per set of shingles, similar to another one.

    ``root`` is the smallest ``at`` reachable over links. Exact: no similar pair is missed.
    """
    spark = standing.sparkSession
    pair = [F.least("at", "_at").alias("a"), F.greatest("at", "_at").alias("b")]
    maps = standing.select("at", "n", "bits")
    near, near_path = read_once(connected_components(fingerprint_links(standing, texts), "near-links"), "near-components")

    # keys that texts of several components have, one of them as a leading key; all tokens move once
    labelled = standing.join(near, standing["at"] == near["node"], "left").select(
        "at", "n", F.coalesce("component", "at").alias("label"), F.posexplode("keys").alias("place", "key")
    )
    tokens = labelled.select("key", "at", "n", (F.col("n") - F.col("place")).alias("rest"), "label").repartition("key")
    leads = _leads(F.col("n"), F.col("rest"))
    # the aggregate asks for every column, so that the join finds the same shuffle
    common = tokens.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max(leads).alias("leads"),
        F.min("at").alias("least"), F.max("at").alias("most"),
    )
    common = common.filter("least < most and low < high and leads").select("key")
    held, held_path = read_once(tokens.filter("key is not null").join(common, "key"), "keys")

    # links to a few hubs of every such key
    hub = F.struct("at", "n", "rest", "label")
    picks = [F.min_by(hub, F.struct(F.xxhash64("at", F.lit(seed)), "at")) for seed in range(HUBS)]
    hubs = held.groupBy("key").agg(F.array_distinct(F.array(*picks)).alias("hubs"))
    met = held.join(hubs, "key").select("at", "n", "rest", "label", F.explode("hubs").alias("hub"))
    may = _first_shared(F.col("n"), F.col("rest"), F.col("hub.n"), F.col("hub.rest"))
    met = met.filter((F.col("label") != F.col("hub.label")) & may).withColumn("_at", F.col("hub.at"))
    links = verified(met.select(*pair).distinct(), maps, texts)
    chains = near.select(F.col("node").alias("a"), F.col("component").alias("b"))
    first, first_path = read_once(connected_components(chains.unionByName(links), "hub-links"), "hub-components")

    # the rest: only between components, and of a key's largest one on one side
    labelled = held.join(first, held["at"] == first["node"], "left").select(
        "at", "n", "rest", "key", F.coalesce("component", "at").alias("label")
    )
    labelled, labelled_path = read_once(labelled, "labelled")
    drop_staged(spark, held_path)
    per_label = labelled.groupBy("key", "label").count()
    buckets = per_label.groupBy("key").agg(
        F.max_by("label", F.struct("count", "label")).alias("most"), F.count("*").alias("labels")
    )
    apart_keys = labelled.join(buckets.filter("labels > 1").select("key", "most"), "key")
    probes = apart_keys.filter("label <> most").select(
        "key", *[F.col(c).alias(f"_{c}") for c in ("at", "n", "rest", "label")]
    )
    apart = (F.col("label") != F.col("_label")) & _first_shared(F.col("n"), F.col("rest"), F.col("_n"), F.col("_rest"))
    # of two that are both outside the largest one, the first in order probes
    apart &= (F.col("label") == F.col("most")) | (F.col("_at") < F.col("at"))
    rest = verified(apart_keys.join(probes, "key").filter(apart).select(*pair).distinct(), maps, texts)
    chains = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    made, _ = read_once(connected_components(chains.unionByName(rest), "links"), "linked")
    for path in (labelled_path, near_path, first_path):
        drop_staged(spark, path)
    return made.select(F.col("node").alias("at"), F.col("component").alias("root"))


def rows_at(numbered: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``numbered(at, ...)`` whose ``at`` is in ``kept(at)``, by a bit for each row.

    The rows, which hold whole texts, stay where they are, unless there are too many bits to send.
    """
    bits = kept.groupBy(F.shiftright("at", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("_bits")
    )
    bits, _ = read_once(bits, "kept")
    if bits.count() <= SENT_WORDS:
        bits = F.broadcast(bits)
    joined = numbered.join(bits, F.shiftright("at", 6) == F.col("_word"))
    return joined.filter("shiftright(_bits, cast(at & 63 as int)) & 1 = 1").select(numbered.columns)


def drop_similar(docs: DataFrame) -> DataFrame:
    """One row of every group of similar texts: that of the smallest doc_id, in the columns of ``docs``.

    Texts without words are alike. Of rows with the same doc_id in a group, one stays. Rows with a NULL
    doc_id stay only in groups without an id. Repeated rows are of one group; an empty table gives no rows.
    """
    spark = docs.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered, _ = read_once(docs.select(F.monotonically_increasing_id().alias("at"), row.alias("given")), "numbered")
    texts = numbered.select("at", F.col("given.doc_id").alias("doc_id"), F.col("given.text").cast("string").alias("text"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "at")
    hashed = with_keys(texts, sketch_counts(texts)).withColumn("first", order)
    alike = hashed.groupBy("same").agg(F.min("first").alias("first"), F.min_by(F.struct("n", "bits", "keys", "fp"), "first").alias("set"))
    standing, standing_path = read_once(alike.select("first", F.col("first.at").alias("at"), "set.*"), "sets")
    roots = link_sets(standing, texts)
    grouped = standing.select("first", "at").join(roots, "at", "left")
    kept = grouped.groupBy(F.coalesce("root", "at").alias("root")).agg(F.min("first").alias("first"))
    made = rows_at(numbered, kept.select(F.col("first.at").alias("at"))).select("given.*")
    drop_staged(spark, standing_path)
    return made
