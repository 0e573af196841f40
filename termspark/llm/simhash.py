"""SimHash near-duplicates, linked by the generalised pigeonhole principle.

A document's fingerprint holds, for each of 64 bits, what most of its shingles' hashes have there. Two
fingerprints link if at most ``radius`` bits differ. To find all links without comparing all pairs, the
bits are put into m parts, correlated bits together, and part i gets its own threshold t(i) >= -1 with
sum t(i) = radius - m + 1: then any two linked fingerprints are within t(i) in at least one part i
(general pigeonhole principle). The number of parts and the thresholds are those with the least
estimated work, by dynamic programming over the candidates that each part and threshold would yield;
the estimates come from bit counts and part histograms of all fingerprints.

Fingerprints are probed part by part with equi-joins on (part, value), all flips of up to t(i) bits
on the probing side, and verified in the join's condition. Only components matter in the end, so links
inside a group of many near copies are not all listed: first each fingerprint is compared with a few
hubs of its buckets, and the components of these links are found; then fingerprints are joined only
where their components differ, and in each bucket the largest component is on one side only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from termspark.llm.common import connected_components, map_rows, read_once, struct, texts_of, with_batch_bounds

BITS = 64
SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
# cost of moving one key row, in comparisons of a candidate
KEY_COST = 200
# shingles whose bits are counted at once
COUNTED = 1 << 17


def fingerprint(text: bytes, k: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text: lower-cased A-Z, words between ASCII white space, k-word shingles.

    Fewer words make one shingle; no words give 0.
    """
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    columns = [words[i:] for i in range(k)] if len(words) >= k else [[w] for w in words]
    shingles = list(map(b" ".join, zip(*columns)))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", len(shingles))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at : at + COUNTED].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    set_bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def with_fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``fp`` (the fingerprint as a signed bigint) and ``_row`` (the columns in ``keep``) for each row."""

    def start():
        def work(batch: pa.RecordBatch) -> dict:
            return {"fp": [_signed(fingerprint(t)) for t in texts_of(batch["text"])]}

        return work

    return map_rows(docs, {"text": "binary"}, struct("fp bigint"), start, keep)


# ---------------------------------------------------------------- parts and thresholds


def bit_counts(fps: DataFrame) -> np.ndarray:
    """How often two bits are both set, over all fingerprints; the diagonal has single bits.

    Each task sends its 64 x 64 sums; the driver gets 4,096 rows.
    """
    out = struct("cell int, n bigint")
    fields = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = batch["fp"].to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float64)
            total += bits.T @ bits
        cells = [pa.array(np.arange(BITS * BITS), pa.int32()), pa.array(total.ravel().astype(np.int64))]
        yield pa.RecordBatch.from_arrays(cells, schema=fields)

    rows = with_batch_bounds(fps.select("fp")).mapInArrow(run, out)
    together = np.zeros(BITS * BITS)
    for row in rows.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        together[row["cell"]] = row["n"]
    return together.reshape(BITS, BITS)


def correlated_parts(together: np.ndarray, count: int, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of near-equal size, each grown from the strongest pair left."""
    p = together / max(count, 1)
    single = np.diag(p)
    spread = np.sqrt(np.maximum(single * (1 - single), 1e-12))
    strength = np.abs(p - np.outer(single, single)) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    left, made = list(range(BITS)), []
    for number in range(parts):
        size = (BITS - sum(map(len, made))) // (parts - number)
        first = max(left, key=lambda b: (strength[b, left].max(), -b))
        part = [first]
        left.remove(first)
        while len(part) < size:
            nearest = max(left, key=lambda b: (strength[b, part].sum(), -b))
            part.append(nearest)
            left.remove(nearest)
        made.append(sorted(part))
    return made


def _within(differ: np.ndarray, radius: int) -> np.ndarray:
    """Chance that at most 0, 1, ... ``radius`` of independent bits differ."""
    chance = np.zeros(radius + 2)
    chance[0] = 1
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return np.cumsum(chance[: radius + 1])


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one per part and at least -1, that sum to ``total`` at the least cost.

    ``costs[i][t]`` is the work of part i at threshold t; -1 leaves the part out at no cost.
    Dynamic programming over parts and the sum so far.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, len(options)):
                made = (cost + (options[t] if t >= 0 else 0.0), [*chosen, t])
                if spent + t not in following or made < following[spent + t]:
                    following[spent + t] = made
        best = following
    return best[total]


def _part_costs(parts, differ, count: int, radius: int, scale: list[float] | None = None):
    """Work per fingerprint of each part and threshold: keys moved and candidates compared."""
    costs = []
    for i, part in enumerate(parts):
        near = _within(differ[part], radius)
        factor = scale[i] if scale else 1.0
        keys = np.cumsum([comb(len(part), t) for t in range(radius + 1)])
        costs.append([float(KEY_COST * k + count * min(1.0, factor * c)) for k, c in zip(keys, near)])
    return costs


def choose_parts(fps: DataFrame, count: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of every part that is probed, for distinct fingerprints ``fps(fp)``."""
    together = bit_counts(fps)
    single = np.diag(together) / max(count, 1)
    differ = 2 * single * (1 - single)
    options = {}
    for m in range(1, radius + 2):
        parts = correlated_parts(together, count, m)
        options[m] = (allocate(_part_costs(parts, differ, count, radius), radius - m + 1)[0], m, parts)
    _, m, parts = min(options.values())
    # the candidates at threshold 0, as counted, against those that independent bits would give
    masks = F.array(*[F.lit(_signed(sum(1 << b for b in part))) for part in parts])
    buckets = fps.select("fp", F.posexplode(masks).alias("part", "mask")).groupBy(
        "part", F.col("fp").bitwiseAND(F.col("mask")).alias("key")
    )
    squares = buckets.count().groupBy("part").agg(F.sum(F.col("count") * F.col("count").cast("double")).alias("s"))
    counted = {r["part"]: r["s"] / max(count, 1) for r in squares.collect()}
    scale = [
        counted.get(i, 0.0) / max(count * _within(differ[part], 0)[0], 1e-9) for i, part in enumerate(parts)
    ]
    _, thresholds = allocate(_part_costs(parts, differ, count, radius, scale), radius - m + 1)
    return [(part, t) for part, t in zip(parts, thresholds) if t >= 0]


# ---------------------------------------------------------------- links


def _keys(fps: DataFrame, parts: list[tuple[list[int], int]], flips: bool) -> DataFrame:
    """``fps`` with (part, key): its own value in each part or, with ``flips``, all values in reach."""
    def keys(number: int, bits: list[int], threshold: int) -> Column:
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        reach = threshold if flips else 0
        patterns = [_signed(sum(1 << b for b in c)) for t in range(reach + 1) for c in combinations(bits, t)]
        return F.transform(
            F.array(*[F.lit(p) for p in patterns]),
            lambda p: F.struct(F.lit(number).alias("part"), own.bitwiseXOR(p).alias("key")),
        )

    made = F.concat(*[keys(n, bits, threshold) for n, (bits, threshold) in enumerate(parts)])
    return fps.select("*", F.explode(made).alias("_k")).select(*fps.columns, "_k.part", "_k.key")


def _near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def link_fingerprints(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(fp, root)`` for distinct ``fps(fp, n)``: the smallest fingerprint reachable over links.

    Exact: every two fingerprints within ``radius`` end under one root. ``n`` says how many documents
    have the fingerprint, which makes a good hub. Fingerprints without a link are their own root.
    """
    count = fps.count()
    parts = choose_parts(fps, count, radius) if count > 1 else [(list(range(BITS)), 0)]
    index = _keys(fps, parts, flips=False)

    # links to a few hubs of every bucket
    picks = [F.min("fp"), F.max("fp"), F.max_by("fp", F.struct("n", "fp"))]
    picks += [F.min_by("fp", F.xxhash64("fp", F.lit(seed))) for seed in range(5)]
    hubs = index.groupBy("part", "key").agg(F.count("*").alias("_n"), F.array_distinct(F.array(*picks)).alias("hubs"))
    with_hubs = index.join(hubs.filter("_n > 1"), ["part", "key"])
    near_hubs = F.filter("hubs", lambda h: (h != F.col("fp")) & _near(h, F.col("fp"), radius))
    edges = with_hubs.select(F.col("fp").alias("a"), F.explode(near_hubs).alias("b"))
    first, _ = read_once(connected_components(edges, "hub-links"), "hub-components")
    labelled = fps.select("fp").join(first, fps["fp"] == first["node"], "left")
    labelled, _ = read_once(labelled.select("fp", F.coalesce("component", "fp").alias("label")), "labelled")

    # the rest: only between components, and within a bucket not among its largest one
    index = _keys(labelled, parts, flips=False)
    per_label = index.groupBy("part", "key", "label").count()
    largest = per_label.groupBy("part", "key").agg(F.max_by("label", F.struct("count", "label")).alias("most"))
    held = index.join(largest, ["part", "key"])
    probes = _keys(labelled, parts, flips=True).join(largest, ["part", "key"])
    probes = probes.select("part", "key", F.col("fp").alias("_fp"), F.col("label").alias("_label"), "most")
    different = (F.col("label") != F.col("_label")) & _near(F.col("fp"), F.col("_fp"), radius)
    same = [F.col("l.part") == F.col("r.part"), F.col("l.key") == F.col("r.key")]

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        joined = left.alias("l").join(right.alias("r"), [*same, different])
        return joined.select(F.col("_label").alias("a"), F.col("label").alias("b")).distinct()

    links = meet(probes.filter("_label <> most"), held)
    flipped = [n for n, (_, threshold) in enumerate(parts) if threshold > 0]
    if flipped:
        # between a bucket's largest component and a flipped probe that is of it elsewhere
        near_side = probes.filter(F.col("_label") == F.col("most")).filter(F.col("part").isin(flipped))
        links = links.unionByName(meet(near_side, held.filter("label <> most")))
    second = connected_components(links, "label-links")
    joined = labelled.join(second, labelled["label"] == second["node"], "left")
    return joined.select("fp", F.coalesce("component", "label").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint and component_id (the smallest doc_id reachable), one row per row of ``docs``.

    Empty and NULL texts have fingerprint zero and link like any other. Repeated rows stay. A NULL
    doc_id counts as a member but never names a component, unless no member has an id.
    """
    found = with_fingerprints(docs, ["doc_id"]).select(F.col("_row.doc_id").alias("doc_id"), "fp")
    rows, _ = read_once(found, "fingerprints")
    fps, _ = read_once(rows.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "distinct")
    roots, _ = read_once(link_fingerprints(fps.select("fp", "n"), radius), "roots")
    least = roots.join(fps, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of every group of near-duplicates: that of the smallest doc_id, in the columns of ``docs``.

    Of rows with the same doc_id in a group, one stays. Rows with a NULL doc_id stay only in groups
    without an id.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = docs.select(F.monotonically_increasing_id().alias("at"), row.alias("given"), F.col("text").cast("string").alias("text"))
    rows, _ = read_once(
        with_fingerprints(numbered, ["at", "given"]).select("fp", F.col("_row.at").alias("at"), F.col("_row.given").alias("given")), "rows"
    )
    order = F.struct(F.col("given.doc_id").isNull().alias("none"), F.col("given.doc_id").alias("id"), "at")
    fps, _ = read_once(rows.groupBy("fp").agg(F.count("*").alias("n"), F.min(order).alias("first")), "distinct")
    roots, _ = read_once(link_fingerprints(fps.select("fp", "n"), radius), "roots")
    kept = roots.join(fps, "fp").groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(kept.select(F.col("first.at").alias("at")), "at").select("given.*")
